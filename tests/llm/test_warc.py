"""Archives round trip, revisits, order of the capture index."""

import hashlib
import io
import random
from collections import Counter

import pytest

from tickloom.llm import warc


def plain(rows):
    heads = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page is not None:
            heads[data] = min(page, heads.get(data, page))
    out = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        head = heads.get(data)
        revisit = head is not None and page != head
        out[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", head if revisit else None] += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, head int")


def test_round_trip(spark):
    long = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 100
    rows = [
        (1, "http://a.example/", long), (2, "http://b.example/ x\r\ny", long), (3, "http://a.example/", "short"), (4, "u", "short"),
        (5, None, None), (6, "", ""), (None, "http://c.example", long), (None, "n", "z" * 200), (None, "n", "z" * 200),
        (1, "http://a.example/", long), (9, "http://big.example", "ä" * 400_000), (10, "x", "y" * 99), (11, "x", "y" * 99), (12, "x", "y" * 100), (13, "x", "y" * 100),
    ]
    got = warc.archived(frame(spark, rows)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == plain(rows)
    assert warc.archived(frame(spark, [])).collect() == []


def test_global_order(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 7)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = warc.archived(pages.unionByName(pages)).collect()
    assert len(got) == 2 * pages.count()
    assert len({r.archive for r in got}) > 5
    keys = [(r.url_key.encode(), r.captured, r.page_id) for r in got]
    assert keys == sorted(keys)


def test_loser_tree():
    rng = random.Random(6)
    for k in range(0, 12):
        runs = [sorted(rng.randrange(50) for _ in range(rng.choice([0, 1, 30]))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError, match="no record"):
        list(warc.read_records(io.BytesIO(b"garbage\r\n")))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.Example.com:80/A?b=C#d", "com,example)/a?b=c"),
        ("https://m.x.org", "org,x,m)/"),
        ("", ""),
        ("no host", "no host"),
        ("http://[bad", "http://[bad"),
    ],
)
def test_url_keys(url, key):
    assert warc.url_key(url) == key
