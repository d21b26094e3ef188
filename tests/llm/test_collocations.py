"""Phrases against SQL and plain counting; tries against a dictionary."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tickloom.llm import collocations, queries, tries

SCHEMA = "doc_id long, text string, lang string, phrase string, h long, f int, words int"


def docs(spark, rows):
    """Rows of (lang, text) with extra columns whose names the operator uses."""
    return spark.createDataFrame([(i, t, g, "x", 1, 2, 3) for i, (g, t) in enumerate(rows)], SCHEMA)


def naive(rows, size, least, first, inside=50):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, size + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                longer[lang, words[i : i + k]] = max(longer[lang, words[i : i + k]], a)
    out = []
    for lang in totals:
        own = []
        for (g, words), a in found.items():
            if g == lang and not (longer[g, words] and 100 * longer[g, words] >= inside * a):
                cuts = [(counts[g, words[:k]], counts[g, words[k:]], k) for k in range(1, len(words))]
                score, _, l, r = min((10**6 * a * a // (l * r), k, l, r) for l, r, k in cuts)
                own.append((-score, -a, " ".join(words).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(own)[:first], 1)]
    return sorted(out)


def same(out, expected):
    assert sorted(tuple(r) for r in out.collect()) == expected


def test_table(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    out = queries.op11_collocations(spark, sf_dir)
    cursor = con.execute(queries.ORACLES["op11_collocations"])
    assert out.columns == [c[0] for c in cursor.description]
    same(out, sorted(cursor.fetchall()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["a", "b", "C", "de", "dé", "\x00", "\xa0x", "of", "the", "w" * 70, "w" * 70 + "v"]
    out = []
    for i in range(60):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", "? ", "\x0b"])
        out.append((rng.choice(["en", "en", None, "f\tr", "und"]), text))
    return out + [("en", None), ("en", ""), (None, " \t.\n"), ("en", "one word " * 4000), out[0], out[0]]


@pytest.mark.parametrize("size", [2, 3, 4])
def test_plain_counting(spark, rows, size):
    same(collocations.collocations(docs(spark, rows).repartition(4), size, 4, 25), naive(rows, size, 4, 25))


def test_small_tries_and_bitmaps(spark, rows, monkeypatch):
    """Several tries, and a bitmap in which all hashes meet."""
    monkeypatch.setattr(collocations, "TRIE_BYTES", 700)
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(collocations.Bitmap, "has", lambda self, hashes: np.ones(len(hashes), bool))
    same(collocations.collocations(docs(spark, rows).repartition(4), 3, 4, 2000), naive(rows, 3, 4, 2000))


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_tries_share_a_pass_over_the_texts(spark, rows, monkeypatch, share):
    """As many at a time as may be in store; what is counted does not depend on it."""
    passes, tries, own, collected = [], [], collocations.written, collocations._collected
    monkeypatch.setattr(collocations, "written", lambda df, label: passes.append(label) or own(df, label))
    monkeypatch.setattr(collocations, "_collected", lambda row: tries.append(1) or collected(row))
    monkeypatch.setattr(collocations, "TRIE_BYTES", 700)
    monkeypatch.setattr(collocations, "TRIES", share)
    same(collocations.collocations(docs(spark, rows).repartition(4), 3, 4, 2000), naive(rows, 3, 4, 2000))
    assert len(tries) > 3 and passes.count("phrase-counts") == -(-len(tries) // share)


@pytest.mark.parametrize("rows", [[], [("en", None)], [("en", "one two three")]])
def test_nothing_frequent(spark, rows):
    assert collocations.collocations(docs(spark, rows)).count() == 0


def test_big_counts(spark):
    """Products beyond 64 bits stay exact."""
    rows = [("en", "x y " * 30_000)]
    assert collocations.collocations(docs(spark, rows * 60)).collect()[0].score == naive(rows * 60, 3, 10, 5)[0][-1]


def test_bitmap(spark):
    rng = np.random.default_rng(3)
    hashes = rng.integers(-(2**63), 2**63 - 1, 5000)
    bitmap = collocations.Bitmap.of(spark.createDataFrame([(int(h),) for h in hashes], "h long"))
    assert bitmap.has(hashes.view(np.uint64)).all()
    assert bitmap.has(rng.integers(-(2**63), 2**63 - 1, 100_000).view(np.uint64)).mean() < 0.03


def test_tries():
    rng = random.Random(8)
    for _ in range(30):
        keys = sorted({(rng.randint(0, 2), bytes(rng.choice(b"ab \x00\xff") for _ in range(rng.randint(1, 7)))) for _ in range(rng.randint(1, 400))})
        names = sorted({k[0] for k in keys})
        data = np.frombuffer(b"".join(k[1] for k in keys), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(k[1]) for k in keys])])
        trie = tries.build(data, starts, np.array([names.index(k[0]) for k in keys]), len(names))
        asked = [*keys, *((rng.choice(names), bytes(rng.choice(b"ab \x00\xff\x01") for _ in range(rng.randint(1, 7)))) for _ in range(300))]
        text = np.frombuffer(b"".join(k[1] for k in asked), np.uint8)
        begins = np.concatenate([[0], np.cumsum([len(k[1]) for k in asked])])
        states = trie.walk(np.array([names.index(k[0]) + 1 for k in asked]), np.arange(len(asked)), text, begins)
        place = {k: i for i, k in enumerate(keys)}
        assert trie.numbers()[states].tolist() == [place.get(k, -1) for k in asked]


def test_firsts_and_distinct_numbers():
    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.int64), np.array([5]), rng.integers(0, 50, 400)):
        assert sorted(collocations._firsts(values.astype(np.uint64))) == sorted(np.unique(values, return_index=True)[1])
        for ours, theirs in zip(collocations._distinct(values), np.unique(values, return_inverse=True), strict=True):
            assert ours.tolist() == theirs.tolist()
