"""Repeated strings against a plain search, and suffix arrays against sorting."""

import hashlib
import random

import numpy as np
import pytest

from tickloom.llm import queries, suffix_dedup
from tickloom.llm.suffixes import Block

SCHEMA = "doc_id long, text string, h string, pos int, kind string, a long"


def docs(spark, rows):
    """Rows of (doc_id, text) with extra columns whose names the operator uses."""
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)


def naive(rows, length):
    """Expects rows in their order: by id, null ids first."""
    seen, out = set(), []
    for doc_id, text in rows:
        content = (text or "").encode()
        gone = np.zeros(len(content), bool)
        for p in range(len(content) - length + 1):
            window = content[p : p + length]
            if window in seen:
                gone[p : p + length] = True
            seen.add(window)
        kept = bytes(np.frombuffer(content, np.uint8)[~gone])
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out.append((doc_id, len(content), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def same(out, expected):
    key = [(r[0] is not None, *(x or 0 for x in r[:4]), r[4]) for r in expected]
    ours = [(r[0] is not None, *(x or 0 for x in r[:4]), r[4]) for r in map(tuple, out.collect())]
    assert sorted(ours) == sorted(key)


def passages(rng, count, alphabet="abcde fghé\x00"):
    """Texts that share passages of about the length looked for, at any place."""
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(10, 60))) for _ in range(6)]
    out = []
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(shared) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))))
        out.append("".join(parts))
    return out


def test_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in table.select("doc_id", "text").collect())
    out = queries.op13_suffix_dedup(spark, sf_dir)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    same(out, naive(rows, 100))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("small", [False, True])
def test_shared_passages(spark, seed, small, monkeypatch):
    rng = random.Random(seed)
    rows = list(enumerate(passages(rng, 60)))
    rows += [(100 + i, "ab" * n) for i, n in enumerate((3, 40, 40, 41))] + [(200, None), (201, ""), (202, "z" * 300)]
    monkeypatch.setattr(suffix_dedup, "LOOK", 1.0)
    if small:  # parts, blocks and units so small that every way is taken
        monkeypatch.setattr(suffix_dedup, "STARTS", 37)
        monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 60)
    same(suffix_dedup.without_repeats(docs(spark, rows).repartition(5), 12, 4), naive(rows, 12))


def test_hot_anchors(spark, monkeypatch):
    """One line in all texts between other words: its anchors have as many runs as there are texts."""
    rng = random.Random(9)
    line = "this one line is in each of the texts, whatever else they say about it"
    rows = [(i, f"{rng.random()} {line} {rng.random()}") for i in range(150)]
    monkeypatch.setattr(suffix_dedup, "LOOK", 1.0)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 400)
    same(suffix_dedup.without_repeats(docs(spark, rows).repartition(8), 20, 6), naive(rows, 20))


def test_repeated_rows_and_null_ids(spark):
    long = "a text that is longer than the string looked for, so that its copies go"
    rows = [(None, long), (None, long), (None, "short"), (None, "short"), (3, long), (3, long), (4, "x" + long), (5, None)]
    same(suffix_dedup.without_repeats(docs(spark, rows), 20, 6), naive(rows, 20))


def test_one_long_text(spark):
    rng = random.Random(4)
    piece = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [(1, piece * 3 + "é" * 200 + piece[::-1]), (2, piece[100:400])]
    same(suffix_dedup.without_repeats(docs(spark, rows)), naive(rows, 100))


def test_empty_table(spark):
    assert suffix_dedup.without_repeats(docs(spark, [])).count() == 0


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(200):
        texts = [bytes(rng.choice(b"ab\x00\xff"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
        block = Block(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(int))
        order = block.suffix_array(20)
        suffixes = [texts[block.string[i]][block.place[i] :] for i in order]
        assert sorted(order) == list(range(len(block.symbols)))
        assert [s[:20] for s in suffixes] == sorted(s[:20] for s in suffixes)
        pairs = zip(suffixes, suffixes[1:], strict=False)
        assert block.same_prefix(order, 5).tolist() == [len(a) >= 5 and len(b) >= 5 and a[:5] == b[:5] for a, b in pairs]
