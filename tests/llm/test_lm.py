"""Scores against counts of all documents in plain Python."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import lm


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def plain(rows):
    unigrams, bigrams = Counter(), Counter()
    for doc_id, text in rows:
        if not held_out(doc_id):
            words = tokens(text)
            unigrams.update(words)
            bigrams.update(zip([b""] + words[:-1], words, strict=True))
    total = sum(unigrams.values())
    divisor = total + 0.5 * (len(unigrams) + 1)
    return unigrams, bigrams, total, divisor


def check(rows, got):
    unigrams, bigrams, total, divisor = plain(rows)
    assert len(got) == len(rows)
    exact = ours = 0.0
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        r = by_id[doc_id].pop()
        words = tokens(text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(unigrams[w] > 0 for w in words), total)
        assert r.held_out == held_out(doc_id)
        assert r.base_score == pytest.approx(sum(math.log10((unigrams[w] + 0.5) / divisor) for w in words), rel=1e-9)
        pairs = list(zip([b""] + words[:-1], words, strict=True))
        exact += sum(math.log10((bigrams[p] + lm.PRIOR * (unigrams[p[1]] + 0.5) / divisor) / (unigrams[p[0]] + lm.PRIOR)) for p in pairs)
        ours += r.score
    return exact, ours


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    whole = lm.scores(docs).collect()
    exact, ours = check(rows, whole)
    assert ours == pytest.approx(exact, rel=0.02)  # quantised counts, rare false hits
    held = [r for r in whole if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    parts = {r.doc_id: r.score for r in lm.scores(docs, segment_bytes=50_000).collect()}
    assert all(parts[r.doc_id] == pytest.approx(r.score, rel=1e-9) for r in whole)
    shuffled = docs.repartition(7).orderBy(F.rand())  # other partitions and another order at every pass
    parts = {r.doc_id: r.score for r in lm.scores(shuffled, segment_bytes=50_000).collect()}
    assert all(parts[r.doc_id] == pytest.approx(r.score, rel=1e-9) for r in whole)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b a"), (1, "a b a"), (None, "A\tc"), (2, None), (3, ""), (4, "new words only"), (7, "x " * 5000)]
    docs = spark.createDataFrame([(i, t, 1.0, "w") for i, t in rows], "doc_id long, text string, score double, word string")
    check(rows, lm.scores(docs).collect())
    assert lm.scores(docs.limit(0)).collect() == []
    only = [i for i in range(100) if held_out(i)][:2]
    check([(i, "a b") for i in only], lm.scores(spark.createDataFrame([(i, "a b") for i in only], "doc_id long, text string")).collect())


def test_filter_gives_levels_back():
    key = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    count = np.random.default_rng(2).integers(1, 5000, 20_000)
    bits = lm.build_bucket(key, count)
    segment = lm.Segment(5, np.array([0, len(bits)]), bits)
    level = segment.level(np.full(len(key), 5), key)
    assert (level >= lm.level_of(count)).all()
    assert (level == lm.level_of(count)).mean() > 0.98
    absent = np.random.default_rng(3).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert (segment.level(np.full(len(absent), 5), absent) > 0).mean() < 0.02
    values = np.arange(1, 200)
    assert (lm.count_of(lm.level_of(values)) <= values).all() and (lm.count_of(lm.level_of(values)) * 1.5 >= values).all()


def test_tokens_are_hashed_from_the_bytes():
    """Words, ends and hashes of many texts at once are those of each text alone, cut at the six blanks only."""
    texts = ["", None, " a  b\ta", "a b A\x1fB", "\x0b\x0cend\n", "x " * 3000, "Ä中 中"]
    rows = pa.array(texts)
    found = {}
    for size in (1, 1 << 20):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(lm, "BLOCK_BYTES", size)
            blocks = list(lm._blocks(rows, lm.Powers()))
        assert [b[0] for b in blocks] == [0, *(b[1] for b in blocks[:-1])] and blocks[-1][1] == len(texts)
        words = [w for _, _, t in blocks for w in t.words(np.arange(len(t.hashes)))]
        assert words == [w for t in texts for w in tokens(t)]
        for word, code in zip(words, np.concatenate([t.hashes for _, _, t in blocks]).tolist(), strict=True):
            assert found.setdefault(word, code) == code
    assert len(set(found.values())) == len(found)
    counts = {w: i + 1 for i, w in enumerate(found) if i % 2}
    head = lm.Head(*lm.frequent_words(counts))
    assert head.count(np.array(list(found.values()), np.uint64)).tolist() == [counts.get(w, 0) for w in found]


def test_a_probe_reads_one_word_and_the_counts_meet_in_the_bucket(spark):
    """Every level of an n-gram is one word of its bucket; no aggregate stands between counting and building."""
    key = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket = lm.build_bucket(key, np.full(len(key), 3))
    assert bucket.dtype == np.uint64
    for level in range(1, int(lm.level_of(np.array([3]))[0]) + 1):
        place, mask = lm._probe(key, level, np.uint64(len(bucket)))
        assert place.max() < len(bucket) and ((bucket[place.astype(int)] & mask) == mask).all()
    head = spark.sparkContext.broadcast(lm.frequent_words({b"": 1}))
    texts = spark.createDataFrame([("a b a b",), ("a b",)], "text string").repartition(2)
    table = lm._bucket_filter(texts, head, 4)
    assert "Aggregate" not in table._jdf.queryExecution().optimizedPlan().toString()
    segment = next(lm._segments(table, 4, 1 << 20))
    a, b = lm.Tokens([b"a b"], lm.Powers()).hashes[:2]
    pair = lm.bigram_hash(np.array([a]), np.array([b]))
    assert segment.level(lm._bucket(pair, np.array([b]), np.zeros(1), 4), pair) >= lm.level_of(np.array([3]))
