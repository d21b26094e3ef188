"""Shards: the law, the slots, and copies kept together."""

import random
import zlib
from collections import Counter, defaultdict

from tickloom.llm.shards import propagated, sharded


def check(rows, got, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None
    )
    assert len(got) == len(rows)
    counts = Counter(r.shard for r in got)
    assert all(0 <= s < shards for s in counts)
    sizes = [counts[s] for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in got:
        assert (r.law, r.grown_shard) == ("rows", None)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sharded(docs).collect()
    check(rows, got, 16)
    where = defaultdict(set)
    texts = dict(rows)
    for r in got:
        where[texts[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for t, s in where.items() if sum(t == u for u in texts.values()) <= 10)


def test_hot_group_fills_as_few_shards_as_it_can(spark):
    rng = random.Random(2)
    rows = [(i, "hot") for i in range(300)] + [(1000 + i, f"pair {i // 2}") for i in range(300)] + [(5000 + i, rng.random().hex()) for i in range(303)]
    got = sharded(spark.createDataFrame(rows, "doc_id long, text string"), shards=9).collect()
    check(rows, got, 9)
    hot = Counter(r.shard for r in got if r.doc_id < 300)
    assert len(hot) <= 4  # 300 rows in shards of 100 or 101
    pairs = defaultdict(set)
    for r in got:
        if 1000 <= r.doc_id < 5000:
            pairs[(r.doc_id - 1000) // 2].add(r.shard)
    assert sum(len(s) > 1 for s in pairs.values()) <= 15  # of 150


def test_all_rows_linked_few_rows_nulls_and_repeats(spark):
    for rows in (
        [(i, "same") for i in range(37)],
        [(1, None), (1, None), (2, ""), (None, "x"), (None, "x"), (3, "é" * 50_000)],
        [(5, "one")],
        [],
    ):
        frame = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, shard int, grp string")
        check(rows, sharded(frame, shards=4).collect(), 4)


def test_propagation_never_overfills(spark):
    rng = random.Random(4)
    counts = Counter((g, rng.randrange(4)) for g in range(30) for _ in range(rng.randint(1, 9)))
    rows = [(bytes([g]), g % 3, s, n) for (g, s), n in counts.items()]
    total = sum(counts.values())
    start = Counter()
    for (_, s), n in counts.items():
        start[s] += n
    capacity = [max(start[s], -(-total // 4) + 2) for s in range(4)]
    got = propagated(spark.createDataFrame(rows, "grp binary, bucket int, shard int, n long"), capacity).collect()
    load = Counter()
    for r in got:
        load[r.shard] += r.n
    assert all(load[s] <= capacity[s] for s in range(4))
    assert Counter(bytes(r.grp) for r in got for _ in range(r.n)) == Counter(bytes([g]) for (g, _), n in counts.items() for _ in range(n))
    assert len(got) < len(rows) / 2
