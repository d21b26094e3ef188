"""SimHash groups and similarity groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from tickloom.llm import similar, simhash
from tickloom.llm.common import ascii_words, shingles
from tickloom.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, component_id string, key string"


def docs(spark, rows):
    """Rows of (doc_id, text) with extra columns whose names the operators use."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)


def naive_fingerprint(text, size=4):
    words = text.encode().lower().split() if text else []
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def naive_groups(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def words(rng, n):
    return " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = words(rng, 400).split()
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "Été x y z w"), (7, "word " * 30_000)]
    for i in range(60):
        copy = list(base)
        for _ in range(i % 12):
            copy[rng.randrange(len(copy))] = "edit"
        out.append((100 - i, " ".join(copy)))
    out += [(200 + i, words(rng, rng.randint(1, 60))) for i in range(40)]
    return out + [out[20], out[3]]  # repeated rows


def test_groups_are_those_of_all_pairs(spark, rows):
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_groups(docs(spark, rows)).collect()]
    assert len(got) == len(rows)
    prints = {i: naive_fingerprint(t) for i, t in rows}
    want = naive_groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {i: f for i, f, _ in got} == prints
    assert {i: c for i, _, c in got} == want


def test_long_lists_are_split_without_loss(spark, rows):
    whole = simhash.near_groups(docs(spark, rows))
    split = simhash.near_groups(docs(spark, rows), list_rows=2)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))


def test_no_rows_and_null_ids(spark):
    assert simhash.near_groups(docs(spark, [])).collect() == []
    got = simhash.near_groups(docs(spark, [(None, "a b c d e"), (9, "a b c d e"), (None, "only one")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(9, 9)]
    assert sum(r.doc_id is None for r in got) == 2


def test_five_bits_are_refused(spark):
    with pytest.raises(ValueError, match="4 bits"):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp long"), max_bits=5)


def test_similarity_groups_are_those_of_all_pairs(spark, rows):
    texts = {i: t for i, t in rows}
    sets = {i: set(shingles(ascii_words(t), 5)) for i, t in texts.items()}

    def linked(a, b):
        return sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])

    want = naive_groups(sorted(texts), linked)
    got = similar.similar_groups(docs(spark, rows + [(None, "one two")])).collect()
    assert len(got) == len(rows)
    groups = {r.doc_id: r.component_id for r in got}
    pairs = [(a, b) for a in texts for b in texts if a < b and want[a] == want[b]]
    assert all(want[i] == want[c] for i, c in groups.items())  # nothing else is linked
    assert sum(groups[a] == groups[b] for a, b in pairs) >= 0.97 * len(pairs)
    near = [(a, b) for a, b in pairs if linked(a, b) and len(sets[a] & sets[b]) >= 0.9 * len(sets[a] | sets[b])]
    assert near and all(groups[a] == groups[b] for a, b in near)
    assert similar.similar_groups(docs(spark, [])).collect() == []


def test_long_similarity_lists_end_in_the_same_groups(spark, rows, monkeypatch):
    whole = similar.similar_groups(docs(spark, rows)).collect()
    monkeypatch.setattr(similar, "LIST_ROWS", 3)
    monkeypatch.setattr(similar, "BLOCK_ROWS", 5)
    assert sorted(map(tuple, similar.similar_groups(docs(spark, rows)).collect())) == sorted(map(tuple, whole))


def test_block_edits_are_found_up_to_the_similarity(spark):
    rng = random.Random(5)
    texts, edits = [], ("appended", "truncated", "replaced", "repeated")
    for k in range(240):
        n, share, edit = rng.randrange(60, 300), rng.uniform(0.78, 0.9), edits[k % 4]
        a = [f"w{rng.randrange(20_000)}" for _ in range(n)]
        fresh = [f"w{rng.randrange(20_000)}" for _ in range(n)]
        cut = int(n * (1 - share) / (1 + share))
        at = rng.randrange(n - cut)
        b = {
            "appended": a + fresh[: int(n * (1 / share - 1))],
            "truncated": a[: int(n * share)],
            "replaced": a[:at] + fresh[:cut] + a[at + cut :],
            "repeated": a + a[-20:] * (k % 5) + fresh[: int(n * (1 / share - 1)) - 4],
        }[edit]
        texts += [" ".join(a), " ".join(b)]
    sets = [set(shingles(ascii_words(t), 5)) for t in texts]
    near = {i for i in range(0, len(texts), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])}
    got = {r.doc_id: r.component_id for r in similar.similar_groups(docs(spark, list(enumerate(texts)))).collect()}
    assert 100 < len(near) < 240
    assert {i for i in range(0, len(texts), 2) if got[i + 1] == i} == near


def test_components_of_random_edges(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges + edges[:5], "a long, b long")).collect()}
    nodes = sorted({n for a, b in edges if a != b for n in (a, b)})
    pairs = {frozenset(e) for e in edges}
    assert got == naive_groups(nodes, lambda a, b: frozenset((a, b)) in pairs)


def test_postings_are_made_by_many_tasks(spark, monkeypatch):
    """A small table of fingerprints lies in few files; its 70 entries a row are not made by as few tasks."""
    seen, made = [], simhash._postings
    monkeypatch.setattr(simhash, "_postings", lambda fps: seen.append(fps.rdd.getNumPartitions()) or made(fps))
    simhash.fingerprint_links(spark.range(1000).coalesce(1).selectExpr("xxhash64(id) AS fp"))
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
