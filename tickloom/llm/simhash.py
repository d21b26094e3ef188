"""SimHash near-duplicates through an inverted index over positional bytes with count filtering.

A fingerprint has eight bytes. Two of them that differ in at most four bits have at least four bytes in
common at the same place. The index therefore has one posting list for every set of four positions and
the bytes there: a pair meets in a list if and only if its tally of shared positional bytes reaches the
guaranteed minimum, and no list of a single byte value (one of only 2048, each a 256th of the corpus)
is ever read. Inside a list the tally is taken again and pairs that
reach it are verified by counting the differing bits. Equal fingerprints are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_words, kept, shingles, written
from tickloom.llm.components import connected_components

SEED = 42
#: Lists up to this size are compared pair by pair in one task; longer ones are split exactly.
LIST_ROWS = 4096

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def bit_counts(by_byte: np.ndarray) -> np.ndarray:
    """How many rows of bytes have each bit set, the first byte's highest bit first."""
    return np.concatenate([np.bincount(column, minlength=256) @ _BITS for column in by_byte.T])


def fingerprint(text: str | None, size: int) -> int:
    """64 bits, each set if it is set in over half of the shingles' XXH64; of no words zero."""
    runs = shingles(ascii_words(text), size)
    if not runs:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(r, SEED) for r in runs), dtype="<u8", count=len(runs))
    ones = bit_counts(hashes.view(np.uint8).reshape(-1, 8)[:, ::-1])
    return int(np.packbits(ones * 2 > len(runs)).view(">u8")[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) for every row of ``docs``.

    A null or empty text, or one of blanks only, has no words and fingerprint zero. Repeated rows and
    null ids are kept as they come; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("simhash", lambda: None)  # an earlier operator's tables make room
        for batch in batches:
            values = [fingerprint(t.as_py(), size) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _signed(values)], names=["doc_id", "fp"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def _postings(fps: DataFrame) -> DataFrame:
    """``key, fp`` for each of the 70 sets of four positions; the key holds the set and its bytes."""
    sets = list(combinations(range(8), 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            by_byte = fp.view(np.uint8).reshape(-1, 8).astype(np.int64)
            for number, places in enumerate(sets):
                key = np.full(len(fp), number, dtype=np.int64)
                for p in places:
                    key = key << 8 | by_byte[:, p]
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def _forest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the pairs of one list connect, at most one per entry."""
    left, right, rest = [], [], values
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            diff = rest ^ x
            shared = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = (shared >= 8 - max_bits) & (np.bitwise_count(diff.view(np.uint64)) <= max_bits)
            found = rest[near]
            left.extend([x] * len(found))
            right.extend(found)
            queue.extend(found)
            rest = rest[~near]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _scan_lists(max_bits: int, most: int):
    """Reads postings sorted by key: links of the lists of up to ``most`` entries, the rest as they are.

    Columns ``key, a, b``: a link has a null key, an entry of a longer list its key and a null ``b``.
    """

    def out(keys: list, a: list, b: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["key", "a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key0, held, long_list = None, np.empty(0, np.int64), False

        def close() -> Iterator[pa.RecordBatch]:
            if not long_list and len(held) > 1:
                a, b = _forest(np.unique(held), max_bits)
                if len(a):
                    yield out([None] * len(a), a, b)

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            # single entries inside the batch need no look; the first and last run may go on elsewhere
            runs = np.flatnonzero(ends - starts > 1)
            runs = np.union1d(runs, [0, len(starts) - 1])
            for r in runs:
                key, part = keys[starts[r]], fps[starts[r] : ends[r]]
                if key != key0:
                    yield from close()
                    key0, held, long_list = key, np.empty(0, np.int64), False
                held = np.concatenate([held, part])
                if long_list or len(held) > most:
                    long_list = True
                    yield out([key] * len(held), held, [None] * len(held))
                    held = np.empty(0, np.int64)
        yield from close()

    return run


def _split_long(entries: DataFrame, max_bits: int) -> DataFrame:
    """Links of the long lists: entries of a list agree in four bytes, so what is left has eight half-bytes.

    Of these too at least four agree, which makes 70 shorter lists for each; such a list has 48 bits in
    common and so holds at most 65,536 different fingerprints, whatever the corpus.
    """
    sets = list(combinations(range(8), 4))
    four = list(combinations(range(8), 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False)
            by_byte = fp.view(np.uint8).reshape(-1, 8)
            number = key >> 32
            rest = np.array([[p for p in range(8) if p not in s] for s in four])[number]
            left = np.take_along_axis(by_byte, rest, axis=1).astype(np.int64)
            halves = np.concatenate([left >> 4, left & 15], axis=1)
            for n, places in enumerate(sets):
                sub = np.full(len(fp), n, dtype=np.int64)
                for p in places:
                    sub = sub << 4 | halves[:, p]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sub), batch.column(1)], names=["key", "sub", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        parts: list[np.ndarray] = []

        def close() -> Iterator[pa.RecordBatch]:
            if parts:
                a, b = _forest(np.unique(np.concatenate(parts)), max_bits)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            key, sub, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fp):
                continue
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(sub) != 0)) + 1
            for s, e in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(fp)]]), strict=True):
                if held != (key[s], sub[s]):
                    yield from close()
                    held, parts = (key[s], sub[s]), []
                parts.append(fp[s:e])
        yield from close()

    spread = entries.select("key", F.col("a").alias("fp")).mapInArrow(run, "key long, sub long, fp long")
    ordered = spread.repartition("key", "sub").sortWithinPartitions("key", "sub")
    return ordered.mapInArrow(link, "a long, b long")


def fingerprint_links(fps: DataFrame, max_bits: int = 4, list_rows: int = LIST_ROWS) -> DataFrame:
    """``a, b``: links between different fingerprints of ``fps`` (column ``fp``) at up to ``max_bits`` bits.

    Not all links, but enough that what they connect is what all links connect; at most one per entry
    and list. Nothing is capped: lists longer than ``list_rows`` are split exactly.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("with more than 4 bits fewer than 4 shared bytes are guaranteed")
    # Few small files would make few tasks, each with 70 entries a row of its share to sort and hand on.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = _postings(fps.select("fp").distinct().repartition(parts))
    ordered = entries.repartition("key").sortWithinPartitions("key")
    found = written(ordered.mapInArrow(_scan_lists(max_bits, list_rows), "key long, a long, b long"), "simhash-lists")
    links = found.where("key IS NULL").select("a", "b")
    long_lists = found.where("key IS NOT NULL")
    if long_lists.isEmpty():
        return links
    return links.unionByName(_split_long(long_lists, max_bits))


def near_groups(docs: DataFrame, size: int = 4, max_bits: int = 4, list_rows: int = LIST_ROWS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest doc_id that links reach, itself included.

    Rows without words share fingerprint zero and link like any other. A null doc_id stays with a
    fingerprint and takes its component from the other rows of its group; if all ids of a fingerprint
    are null it makes no links. Repeated rows repeat in the result; of an empty table nothing comes back.
    """
    fps = written(fingerprints(docs, size), "simhash")
    heads = written(fps.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("head")), "simhash-heads")
    links = fingerprint_links(heads, max_bits, list_rows)
    by_head = (
        links.join(heads.toDF("a", "head_a"), "a").join(heads.toDF("b", "head_b"), "b").selectExpr("head_a AS a", "head_b AS b")
    )
    groups = connected_components(by_head).withColumnRenamed("node", "head")
    labels = heads.join(groups, "head", "left").selectExpr("fp", "coalesce(component, head) AS component_id")
    return fps.join(labels, "fp", "left").select("doc_id", "fp", "component_id")
