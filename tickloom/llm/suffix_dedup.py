"""Repeated byte strings of a fixed length, found in suffix arrays built by two-stage sorting.

Sorting all suffixes of a corpus together would move every text a hundred times over. Two equal strings
have the same least gram (by hash; the first of equals) at the same place, its anchor, so the strings of an
anchor are a short run of starts with the bytes around them, and only runs whose anchors have the same gram need to be sorted
together. Runs with the same bytes are one entry of the sort, that of the first of them: that is how copies
are taken together before anything is shuffled, first within a task, then among tasks. What is left is dealt
to blocks of bounded size; each builds its suffix array, and adjacent suffixes with a common prefix of the
full length are occurrences of one string, of which the first stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import written
from tickloom.llm.suffixes import Block
from tickloom.llm.textblocks import RunHashes, mixed, pieces

LENGTH, GRAM = 100, 32
#: Starts that are looked at together within a piece of text, whatever the length of the text.
STARTS = 1 << 18
#: Bytes of a block that is sorted in one task. The runs of an anchor stay together as far as they fill one.
BLOCK_BYTES = 2 << 20
#: Anchors that are very frequent in this share of the documents are dealt to several tasks: where they go, not what is found.
LOOK, HOT, HOT_PARTS = 0.01, 1024, 64

_RUNS = "done boolean, a long, c long, part int, doc_id long, h long, pos long, size long"
_SPANS = "doc_id long, h long, spans array<struct<pos: long, end: long>>, firsts array<struct<pos: long, window: binary>>"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: minima up to and from the cuts of every ``width`` places."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    up = np.minimum.accumulate(table, axis=1).ravel()
    down = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(down[:count], up[width - 1 : width - 1 + count])


def runs(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of starts with one anchor: text, first start, number of starts, hash of gram and of all bytes.

    A long stretch of text is looked at in parts; a run on a cut becomes two.
    """
    out = []
    for cut in range(0, len(data) - length + 1, STARTS):
        part = data[cut : cut + STARTS + length - 1]
        hashes = RunHashes(part)
        at = np.arange(len(part) - gram + 1)
        grams = hashes.between(at, at + gram)
        bits = np.uint64(max(1, len(part).bit_length()))
        least = _least(grams >> bits << bits | at.astype(np.uint64), length - gram + 1)
        anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        text = np.searchsorted(starts, cut + np.arange(len(anchor)), side="right") - 1
        inside = np.flatnonzero(cut + np.arange(len(anchor)) + length <= starts[text + 1])
        if not len(inside):
            continue
        new = np.ones(len(inside), bool)
        new[1:] = (anchor[inside[1:]] != anchor[inside[:-1]]) | (inside[1:] != inside[:-1] + 1)
        first = inside[new]
        last = inside[np.append(np.flatnonzero(new)[1:] - 1, len(inside) - 1)]
        whole = hashes.between(first, last + length)
        shape = (last - first).astype(np.uint64) << np.uint64(32) | (anchor[first] - first).astype(np.uint64)
        out.append((text[first], cut + first - starts[text[first]], last - first + 1, grams[anchor[first]], mixed(whole ^ mixed(shape))))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def row_ranks(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    """The place of each (doc_id, h) in their order, null ids first; equal ones have the same."""
    table = pa.table({"i": ids, "h": hashes})
    by = pc.sort_indices(table, sort_keys=[("i", "ascending"), ("h", "ascending")], null_placement="at_start").to_numpy()
    known = np.asarray(ids.is_valid())[by]
    plain, h = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[by], hashes.to_numpy(zero_copy_only=False)[by]
    new = np.zeros(len(by), np.int64)
    new[1:] = (plain[1:] != plain[:-1]) | (known[1:] != known[:-1]) | (h[1:] != h[:-1])
    out = np.empty(len(by), np.int64)
    out[by] = np.cumsum(new)
    return out


def _joined(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching intervals of an owner as one; those of an owner start and end in the same order."""
    by = np.lexsort((start, owner))
    owner, start, end = owner[by], start[by], end[by]
    new = np.ones(len(by), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return owner[first], start[first], end[np.append(first[1:] - 1, len(by) - 1)] if len(by) else end


def _found_runs(hot: frozenset[int], length: int, gram: int):
    """Each piece's runs, of equal ones only the first; what the others cover is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.array(sorted(hot), np.int64)
        for batch in batches:
            for rows, data, starts in pieces(batch, 2):
                text, pos, size, a, c = runs(data, starts, length, gram)
                a, c = a.view(np.int64), c.view(np.int64)
                rank = row_ranks(rows.column(0), rows.column(1))
                by = np.lexsort((pos, rank[text], c, a))
                text, pos, size, a, c = text[by], pos[by], size[by], a[by], c[by]
                first = np.ones(len(by), bool)
                first[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
                head = np.flatnonzero(first)[np.cumsum(first) - 1]
                copy = (rank[text] != rank[text[head]]) | (pos != pos[head])  # else a repeated row's same run
                owner, start, end = _joined(text[copy], pos[copy], (pos + size - 1 + length)[copy])
                part = np.where(np.isin(a, frequent), c % HOT_PARTS, 0)
                for done, t, columns in (
                    (False, text[first], [a[first], c[first], part[first], pos[first], size[first]]),
                    (True, owner, [mixed(owner + start).view(np.int64), start, np.zeros(len(owner)), start, end - start]),
                ):
                    kept = rows.select([0, 1]).take(pa.array(t))
                    a_, c_, part_, pos_, size_ = (pa.array(x.astype(np.int64)) for x in columns)
                    arrays = [pa.array(np.full(len(t), done)), a_, c_, part_.cast(pa.int32()), kept.column(0), kept.column(1), pos_, size_]
                    yield pa.RecordBatch.from_arrays(arrays, names=["done", "a", "c", "part", "doc_id", "h", "pos", "size"])

    return run


def _lists(owner: np.ndarray, count: int, **fields) -> pa.Array:
    """A list of structs for each of ``count`` owners, from values in the order of their owners."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=count))]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], names=list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _sorted_block(length: int):
    """The repeats in each run of a block; of anchors in several blocks also each string's first place."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        column = {n: table.column(n).combine_chunks() for n in table.column_names}
        texts = column["bytes"].cast(pa.large_binary())
        starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        block = Block(np.frombuffer(texts.buffers()[2], np.uint8)[starts[0] : starts[-1]], starts - starts[0])
        order = block.suffix_array(length)
        new = np.ones(len(order), bool)
        new[1:] = ~block.same_prefix(order, length)
        full = block.left[order] >= length
        pos = column["pos"].to_numpy()
        rank = row_ranks(column["doc_id"], column["h"])
        place = (rank[block.string] << 32) + pos[block.string] + block.place
        first = np.minimum.reduceat(place[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        repeats = order[full & (place[order] > first)]
        string, start, end = _joined(block.string[repeats], block.place[repeats], block.place[repeats] + length)
        spread = np.asarray(column["several"])[block.string[order]]
        heads = np.sort(order[full & spread & (place[order] == first)])
        windows = (block.symbols[heads[:, None] + np.arange(length)] - 1).astype(np.uint8)
        found = pa.array([w.tobytes() for w in windows], pa.binary())
        return pa.table({
            "doc_id": column["doc_id"], "h": column["h"],
            "spans": _lists(string, len(pos), pos=start + pos[string], end=end + pos[string]),
            "firsts": _lists(block.string[heads], len(pos), pos=block.place[heads] + pos[block.string[heads]], window=found),
        })

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its intervals, as figures and a digest."""
    for batch in batches:
        spans = batch.column(3)
        out = []
        for i, text in enumerate(batch.column(2)):
            content = (text.as_py() or "").encode()
            found = sorted((s["pos"], s["end"]) for part in spans[i].as_py() or () for s in part)
            digest, removed, count, reached = hashlib.sha256(), 0, 0, 0
            kept_to = 0
            for start, end in found:
                if start > reached or not count:
                    count += 1
                    digest.update(content[kept_to:start])
                    reached = start
                if end > reached:
                    removed += end - reached
                    reached = kept_to = end
            digest.update(content[kept_to:])
            out.append((len(content), removed, count, digest.hexdigest()))
        sizes, gone, counts, digests = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "h", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _same_row(one: str, two: str) -> F.Column:
    return F.col(f"{one}.doc_id").eqNullSafe(F.col(f"{two}.doc_id")) & (F.col(f"{one}.h") == F.col(f"{two}.h"))


def repeats(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, h, spans``: intervals that cover every occurrence but the first of every string of ``length`` bytes."""
    looked = rows.sample(LOOK, seed=1).mapInArrow(_found_runs(frozenset(), length, gram), _RUNS).where("NOT done")
    often = looked.groupBy("a").count().where("count >= 64").orderBy(F.desc("count")).limit(HOT)
    hot = frozenset(r.a for r in often.collect())
    found = rows.mapInArrow(_found_runs(hot, length, gram), _RUNS)
    anchor = Window.partitionBy("done", "a", "part").orderBy("c", F.asc_nulls_first("doc_id"), "h", "pos")
    whole = anchor.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = found.select(
        "*",
        F.lag("c").over(anchor).alias("c_before"), F.lag("doc_id").over(anchor).alias("doc_before"),
        F.lag("h").over(anchor).alias("h_before"), F.lag("pos").over(anchor).alias("pos_before"),
        F.min("c").over(whole).alias("c_least"), F.max("c").over(whole).alias("c_most"),
    )
    always = f"array_contains(array({', '.join(f'{a}L' for a in sorted(hot))}), a)" if hot else "false"
    kinds = ranked.selectExpr(
        "a", "c", "part", "doc_id", "h", "pos", "size",
        f"""CASE WHEN done THEN 'done'
                 WHEN c = c_before AND doc_id <=> doc_before AND h = h_before AND pos = pos_before THEN 'same'
                 WHEN c = c_before THEN 'copy'
                 WHEN c_least <> c_most OR {always} THEN 'entry' ELSE 'alone' END AS kind""",
    )
    together = max(1, BLOCK_BYTES // (2 * length - gram))  # runs of the greatest size
    in_part = Window.partitionBy("a", "part").orderBy("c")
    kept = written(kinds.where("kind IN ('done', 'copy', 'entry')"), "suffix-runs")
    end = f"pos + size + if(kind = 'done', 0, {length - 1})"
    copies = kept.where("kind <> 'entry'").selectExpr("doc_id", "h", f"array(struct(pos, {end} AS end)) AS spans")
    entries = kept.where("kind = 'entry'").withColumn("unit", F.floor((F.row_number().over(in_part) - 1) / together))
    entries = written(entries, "suffix-entries")
    wide = entries.where("part > 0 OR unit > 0").select("a", F.lit(True).alias("several")).distinct()
    entries = entries.join(wide, "a", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    total = entries.agg(F.coalesce(F.sum(F.col("size") + length - 1), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    texts = rows.groupBy("doc_id", "h").agg(F.first("text").alias("text"))
    dealt = texts.alias("t").join(entries.alias("e"), _same_row("t", "e")).select(
        "e.doc_id", "e.h", "e.pos", "e.several",
        F.pmod(F.xxhash64("e.a", "e.part", "e.unit"), F.lit(blocks)).alias("block"),
        F.substring(F.col("t.text").cast("binary"), F.col("e.pos") + 1, F.col("e.size") + length - 1).alias("bytes"),
    )
    spans = written(dealt.groupBy("block").applyInArrow(_sorted_block(length), _SPANS), "suffix-spans")
    by_string = Window.partitionBy("window").orderBy(F.asc_nulls_first("doc_id"), "h", "pos")
    firsts = spans.where("size(firsts) > 0").select("doc_id", "h", F.inline("firsts"))
    again = firsts.withColumn("nth", F.row_number().over(by_string)).where("nth > 1")
    again = again.selectExpr("doc_id", "h", f"array(struct(pos, pos + {length} AS end)) AS spans")
    return copies.unionByName(spans.where("size(spans) > 0").select("doc_id", "h", "spans")).unionByName(again)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``.

    Bytes covered by a string of ``length`` bytes that starts earlier are removed: in a row with a smaller
    doc_id, or at an earlier place of the same text. A null id is smaller than all others; rows with one id
    are in the order of a hash of their texts, and of repeated rows the first comes before its copies. Null
    texts are empty. Other columns are not read.
    """
    slim = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    count = slim.select("doc_id").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    own = F.lit(0).cast("long") if count.n == count.ids else F.xxhash64(F.coalesce("text", F.lit("")))
    rows = slim.select("doc_id", own.alias("h"), "text")
    spans = repeats(rows, length, gram)
    each = spans.groupBy("doc_id", "h").agg(F.collect_set("spans").alias("spans"))
    with_spans = rows.alias("t").join(each.alias("e"), _same_row("t", "e"), "left").select("t.doc_id", "t.h", "t.text", "e.spans")
    figures = with_spans.mapInArrow(_cut, "doc_id long, h long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if count.n == count.ids:
        return figures.select(columns)
    rows_alike = figures.groupBy("h", *columns).agg(F.count("*").alias("rows"))
    gone = f"nth > 1 AND n_bytes >= {length}"
    return rows_alike.selectExpr(*columns, "explode(sequence(1L, rows)) AS nth").selectExpr(
        "doc_id", "n_bytes", f"if({gone}, n_bytes, n_removed) AS n_removed", f"if({gone}, 1L, n_spans) AS n_spans",
        f"if({gone}, '{hashlib.sha256().hexdigest()}', kept_sha256) AS kept_sha256",
    )
