"""Phrases whose words occur together more than their parts' counts explain.

Candidates are found level by level, as in Apriori: a phrase can only be frequent if the two phrases one word
shorter in it are. What may be frequent is told by hashes: of each level only hashes and supports are shuffled,
and those that reach the support become a bitmap of bounded size, in which phrases of the next level are
looked up. Hashes that meet by chance only add candidates. The candidates themselves go into double-array
tries of bounded size; the tasks walk all places of their texts through a trie at once, word by word, and
add up the accepting states they come to. Those sums are the counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import written
from tickloom.llm.textblocks import RunHashes, mixed, pieces
from tickloom.llm.tries import Trie, build

#: Bits of the bitmap for each frequent phrase, and how many there are at most (128 MB).
BITS_EACH, MOST_BITS = 64, 1 << 30
#: Bytes of candidates in one trie, which is broadcast, and how many tries share a pass over the texts.
TRIE_BYTES, TRIES = 10 << 20, 8
#: Bytes of text that are taken apart at once.
PIECE = 4 << 20
#: Longer words are in a trie by their digest, after a character that no word has.
LONG_WORD = 64

_WORD, _BLANK, _CUT = 0, 1, 2
_KIND = bytes(_BLANK if b in b" \t" else _CUT if b in b".,;:!?\n\x0b\x0c\r" else _WORD for b in range(256))
_TIMES = np.uint64(0x9E3779B97F4A7C15)


class Places:
    """All words of some texts: which word, in which language, and how many follow before a cut."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, langs: pa.Array):
        lowered = data.tobytes().lower()  # on bytes A-Z only
        data = np.frombuffer(lowered, np.uint8)
        kind = np.frombuffer(lowered.translate(_KIND), np.uint8)
        word = kind == _WORD
        begins = np.zeros(len(data) + 1, bool)
        begins[starts] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | begins[1:-1]
        last[:-1] &= ~word[1:] | begins[1:-1]
        at, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        cuts = np.flatnonzero((kind == _CUT) | begins[:-1])
        self.piece = np.searchsorted(cuts, at, side="right")
        names = pc.fill_null(langs, "und").dictionary_encode()
        self.langs: list[str] = names.dictionary.to_pylist()
        text = np.searchsorted(starts, at, side="right") - 1
        self.lang = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        offsets = np.concatenate([[0], np.cumsum(end - at)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[word])]).dictionary_encode()
        self.code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.words = words.dictionary
        self._hashes: list[np.ndarray] = []  # of phrases of no words, of one, and so on

    def __len__(self) -> int:
        return len(self.code)

    def whole(self, size: int) -> np.ndarray:
        """Places from which ``size`` words run without a cut."""
        if len(self) < size:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[: len(self) - size + 1] == self.piece[size - 1 :])

    def hashes(self, size: int) -> np.ndarray:
        """Of the phrase of ``size`` words from each place on; meaningless where that has a cut."""
        if not self._hashes:
            own = RunHashes(np.frombuffer("\n".join(self.langs).encode(), np.uint8))
            sizes = np.array([len(n.encode()) for n in self.langs], np.int64)
            starts = np.cumsum(sizes + 1) - sizes - 1
            data, offsets = _bytes_of(self.words)
            self._each = RunHashes(data).between(offsets[:-1], offsets[1:])[self.code]
            self._hashes = [own.between(starts, starts + sizes)[self.lang]]
        while len(self._hashes) <= size:
            k, shorter = len(self._hashes) - 1, self._hashes[-1]
            self._hashes.append(mixed(shorter[: len(self) - k] * _TIMES + self._each[k:]))
        return self._hashes[size]

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.code[at + k])) for k in range(size)]
        return pc.binary_join_element_wise(*parts, " ")


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    content = words.buffers()[2]
    return (np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)), offsets


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[Places]:
    for batch in batches:
        for rows, data, starts in pieces(batch, 1, PIECE):
            yield Places(data, starts, rows.column(0))


class Bitmap:
    """Which hashes may be among those it was made of."""

    def __init__(self, bits: int, content: np.ndarray):
        self.bits, self.content = bits, content

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.content[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    @classmethod
    def of(cls, hashes: DataFrame) -> Bitmap:
        """From a written table of hashes; comes to the driver in one run of bounded size."""
        bits = 1 << 16
        while bits < min(MOST_BITS, BITS_EACH * hashes.count()):
            bits *= 2
        at = hashes.selectExpr(f"(h & {bits - 1}L) + 1 AS at")
        rows = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        content = np.zeros(bits // 8, np.uint8)
        for row in rows.toLocalIterator():
            part = np.frombuffer(row.bits, np.uint8)
            start = (row.bucket - 1) * len(part)
            content[start : start + len(part)] = part[: len(content) - start]
        return cls(bits, content)


def _possible(places: Places, size: int, shorter: Bitmap | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of phrases of ``size`` words both of whose parts one word shorter may be frequent, and their hashes."""
    at = places.whole(size)
    if shorter is not None and len(at):
        frequent = shorter.has(places.hashes(size - 1))
        at = at[frequent[at] & frequent[at + 1]]
    return at, places.hashes(size)[at] if len(at) else np.zeros(0, np.uint64)


def _supported(texts: DataFrame, size: int, least: int, shorter) -> DataFrame:
    """Hashes of phrases of ``size`` words whose support reaches ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _places(batches):
            _, hashes = _possible(places, size, shorter and shorter.value)
            known, counts = np.unique(hashes, return_counts=True)
            counts = np.minimum(counts, least).astype(np.int32)  # more than the threshold is not worth a byte
            yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(counts)], names=["h", "support"])

    supports = texts.mapInArrow(run, "h long, support int").groupBy("h").agg(F.sum("support").alias("support"))
    return written(supports.where(f"support >= {least}").select("h"), f"phrases-{size}")


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where each value occurs first."""
    codes = pa.array(values).dictionary_encode().indices.to_numpy(zero_copy_only=False)  # numbered as they come
    return np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of small whole numbers, and which of them each value is."""
    there = np.bincount(values) > 0
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


def _candidates(texts: DataFrame, bitmaps: list) -> DataFrame:
    """Distinct phrases of all levels whose hash has the support; with a null phrase the words of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _places(batches):
            rows: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
            for size, bitmap in enumerate(bitmaps, 1):
                at, hashes = _possible(places, size, bitmaps[size - 2].value if size > 1 else None)
                on = bitmap.value.has(hashes)
                at = at[on][_firsts(hashes[on])]
                rows.append((places.lang[at], places.phrases(at, size), np.zeros(len(at), np.int64)))
            totals = np.bincount(places.lang, minlength=len(places.langs))
            rows.append((np.arange(len(totals)), pa.nulls(len(totals), pa.string()), totals))
            names = pa.array(places.langs, pa.string())
            for lang, phrase, words in rows:
                yield pa.RecordBatch.from_arrays([names.take(pa.array(lang)), phrase, pa.array(words)], names=["lang", "phrase", "words"])

    found = texts.mapInArrow(run, "lang string, phrase string, words long")
    return written(found.groupBy("lang", "phrase").agg(F.sum("words").alias("words")), "phrase-candidates")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted candidates with their partition, their place in it and the bytes before them there."""
    part, row, before = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        ends = before + np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        starts = np.concatenate([[before], ends[:-1]])[: len(ends)]
        places = [pa.array(np.full(len(ends), part)), pa.array(row + np.arange(len(ends))), pa.array(starts)]
        row, before = row + len(ends), int(ends[-1]) if len(ends) else before
        yield pa.RecordBatch.from_arrays([*batch.columns, *places], names=["lang", "key", "phrase", "part", "row", "before"])


def _sorted_runs(keys: DataFrame) -> DataFrame:
    """Candidates in one order: their number in it, and runs of consecutive ones that fill a trie each."""
    whole = keys.agg(F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()[0]
    dealt = keys.repartitionByRange(max(1, -(-whole // TRIE_BYTES)), "lang", "key").sortWithinPartitions("lang", "key")
    schema = "lang string, key binary, phrase string, part long, row long, before long"
    placed = written(dealt.mapInArrow(_numbered, schema), "phrase-keys")
    parts = placed.groupBy("part").agg(F.count("*").alias("rows"), F.sum(F.octet_length("key")).alias("bytes"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = parts.select("part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("rows", "bytes")))
    return placed.join(starts, "part").selectExpr(
        "lang", "key", "phrase", "rows_before + row AS number", f"(bytes_before + before) div {TRIE_BYTES} AS run"
    )


def _trie(table: pa.Table) -> pa.Table:
    table = table.sort_by("number").combine_chunks()
    langs = table.column("lang").combine_chunks().dictionary_encode()
    data, starts = _bytes_of(table.column("key").combine_chunks())
    data, starts = data[starts[0] : starts[-1]], starts - starts[0]
    trie = build(data, starts, langs.indices.to_numpy(), len(langs.dictionary))
    return pa.table({
        "run": table.column("run")[:1], "first": table.column("number")[:1], "langs": pa.array([langs.dictionary.to_pylist()], pa.list_(pa.string())),
        "base": [trie.base.tobytes()], "check": [trie.check.tobytes()], "accepting": [trie.accepting.tobytes()],
    })


def _short(words: pa.Array) -> pa.Array:
    """Words as they are in a trie."""
    long = pc.greater(pc.binary_length(words), LONG_WORD)
    if not pc.any(long).as_py():
        return words
    digests = ["\x0b" + hashlib.sha256(w.as_py().encode()).hexdigest() for w in words.filter(long)]
    return pc.replace_with_mask(words, long, pa.array(digests, words.type))


_SHORT = rf"""array_join(transform(split(phrase, ' ', -1),
    w -> if(octet_length(w) > {LONG_WORD}, concat(decode(X'0B', 'UTF-8'), sha2(CAST(w AS BINARY), 256)), w)), ' ')"""


def _in_turn(shared):
    """A broadcast's value, which the worker does not keep: of those it takes in turn it holds one."""
    value = shared.value
    if getattr(shared, "_path", None) is not None:  # where it can be read from again
        del shared._value
    return value


def _counter(group: list, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the phrases of some tries in a task's texts, which are taken apart once for all of them."""

    def counts_of(places: Places, langs: list[str], trie: Trie, data: np.ndarray, starts: np.ndarray, pairs: np.ndarray, where: np.ndarray) -> np.ndarray:
        roots, keys = {name: i for i, name in enumerate(langs, 1)}, len(trie.accepting)
        counts, accepts = np.zeros(keys, np.int64), trie.numbers()
        root = np.array([roots.get(name, 0) for name in places.langs], np.int64)
        one = trie.walk(root[pairs // (len(places.words) + 1)], pairs % (len(places.words) + 1), data, starts) if len(pairs) else pairs
        at = np.flatnonzero(one[where] > 0)
        states = one[where[at]]
        for level in range(1, size + 1):
            if level > 1:
                on = (at + level - 1 < len(places)) & (states > 0)
                at, states = at[on], states[on]
                on = places.piece[at] == places.piece[at + level - 1]
                at, states = at[on], trie.step(states[on], ord(" "))
                at, states = at[states > 0], states[states > 0]
                states = trie.walk(states, places.code[at + level - 1], data, starts)
            accepted = accepts[states]
            counts += np.bincount(accepted[accepted >= 0], minlength=keys)
        return counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for places in _places(batches):
            data, starts = _bytes_of(_short(places.words))
            pairs, where = _distinct(places.lang * (len(places.words) + 1) + places.code)
            for shared in group:
                first, langs, trie = _in_turn(shared) if len(group) > 1 else shared.value
                counts = counts_of(places, langs, trie, data, starts, pairs, where)
                if first not in found:
                    found[first] = np.zeros(len(counts), np.uint32)  # no task has so many words
                found[first] += counts.astype(np.uint32)
        for first, counts in found.items():
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(first + seen), pa.array(counts[seen].astype(np.int64))], names=["number", "f"])

    return run


def _collected(row: DataFrame) -> tuple[int, list[str], Trie]:
    """One trie, of bounded size."""
    table = row.toArrow().combine_chunks()
    arrays = (np.frombuffer(table.column(c)[0].as_buffer(), np.int32) for c in ("base", "check", "accepting"))
    return table.column("first")[0].as_py(), table.column("langs")[0].as_py(), Trie(*arrays)


def counted(texts: DataFrame, size: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``size`` words that occur ``least`` times or more (lang, phrase, f), and words by language."""
    spark, context = texts.sparkSession, texts.sparkSession.sparkContext
    bitmaps: list = []
    for level in range(1, size + 1):
        hashes = _supported(texts, level, least, bitmaps[-1] if bitmaps else None)
        bitmaps.append(context.broadcast(Bitmap.of(hashes)))
    found = _candidates(texts, bitmaps)
    for bitmap in bitmaps:
        bitmap.unpersist()
    totals = found.where("phrase IS NULL").select("lang", F.col("words").alias("n"))
    keys = found.where("phrase IS NOT NULL").selectExpr("lang", f"CAST({_SHORT} AS BINARY) AS key", "phrase")
    numbered = written(_sorted_runs(keys), "phrase-runs")
    schema = "run long, first long, langs array<string>, base binary, check binary, accepting binary"
    tries = written(numbered.groupBy("run").applyInArrow(_trie, schema), "phrase-tries")
    counts = None
    runs = sorted(r.run for r in tries.select("run").collect())
    for start in range(0, len(runs), TRIES):
        group = [context.broadcast(_collected(tries.where(F.col("run") == run))) for run in runs[start : start + TRIES]]
        sums = texts.mapInArrow(_counter(group, size), "number long, f long").groupBy("number").agg(F.sum("f").alias("f"))
        part = written(sums.where(f"f >= {least}"), "phrase-counts")
        for shared in group:
            shared.destroy()
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = spark.createDataFrame([], "number long, f long")
    return numbered.join(counts, "number").select("lang", "phrase", "f"), totals


def collocations(
    docs: DataFrame, size: int = 3, least: int = 10, first: int = 2000, inside: int = 50, lang: str = "lang", text: str = "text"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``first`` phrases of 2 to ``size`` words of each language.

    A phrase counts ``a`` (at least ``least``), the parts of its weakest cut ``l`` and ``r``, the language ``n``
    words. Phrases of which ``inside`` percent or more lie in one longer candidate are left out. Null texts
    are empty, a null language is ``und``; repeated rows count again. Equal scores are ordered by ``a`` and by
    the phrase in UTF-8. Other columns are not read. Without words there are no rows.
    """
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    phrases, totals = counted(texts, size, least)
    phrases = written(phrases.selectExpr("lang", "phrase", "f", "split(phrase, ' ', -1) AS words"), "phrase-figures")
    candidates = phrases.where("size(words) > 1").withColumnRenamed("f", "a")
    cuts = candidates.selectExpr("*", "explode(sequence(1, size(words) - 1)) AS k").selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(words, 1, k), ' ') AS head",
        "array_join(slice(words, k + 1, size(words) - k), ' ') AS tail",
    )
    heads = phrases.selectExpr("lang", "phrase AS head", "f AS l")
    tails = phrases.selectExpr("lang", "phrase AS tail", "f AS r")
    score = "(1000000 * CAST(a AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(38, 0))) div (CAST(l AS DECIMAL(38, 0)) * CAST(r AS DECIMAL(38, 0)))"
    weakest = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .selectExpr("lang", "phrase", "a", f"struct({score} AS score, k, l, r) AS cut")
        .groupBy("lang", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
    )
    within = (
        candidates.where("size(words) > 2")
        .selectExpr("lang", "a", "words", "explode(sequence(2, size(words) - 1)) AS length")
        .selectExpr("lang", "a", "words", "length", "explode(sequence(1, size(words) - length + 1)) AS start")
        .selectExpr("lang", "a", "array_join(slice(words, start, length), ' ') AS phrase")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    left = weakest.join(within, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {inside} * a")
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").selectExpr("lang", "CAST(rank AS LONG) AS rank", "phrase", "a", "cut.l AS l", "cut.r AS r", "n", "cut.score AS score")
