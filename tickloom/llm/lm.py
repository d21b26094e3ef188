"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Exact word counts come from one shuffle and give every text its unigram log-probability. On top of it
stands a bigram model with Dirichlet smoothing,

    p(w | c) = (C(c, w) + K p(w)) / (C(c) + K),

whose logarithm falls into a sum of three: log p(w), minus log(1 + C(c) / K), and log(1 + C(c, w) / (K p(w)))
for bigrams that were seen. The first two need word counts only. For the third, counts are quantised on
a logarithmic scale and level j of an n-gram enters a Bloom filter as the keys (n-gram, 1) to (n-gram, j);
probing upwards until a key is missing gives the level back.

The filter is cut into buckets, each with bits in proportion to its keys, and built where the counts of a
bucket meet. A bigram lies in the bucket of its second word, beside that word's own count; frequent words
are too many for that and their exact counts travel apart (at most HEAD_SHARE of them, known by 64 bits of hash), so
their bigrams are spread. Since the sum falls apart by second word, runs of buckets of at most SEGMENT_BYTES can be
broadcast one after the other, whatever the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_words, written

#: Weight of the unigram model, in tokens.
PRIOR = 50.0
#: Counts of level j are those from LEVEL_BASE ** (j - 1) on.
LEVEL_BASE = 1.5
#: Bits for every key of the filter, and how many of them are set, all in one word of 64: a probe reads one word.
KEY_BITS = 12
PROBES = 5
WORD_BITS = 64
#: A broadcast segment's size at most; more keys make more segments.
SEGMENT_BYTES = 128 << 20
#: Words with at least a HEAD_SHARE-th of all tokens, so at most HEAD_SHARE words, are known to every worker.
HEAD_SHARE = 1 << 19
#: N-grams a task holds before it hands its counts on.
TASK_NGRAMS = 1 << 21
#: Bytes of the texts whose tokens are looked up together.
BLOCK_BYTES = 1 << 20
CACHE_WORDS = 300_000
#: Buckets of the filter: at least so many, and one for so many training tokens.
BUCKETS = 4096
BUCKET_TOKENS = 1 << 16

#: The token after a text's last word; also the context of its first. No word is empty.
END = b""

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


#: The hash of the empty word.
END_HASH = _mix(np.zeros(1, np.uint64))[0]
#: Which bytes belong to words, and a number for each byte: zero for blanks, odd for others.
_LETTER = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTES = np.where(_LETTER, _mix(np.arange(1, 257, dtype=np.uint64) * _M1) | np.uint64(1), np.uint64(0))


def bigram_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(context * _M1 + word)


def level_of(count: np.ndarray) -> np.ndarray:
    """The level of a count of 1 or more."""
    return 1 + np.floor(np.log(count) / math.log(LEVEL_BASE) + 1e-9).astype(np.int64)


def _probe(key: np.ndarray, level: int | np.ndarray, words: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Which of a bucket's words (n-gram, level) lies in, and its bits there."""
    found = _mix(key + np.asarray(level, np.uint64).reshape(-1) * _M1)
    mask = np.zeros(len(key), np.uint64)
    for i in range(PROBES):  # bits 0 to 29 of the hash; its upper half chooses the word
        mask |= np.uint64(1) << ((found >> np.uint64(6 * i)) & np.uint64(63))
    return ((found >> np.uint64(32)) * words) >> np.uint64(32), mask


def build_bucket(key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The words of a bucket that holds these n-grams."""
    level = level_of(count)
    size = max(1, -(-int(level.sum()) * KEY_BITS // WORD_BITS))
    ends = np.cumsum(level)
    steps = np.arange(1, ends[-1] + 1) - np.repeat(ends - level, level)  # 1 to the level of each n-gram
    place, mask = _probe(np.repeat(key, level), steps.astype(np.uint64), np.uint64(size))
    out = np.zeros(size, "<u8")
    np.bitwise_or.at(out, place.astype(np.int64), mask)
    return out


class Segment:
    """Consecutive buckets of the filter; ``starts`` are their first words, one more at the end."""

    def __init__(self, first: int, starts: np.ndarray, content: np.ndarray):
        self.first, self.starts, self.content = first, starts, content

    def holds(self, bucket: np.ndarray) -> np.ndarray:
        return (bucket >= self.first) & (bucket < self.first + len(self.starts) - 1)

    def level(self, bucket: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Levels by repeated membership probes, 0 for an n-gram that is not in the filter."""
        out = np.zeros(len(key), np.int64)
        base = self.starts[bucket - self.first]
        words = self.starts[bucket - self.first + 1] - base
        at, level = np.flatnonzero(words), 0
        base, words, key = base[at], words[at].astype(np.uint64), key[at]
        while len(at):
            level += 1
            place, mask = _probe(key, level, words)
            there = np.flatnonzero((self.content[base + place.astype(np.int64)] & mask) == mask)
            at, base, words, key = at[there], base[there], words[there], key[there]
            out[at] = level
        return out


def count_of(level: np.ndarray) -> np.ndarray:
    """The least count of a level."""
    return np.ceil(LEVEL_BASE ** (level - 1.0) - 1e-9)


def held_out(doc_id: str) -> Column:
    """crc32 of the id as text is 1 modulo 5; a null id is not held out."""
    return F.expr(f"coalesce(crc32(CAST(CAST({doc_id} AS STRING) AS BINARY)) % 5 = 1, false)")


def _powers(n: int, base: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base of a word's hash, and of its inverse: made once for all blocks of a task."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = _powers(n, int(_M2)), _powers(n, pow(int(_M2), -1, 1 << 64))


class Tokens:
    """All tokens of some texts, one behind the other: their hashes, and where they are among the bytes.

    ``bounds`` is where each text's tokens begin, with the end of the last. A word's hash is a polynomial over its bytes
    modulo 2 ** 64; differences of one running sum give those of all words.
    """

    def __init__(self, texts: list[bytes], powers: Powers) -> None:
        self.data = b" ".join(texts) + b" "
        letters = np.frombuffer(self.data, np.uint8)
        powers.reach(len(letters))
        inside = _LETTER[letters]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = (np.concatenate([[0], edges]) if inside[0] else edges).reshape(-1, 2).T
        sums = _BYTES[letters]
        sums *= powers.up[: len(sums)]
        np.add.accumulate(sums, out=sums)  # the blank behind a word adds nothing
        found = sums[ends] - np.where(starts > 0, sums[starts - 1], np.uint64(0))
        found = _mix(found * powers.down[starts] + (ends - starts).astype(np.uint64))
        stops = np.cumsum([len(t) + 1 for t in texts])
        words = np.diff(np.searchsorted(starts, stops), prepend=0)
        self.bounds = np.concatenate([[0], np.cumsum(words + 1)])
        place = np.arange(len(starts)) + np.repeat(np.arange(len(texts)), words)
        self.hashes = np.full(self.bounds[-1], END_HASH)
        self.hashes[place] = found
        self.starts = np.zeros(self.bounds[-1], np.int64)  # an end is the empty word
        self.ends = np.zeros(self.bounds[-1], np.int64)
        self.starts[place], self.ends[place] = starts, ends

    def words(self, at: np.ndarray) -> list[bytes]:
        data = self.data
        return [data[a:b] for a, b in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]


def _blocks(texts: pa.Array, powers: Powers) -> Iterator[tuple[int, int, Tokens]]:
    """Rows from and to, and their tokens: texts of together at most BLOCK_BYTES, or one."""
    first, held, size = 0, [], 0
    for row, text in enumerate(texts):
        letters = (text.as_py() or "").encode("utf-8").lower()
        if held and size + len(letters) > BLOCK_BYTES:
            yield first, row, Tokens(held, powers)
            first, held, size = row, [], 0
        held.append(letters)
        size += len(letters) + 1
    if held:
        yield first, first + len(held), Tokens(held, powers)


def frequent_words(counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, in order, and counts."""
    words = [w for w in counts if w != END]
    hashes = Tokens([b" ".join(words)], Powers()).hashes  # its end comes last
    n = np.array([counts[w] for w in words] + [counts.get(END, 0)], np.int64)
    order = np.argsort(hashes)
    return hashes[order], n[order]


class Head:
    """Counts of the frequent words by hash, in order of it; ``first`` is where each leading part of a hash begins."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, self.counts = hashes, counts
        bits = len(hashes).bit_length()
        self.shift = np.uint64(64 - bits)
        first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.first = np.append(first, len(hashes))

    def count(self, found: np.ndarray) -> np.ndarray:
        """The count of each word, 0 for one that is not frequent."""
        out = np.zeros(len(found), np.int64)
        part = (found >> self.shift).astype(np.int64)
        at, last = self.first[part], self.first[part + 1]
        rows = np.flatnonzero(at < last)
        at, last, found = at[rows], last[rows], found[rows]
        while len(rows):
            hit = self.hashes[at] == found
            out[rows[hit]] = self.counts[at[hit]]
            at += 1
            more = ~hit & (at < last)
            rows, at, last, found = rows[more], at[more], last[more], found[more]
        return out


def _contexts(word: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The hash of the token before each; before a text's first that of the end."""
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[bounds[:-1]] = END_HASH
    return context


def _word_key(word: np.ndarray) -> np.ndarray:
    return _mix(word ^ _M3)


def _bucket(key: np.ndarray, word: np.ndarray, head: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a bigram: its second word's, if that is rare."""
    return (np.where(head > 0, key, _mix(word)) % np.uint64(buckets)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        items = list(counts.items())
        counts.clear()
        for at in range(0, len(items), 100_000):
            part = items[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(ascii_words(text))
            counts[END] += 1
            if len(counts) > 2 * CACHE_WORDS:
                yield from out()
    yield from out()


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a value is not the one before it; the first place is one."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _bucket_filter(texts: DataFrame, head, buckets: int) -> DataFrame:
    """``bucket, size, bits``: the filter over bigrams and rare words of the training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            key = np.concatenate([h[0] for h in held])
            order = np.argsort(key)
            key = key[order]
            first = _changes(key)
            n = np.diff(np.append(first, len(key)))
            key, bucket = key[first], np.concatenate([h[1] for h in held])[order[first]]
            for at in range(0, len(key), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[part].astype(np.int32)), pa.array(key[part].view(np.int64)), pa.array(n[part].astype(np.int64))], names=["bucket", "key", "n"]
                )

        known_words, powers = Head(*head.value), Powers()
        for batch in batches:
            for _, _, tokens in _blocks(batch.column(0), powers):
                word, known = tokens.hashes, known_words.count(tokens.hashes)
                key = bigram_hash(_contexts(word, tokens.bounds), word)
                rare = known == 0
                held.append((key, _bucket(key, word, known, buckets)))
                held.append((_word_key(word[rare]), _bucket(key[rare], word[rare], known[rare], buckets)))
                size += len(key) + int(rare.sum())
                if size > TASK_NGRAMS:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)) for batch in batches if batch.num_rows]
        if not parts:
            return
        bucket, key, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.argsort(bucket, kind="stable")
        bucket, key, n = bucket[order], key[order].view(np.uint64), n[order]
        cuts = np.append(_changes(bucket), len(bucket))
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = np.argsort(key[a:b])
            keys = key[a:b][own]
            first = _changes(keys)  # the counts of all tasks meet here
            bits = build_bucket(keys[first], np.add.reduceat(n[a:b][own], first)).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket[a]], pa.int32()), pa.array([len(bits)], pa.int64()), pa.array([bits], pa.binary())], names=["bucket", "size", "bits"]
            )

    counted = texts.mapInArrow(count, "bucket int, key long, n long").repartition("bucket")
    return counted.mapInArrow(build, "bucket int, size long, bits binary")


def _segments(table: DataFrame, buckets: int, segment_bytes: int) -> Iterator[Segment]:
    """The filter in runs of buckets of at most ``segment_bytes`` (or of one bucket), one at a time."""
    sizes = np.zeros(buckets, np.int64)
    for row in table.select("bucket", "size").collect():
        sizes[row[0]] = row[1]
    first = 0
    while first < buckets:
        last = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), segment_bytes, side="right")))
        starts = np.concatenate([[0], np.cumsum(sizes[first:last]) * 8 // WORD_BITS])
        content = np.zeros(int(starts[-1]), "<u8")
        for row in table.where(f"bucket >= {first} AND bucket < {last}").select("bucket", "bits").toLocalIterator():
            content[starts[row[0] - first] : starts[row[0] - first + 1]] = np.frombuffer(row[1], "<u8")
        yield Segment(first, starts, content)
        first = last


_PARTS = "row long, doc_id long, word binary, n long, tokens long, known long, base double, score double"


def scores(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``base_score`` is the unigram log10-probability with 0.5 added to each count, ``score`` that of the bigram
    model. Null and empty texts are one end token. A null doc_id is not held out, so its text teaches;
    repeated rows teach and repeat. Without training texts both scores are those of an empty model. Other
    columns are not read.
    """
    spark = docs.sparkSession
    slim = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    train = slim.where(~held_out("doc_id")).select("text")
    counts = written(train.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    frequent = {bytes(r[0]): r[1] for r in counts.where(F.col("n") * HEAD_SHARE >= total).collect()}
    head = spark.sparkContext.broadcast(frequent_words(frequent))
    starts = frequent.get(END, 0)  # ends are in every text, so they are always frequent, unless texts are very long
    if not starts and total:
        starts = counts.where(F.col("word") == F.lit(bytearray(END))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    del frequent
    divisor = total + 0.5 * (kinds + 1)
    buckets = max(BUCKETS, -(-total // BUCKET_TOKENS))
    table = written(_bucket_filter(train, head, buckets), "lm-filter")

    def scorer(segment, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, known_words, powers = Segment(*segment.value), Head(*head.value), Powers()
            for whole in batches:
                for start, stop, tokens in _blocks(whole.column(2), powers):
                    batch, bounds = whole.slice(start, stop - start), tokens.bounds
                    word, known = tokens.hashes, known_words.count(tokens.hashes)
                    context = _contexts(word, bounds)
                    owner = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
                    extra = _seen_part(own, context, word, known, owner, batch.num_rows, divisor, buckets)
                    if not first:
                        nothing = pa.nulls(batch.num_rows, pa.int64())
                        zero = pa.array(np.zeros(batch.num_rows))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0), batch.column(1), pa.nulls(batch.num_rows, pa.binary()), nothing, nothing, nothing, zero, pa.array(extra)], names=_names()
                        )
                        continue
                    yield from _unigram_part(batch, tokens, bounds, known, owner, extra, starts, divisor)

        return run

    rows = slim.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    if table.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] > segment_bytes:
        rows = written(rows, "lm-texts")  # several passes add to each row, so its number must not be made again
    parts = None
    for number, segment in enumerate(_segments(table, buckets, segment_bytes)):
        shipped = spark.sparkContext.broadcast((segment.first, segment.starts, segment.content))
        del segment
        found = written(rows.mapInArrow(scorer(shipped, number == 0), _PARTS), "lm-parts")
        shipped.unpersist()
        parts = found if parts is None else parts.unionByName(found)
    rare = counts.where(F.col("n") * HEAD_SHARE < total).withColumnRenamed("n", "c")
    c = F.coalesce(F.col("c"), F.lit(0))
    base = F.col("n") * F.log10((c + 0.5) / F.lit(divisor))
    words = parts.where("word IS NOT NULL").join(rare, "word", "left")
    by_word = words.select(
        "row", "doc_id", "tokens", F.when(c > 0, F.col("n")).otherwise(0).alias("known"), base.alias("base"), (base - F.col("n") * F.log10(1 + c / PRIOR)).alias("score")
    )
    joined = by_word.unionByName(parts.where("word IS NULL").select("row", "doc_id", "tokens", "known", "base", "score"))
    summed = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("tokens").alias("n_tokens"),
        F.sum("known").alias("n_known"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    )
    return summed.select(
        "doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def _names() -> list[str]:
    return [c.split()[0] for c in _PARTS.split(", ")]


def _seen_part(segment: Segment, context, word, known, owner, texts: int, divisor: float, buckets: int) -> np.ndarray:
    """By text the sum of log10(1 + C(c, w) / (K p(w))) over the bigrams that the segment holds."""
    key = bigram_hash(context, word)
    bucket = _bucket(key, word, known, buckets)
    at = np.flatnonzero(segment.holds(bucket))
    level = segment.level(bucket[at], key[at])
    at, level = at[level > 0], level[level > 0]
    count = known[at].astype(float)
    rare = count == 0
    own = segment.level(bucket[at[rare]], _word_key(word[at[rare]]))
    count[rare] = np.where(own > 0, count_of(own), 0)
    gain = np.log10(1 + count_of(level) / (PRIOR * (count + 0.5) / divisor))
    return np.bincount(owner[at], weights=gain, minlength=texts)


def _unigram_part(batch, tokens, bounds, known, owner, extra, starts: int, divisor: float) -> Iterator[pa.RecordBatch]:
    """A row for each text with what its frequent words and its start give, and one for each place of a rare word."""
    texts = batch.num_rows
    frequent = known > 0
    log_p = np.log10((known + 0.5) / divisor)
    base = np.bincount(owner, weights=np.where(frequent, log_p, 0.0), minlength=texts)
    followed = frequent.copy()
    followed[bounds[1:] - 1] = False  # nothing comes after the end
    context = np.bincount(owner, weights=np.where(followed, np.log10(1 + known / PRIOR), 0.0), minlength=texts)
    score = base - context - math.log10(1 + starts / PRIOR) + extra
    nothing = pa.nulls(texts, pa.int64())
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            pa.nulls(texts, pa.binary()),
            nothing,
            pa.array(np.diff(bounds).astype(np.int64)),
            pa.array(np.bincount(owner, weights=frequent, minlength=texts).astype(np.int64)),
            pa.array(base),
            pa.array(score),
        ],
        names=_names(),
    )
    at = np.flatnonzero(~frequent)
    if not len(at):
        return
    text = pa.array(owner[at])
    size = len(at)
    zero = pa.array(np.zeros(size))
    yield pa.RecordBatch.from_arrays(
        [
            batch.column(0).take(text),
            batch.column(1).take(text),
            pa.array(tokens.words(at), pa.binary()),
            pa.array(np.ones(size, np.int64)),
            pa.array(np.zeros(size, np.int64)),
            pa.array(np.zeros(size, np.int64)),
            zero,
            zero,
        ],
        names=_names(),
    )
