"""Toxicity by two class-conditional Kneser-Ney models, one of toxic and one of ordinary texts.

The models spell words letter by letter (five letters of context, the word's start and end among them).
Counts of the highest order belong to a class; what a class has not seen falls back to continuation
counts that both classes share, so a rare expression is judged by how its parts continue and not by
the accident of having been seen in one class only. A word's evidence is the difference of its two
log-likelihoods divided by its length; a text's evidence is that of its strongest word, because one
insult in a long text makes it toxic. A logistic curve fitted on out-of-fold evidence turns it into a
score. Only the text enters a score.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import kept, written

CONTEXT = 5
DISCOUNT = 0.75
FOLDS = 3
#: From this score on a text counts as toxic.
REJECT_SCORE = 0.3
#: The models are fitted on about this many labelled rows at most (picked by a hash of doc_id).
SAMPLE_ROWS = 100_000
#: Words whose evidence a worker remembers for each fit; emptied when full.
CACHE_WORDS = 100_000
#: The same for the fit that scores: a worker holds its values only, which leaves room for more words.
SCORED_WORDS = 300_000
#: Counts a task holds before it hands them on.
TASK_COUNTS = 300_000

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def runs_of(word: str) -> list[str]:
    """The letter runs whose last letter is predicted from those before it."""
    marked = f"^{word}$"
    return [marked[max(0, i - CONTEXT) : i + 1] for i in range(1, len(marked))]


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.expr(f"crc32(CAST(CAST({doc_id} AS STRING) AS BINARY)) % {modulus}")


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, toxic, fold`` of the labelled documents outside the held-out quarter.

    Labels other than 0 and 1, or without an id, do not count; of several labels of one id the highest
    does. Beyond ``sample_rows`` labels a hash of the id picks that share of them, so what is broadcast
    is bounded by the parameter.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .where(remainder("doc_id", 4) != 2)
    )
    count = known.count()
    if count > sample_rows:
        known = known.where(F.expr(f"pmod(xxhash64(doc_id), {1 << 30}) < {(1 << 30) * sample_rows // count}"))
    known = known.withColumn("fold", F.expr(f"CAST(pmod(xxhash64(doc_id, 7), {FOLDS}) AS INT)"))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.join(F.broadcast(known), "doc_id")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        items = iter(counts.items())
        while part := list(islice(items, 50_000)):
            yield pa.RecordBatch.from_pydict(
                {"word": [k[0] for k, _ in part], "part": pa.array([k[1] for k, _ in part], pa.int32()), "n": [n for _, n in part]}
            )
        counts.clear()

    for batch in batches:
        for text, toxic, fold in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            part = toxic * FOLDS + fold
            for word, n in Counter(words_of(text)).items():
                counts[word, part] += n
            if len(counts) > TASK_COUNTS:
                yield from out()
    yield from out()


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out() -> Iterator[pa.RecordBatch]:
        items = iter(counts.items())
        while part := list(islice(items, 50_000)):
            yield pa.RecordBatch.from_pydict(
                {"run": [k[0] for k, _ in part], "part": pa.array([k[1] for k, _ in part], pa.int32()), "n": [n for _, n in part]}
            )
        counts.clear()

    for batch in batches:
        for word, part, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for run in runs_of(word):
                counts[run, part] += n
            if len(counts) > TASK_COUNTS:
                yield from out()
    yield from out()


class Model:
    """Log-likelihood differences of several fits: of seen runs, and of an unseen letter after a seen context."""

    words = CACHE_WORDS

    def __init__(self, seen: pa.Table, unseen: pa.Table):
        def index(table: pa.Table) -> dict[str, int]:
            return dict(zip(table.column(0).to_pylist(), range(table.num_rows), strict=True))

        def columns(table: pa.Table) -> list[list[float]]:
            return [table.column(i).to_pylist() for i in range(1, table.num_columns)]

        self.seen, self.unseen = index(seen), index(unseen)
        self.seen_values, self.unseen_values = columns(seen), columns(unseen)
        self.caches: list[dict[str, float]] = [{} for _ in self.seen_values]

    def word(self, word: str, fit: int) -> float:
        """The word's evidence: toxic minus ordinary log-likelihood, by letter."""
        total, seen, unseen = 0.0, self.seen_values[fit], self.unseen_values[fit]
        runs = runs_of(word)
        for run in runs:
            at = self.seen.get(run)
            if at is not None:
                total += seen[at]
            elif (at := self.unseen.get(run[:-1])) is not None:
                total += unseen[at]
        return total / len(runs)

    def text(self, text: str | None, fit: int) -> float:
        """The strongest word's evidence; of a text without words zero."""
        words, cache = set(words_of(text)), self.caches[fit]
        values = list(map(cache.get, words))
        if None in values:
            for at, word in enumerate(words):
                if values[at] is None:
                    if len(cache) >= self.words:
                        cache.clear()
                    values[at] = cache[word] = self.word(word, fit)
        return max(values, default=0.0)


class Scorer(Model):
    """The last fit of a :class:`Model` alone, a run's value beside it."""

    words = SCORED_WORDS

    def __init__(self, seen: pa.Table, unseen: pa.Table):
        def values(table: pa.Table) -> dict[str, float]:
            return dict(zip(table.column(0).to_pylist(), table.column(table.num_columns - 1).to_pylist(), strict=True))

        self.seen, self.unseen = values(seen), values(unseen)
        self.caches = [{}]

    def word(self, word: str, fit: int = 0) -> float:
        total, unseen = 0.0, self.unseen
        runs = runs_of(word)
        for run, value in zip(runs, map(self.seen.get, runs), strict=True):
            total += unseen.get(run[:-1], 0.0) if value is None else value
        return total / len(runs)


_WIDTH = CONTEXT + 1


def _letters(runs: np.ndarray) -> np.ndarray:
    """Runs as rows of code points, zero after their end."""
    return runs.view(np.uint32).reshape(-1, _WIDTH)


def _ends(runs: np.ndarray) -> np.ndarray:
    """Every run without its first letter."""
    out = np.zeros((len(runs), _WIDTH), np.uint32)
    out[:, :-1] = _letters(runs)[:, 1:]
    return out.view(runs.dtype).ravel()


def _contexts(runs: np.ndarray) -> np.ndarray:
    """Every run without its last letter."""
    out = _letters(runs).copy()
    out[np.arange(len(runs)), (out != 0).sum(axis=1) - 1] = 0
    return out.view(runs.dtype).ravel()


def shared_probabilities(runs: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney over both classes, for each run without its first letter.

    A run counts by how many different letters it follows. Arrays of fixed width keep this small.
    """
    length = (_letters(runs) != 0).sum(axis=1)
    follows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    level = runs[:0]
    for size in range(_WIDTH, 0, -1):
        level = np.union1d(level, runs[length == size])
        level, count = np.unique(_ends(level), return_counts=True)
        follows[size - 1] = level, count
    out = np.full(len(runs), 1.0 / (len(follows[1][0]) + 1))
    lower_names, lower = follows[0][0], out[:1]
    for size in range(1, _WIDTH):
        names, count = follows[size]
        if not len(names):
            break
        _, code = np.unique(_contexts(names), return_inverse=True)
        base = lower[np.searchsorted(lower_names, _ends(names))]
        value = (count - DISCOUNT + DISCOUNT * np.bincount(code)[code] * base) / np.bincount(code, weights=count)[code]
        asked = np.flatnonzero(length == size + 1)
        out[asked] = value[np.searchsorted(names, _ends(runs[asked]))]
        lower_names, lower = names, value
    return out


def fit(runs: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[pa.Table, pa.Table]:
    """Tables of a :class:`Model`: for each pair of (ordinary, toxic) counts of the runs a column."""
    base = shared_probabilities(runs)
    contexts, code = np.unique(_contexts(runs), return_inverse=True)
    seen, unseen = {"run": pa.array(runs)}, {"context": pa.array(contexts)}
    for number, pair in enumerate(counts):
        log, left_log = [], []
        for n in pair:
            total = np.bincount(code, weights=n)
            left = np.where(total > 0, DISCOUNT * np.bincount(code, weights=n > 0) / np.maximum(total, 1), 1.0)
            own = total[code]
            log.append(np.log(np.maximum(n - DISCOUNT, 0) / np.maximum(own, 1) + left[code] * base))
            left_log.append(np.log(left))
        seen[str(number)] = pa.array((log[1] - log[0]).astype(np.float32))
        unseen[str(number)] = pa.array((left_log[1] - left_log[0]).astype(np.float32))
    return pa.table(seen), pa.table(unseen)


def logistic(points: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset from (evidence, label, count), with smoothed targets, by damped Newton steps."""
    x = np.array([p[0] for p in points], float)
    y = np.array([p[1] for p in points], float)
    w = np.array([p[2] for p in points], float)
    ones, zeros = float((w * y).sum()), float((w * (1 - y)).sum())
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    slope, offset = 0.0, math.log((ones + 1) / (zeros + 1))

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((w * (np.logaddexp(0, z) - target * z)).sum() + 1e-3 * a * a)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
        g = np.array([(w * (p - target) * x).sum() + 2e-3 * slope, (w * (p - target)).sum()])
        v = w * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 2e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-9]])
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        size, now = 1.0, loss(slope, offset)
        while size > 1e-6 and loss(slope - size * step[0], offset - size * step[1]) > now:
            size /= 2
        slope, offset = slope - size * step[0], offset - size * step[1]
        if np.abs(size * step).max() < 1e-7:
            break
    return max(slope, 0.0), offset


def scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score`` for every row of ``docs``; labels teach outside the held-out quarter only.

    Null, empty and wordless texts have evidence zero. Without toxic or without ordinary labels every
    score is the smoothed share of toxic labels, zero without any label. A null doc_id is never held out
    and has no label. Repeated rows repeat; other columns are not read.
    """
    spark = docs.sparkSession
    rows = training_rows(docs, labels, sample_rows)
    words = rows.select("text", "toxic", "fold").mapInArrow(_count_words, "word string, part int, n long")
    words = words.groupBy("word", "part").agg(F.sum("n").alias("n"))
    runs = words.mapInArrow(_count_runs, "run string, part int, n long").groupBy("run").pivot("part", list(range(2 * FOLDS))).sum("n").na.fill(0)
    runs = written(runs, "toxicity-runs")
    parts = [f"`{i}`" for i in range(2 * FOLDS)]
    size = runs.agg(*[F.sum(p) for p in parts]).first()
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    if not sum(n or 0 for n in size[:FOLDS]) or not sum(n or 0 for n in size[FOLDS:]):
        share = rows.agg(F.expr("coalesce(sum(toxic) / (count(*) + 1.0), 0.0)")).first()[0]
        return slim.select("doc_id", held_out, F.lit(float(share)).alias("score"))
    table = runs.toArrow()
    names = table.column("run").to_numpy().astype(f"U{_WIDTH}")
    n = [table.column(str(i)).to_numpy().astype(np.float64) for i in range(2 * FOLDS)]
    del table
    ordinary, toxic = sum(n[:FOLDS]), sum(n[FOLDS:])
    # the first fits leave a fold out each, the last has all
    tables = fit(names, [(ordinary - n[f], toxic - n[FOLDS + f]) for f in range(FOLDS)] + [(ordinary, toxic)])
    del n, names
    shipped, name = spark.sparkContext.broadcast(tables), uuid.uuid4().hex

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(name, lambda: Model(*shipped.value))
        for batch in batches:
            texts, toxics, parts = (batch.column(i).to_pylist() for i in range(3))
            value = [round(model.text(t, f), 2) for t, f in zip(texts, parts, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(value, pa.float64()), pa.array(toxics, pa.int32())], names=["x", "toxic"])

    bins = rows.select("text", "toxic", "fold").mapInArrow(check, "x double, toxic int").groupBy("x", "toxic").count().collect()
    slope, offset = logistic([(r[0], r[1], r[2]) for r in bins])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = kept(f"{name}-last", lambda: Scorer(*shipped.value))
        for batch in batches:
            x = np.array([model.text(t, 0) for t in batch.column(1).to_pylist()], float)
            value = 1 / (1 + np.exp(-np.clip(slope * x + offset, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["doc_id", "score"])

    return slim.mapInArrow(score, "doc_id long, score double").select("doc_id", held_out, "score")
