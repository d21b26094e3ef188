"""Exponential means as a prefix scan, so that one long series spreads over tasks.

A step of the mean, y' = c y + (1 - c) x, is an affine map of y, and affine maps compose. Each block of a series
is reduced to one map, in parallel; composing those of a series, one row per block, gives the mean that each
block begins with; with it every block is filled in, again in parallel. Two passes over the rows, whatever
the length of a series, against one that a single task has to make in order.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.functions.folds import ExpMean, _floats, _run_starts


@dataclass(frozen=True)
class Stretch:
    """What consecutive rows do to a mean: its value at their last known row is keep * (at the first) + add.

    ``first`` rows precede the first known one, whose value is ``x``; ``aged`` follow the last. Without a
    known row only ``aged`` counts.
    """

    first: int = 0
    x: float = math.nan
    keep: float = 1.0
    add: float = 0.0
    aged: int = 0

    @classmethod
    def of(cls, xs: np.ndarray, alpha: float) -> Stretch:
        known = np.flatnonzero(~np.isnan(xs))
        if not len(known):
            return cls(aged=len(xs))
        past = (1 - alpha) ** np.diff(known)
        from_zero = xs.copy()
        from_zero[known[0]] = 0.0
        add = ExpMean(alpha).means(from_zero)[known[-1]]
        return cls(int(known[0]), float(xs[known[0]]), float(np.prod(past / (past + alpha))), float(add), len(xs) - 1 - int(known[-1]))

    def then(self, later: Stretch, alpha: float) -> Stretch:
        """Both, one after the other."""
        if math.isnan(later.x):
            return Stretch(self.first, self.x, self.keep, self.add, self.aged + later.aged)
        if math.isnan(self.x):
            return Stretch(self.aged + later.first, later.x, later.keep, later.add, later.aged)
        past = (1 - alpha) ** (self.aged + later.first + 1)
        c = past / (past + alpha)
        return Stretch(
            self.first, self.x, later.keep * c * self.keep, later.keep * (c * self.add + (1 - c) * later.x) + later.add, later.aged
        )

    @property
    def mean(self) -> float:
        """At the end of a series that begins with these rows."""
        return self.keep * self.x + self.add


class Runs:
    """Consecutive stretches of one batch, all worked on in one go."""

    def __init__(self, starts: np.ndarray, rows: int):
        self.starts, self.rows = starts, rows
        self.ends = np.append(starts[1:], rows)
        self.run = np.repeat(np.arange(len(starts)), self.ends - starts)

    def _maps(self, xs: np.ndarray, alpha: float):
        """For each row: its run's first known row, whether it is known, what rows since the first do to a mean."""
        at, known = np.arange(self.rows), ~np.isnan(xs)
        first = np.minimum.reduceat(np.where(known, at, self.rows), self.starts)
        before = np.maximum.accumulate(np.where(known, at, -1))  # the newest known row, of whichever run
        later = known & (at > first[self.run])
        past = (1 - alpha) ** (at - np.concatenate([[0], before[:-1]]))
        step = np.where(later, past / (past + alpha), 1.0)
        keep = pd.Series(step).groupby(self.run).cumprod().to_numpy()
        from_zero = np.where(at == first[self.run], 0.0, xs)
        add = pd.Series(from_zero).groupby(self.run).ewm(alpha=alpha, adjust=False, ignore_na=False).mean().to_numpy()
        return first, before, keep, add

    def stretches(self, xs: np.ndarray, alpha: float) -> list[np.ndarray]:
        """The parts of each run's :class:`Stretch`."""
        first, before, keep, add = self._maps(xs, alpha)
        some, size = first < self.rows, self.ends - self.starts
        end = self.ends - 1
        return [
            np.where(some, first - self.starts, 0.0),
            np.where(some, xs[np.minimum(first, self.rows - 1)], math.nan),
            np.where(some, keep[end], 1.0),
            np.where(some, add[end], 0.0),
            np.where(some, end - before[end], size).astype(float),
        ]

    def means(self, xs: np.ndarray, alpha: float, begin: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, float]:
        """The means of all rows, each run begun with ``begin`` that is ``gap`` rows old, and the age of the last."""
        # Every run behind the mean it is begun with, which then counts as its first value.
        whole = np.insert(xs, self.starts, begin)
        own = np.insert(self.run, self.starts, np.arange(len(self.starts)))
        values = pd.Series(whole).groupby(own).ewm(alpha=alpha, adjust=False, ignore_na=False).mean().to_numpy()
        values = np.delete(values, self.starts + np.arange(len(self.starts)))
        for i in np.flatnonzero((gap > 0) & ~np.isnan(begin)):
            mean, rows = ExpMean(alpha), slice(self.starts[i], self.ends[i])
            mean.value, mean.aged = float(begin[i]), int(gap[i])
            values[rows] = mean.means(xs[rows])
        known = np.flatnonzero(~np.isnan(xs[self.starts[-1] :]))
        size = self.rows - self.starts[-1]
        age = size - 1 - known[-1] if len(known) else gap[-1] + size
        return values, 0 if math.isnan(values[-1]) else age


_PARTS = ("first", "x", "keep", "add", "aged")


def exp_means(df: DataFrame, key: str, order: str, block: str, means: Mapping[str, tuple[str, float]]) -> DataFrame:
    """``df`` with the exponential means ``{name: (column, alpha)}`` of each series.

    ``block`` is an expression over ``df`` that never falls along a series (the year of a day, or a row number
    divided by some thousands); each of its values is a unit of parallel work, so it bounds how much of a series one task
    handles. Missing values age the mean as in :class:`ExpMean`.
    """
    # A row without a key or a block meets no start. Said here, the two readers of ``rows`` are the same plan, and Spark makes it once.
    rows = df.selectExpr("*", f"{block} AS _block").where(f"{key} IS NOT NULL AND _block IS NOT NULL")
    rows = rows.repartition(key, "_block").sortWithinPartitions(key, "_block", order)
    names, unit = df.columns, [key, "_block"]
    kind = [rows.schema[c] for c in unit]
    summary = T.StructType([*kind, T.StructField("_part", T.LongType())])
    for name in means:
        for part in _PARTS:
            summary = summary.add(f"{name}_{part}", T.DoubleType())

    fields = summary.names

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(b for b in batches if b.num_rows):
            runs = Runs(_run_starts(*(batch.column(c) for c in unit)), batch.num_rows)
            parts = [pa.array(v) for c, alpha in means.values() for v in runs.stretches(_floats(batch, c), alpha)]
            of = batch.select(unit).take(pa.array(runs.starts))
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(np.full(len(runs.starts), number)), *parts], names=fields)

    carried = T.StructType(list(kind))
    for name in means:
        carried = carried.add(f"{name}_from", T.DoubleType()).add(f"{name}_gap", T.LongType())

    def compose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        series, so_far, block_of = None, {}, None
        for frame in frames:
            found: list[tuple] = []
            for symbol, block, _, *parts in frame.itertuples(index=False, name=None):
                if series is None or symbol != series:
                    series, block_of, so_far = symbol, None, {m: Stretch() for m in means}
                if block != block_of:
                    found.append((symbol, block, *(v for m in means for v in (so_far[m].mean, so_far[m].aged))))
                    block_of = block
                for i, (m, (_, alpha)) in enumerate(means.items()):
                    first, x, keep, add, aged = parts[5 * i : 5 * i + 5]
                    so_far[m] = so_far[m].then(Stretch(int(first), x, keep, add, int(aged)), alpha)
            yield pd.DataFrame(found, columns=carried.names)

    # Blocks of a series, one row per block (or per batch that a block is cut into), are put together in one place.
    blocks = rows.mapInArrow(reduce, summary).repartition(key).sortWithinPartitions(key, "_block", "_part")
    starts = blocks.mapInPandas(compose, carried)
    wide = rows.join(starts, unit).sortWithinPartitions(key, "_block", order)
    out = T.StructType(list(df.schema.fields))
    for name in means:
        out = out.add(name, T.DoubleType())

    filled = out.names

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = Runs(_run_starts(*(batch.column(c) for c in unit)), batch.num_rows)
            own = [tuple(batch.column(c)[int(i)].as_py() for c in unit) for i in (runs.starts[0], runs.starts[-1])]
            new = []
            for name, (column, alpha) in means.items():
                begin, gap = (_floats(batch, f"{name}_{c}")[runs.starts] for c in ("from", "gap"))
                if own[0] == last:
                    begin[0], gap[0] = state[name]
                values, ages = runs.means(_floats(batch, column), alpha, begin, gap)
                state[name] = values[-1], ages
                new.append(pa.array(values, pa.float64(), from_pandas=True))
            last = own[1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], names=filled)

    return wide.mapInArrow(fill, out)


# Ship this module with its functions, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
