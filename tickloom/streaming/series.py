"""Recursive indicators of a stream of bars: the fold's state, kept per symbol between micro-batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.folds import FOLD_COLUMNS, STATE_COLUMNS, Recursion
from tickloom.functions.scalar import num

#: Bars whose range the stochastic looks back on, the current one included.
RANGE_ROWS = 9
_STATE = ", ".join(["last_day date", "rows long", "highs array<double>", "lows array<double>", *(f"{c} double" for c in STATE_COLUMNS)])
_OUTPUT = ", ".join(["stock_code string", "trade_date date", "late boolean", *(f"{c} double" for c in FOLD_COLUMNS)])


class SeriesProcessor(StatefulProcessor):
    """Folds a symbol's new bars into its state; the state is a handful of numbers however long the series is.

    Bars of a micro-batch come in any order and are sorted; of a repeated day the last counts. A bar of a
    day that is already folded cannot be taken back: it is returned as late, without indicators, for the
    batch job that recomputes from that day on. The first bar of a series is returned with the second, as
    a series of one bar has no indicators.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("series", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        bars = pd.concat(list(rows), ignore_index=True)
        bars = bars.sort_values("trade_date", kind="stable")
        count, highs, lows, series, last_day = 0, [], [], Recursion(), None
        first = None
        if self._state.exists():
            last_day, count, highs, lows, *numbers = self._state.get()
            kept = dict(zip(STATE_COLUMNS, (np.nan if n is None else n for n in numbers), strict=True))
            series, highs, lows = Recursion(kept), list(highs), list(lows)
            first = {"trade_date": last_day, **{c: kept[c] for c in FOLD_COLUMNS}} if count == 1 else None
        late = bars[bars["trade_date"] <= last_day] if last_day is not None else bars.iloc[:0]
        if len(late):
            yield self._frame(key[0], late["trade_date"].tolist(), {}, True)
        new = bars.drop(late.index).drop_duplicates("trade_date", keep="last")
        if not len(new):
            return
        close, high, low = (new[c].to_numpy(float) for c in ("close", "high", "low"))
        above = pd.Series([np.nan if h is None else h for h in highs] + high.tolist()).rolling(RANGE_ROWS, min_periods=1).max()
        below = pd.Series([np.nan if x is None else x for x in lows] + low.tolist()).rolling(RANGE_ROWS, min_periods=1).min()
        above, below = above.to_numpy()[len(highs) :], below.to_numpy()[len(lows) :]
        spread = above - below
        with np.errstate(divide="ignore", invalid="ignore"):
            rsv = np.where(spread != 0, (close - below) / spread * 100, np.nan)
        out = series.run(close, high, low, np.where(np.isnan(rsv), 50.0, rsv))
        days = new["trade_date"].tolist()
        back = RANGE_ROWS - 1
        numbers = [None if np.isnan(out[c][-1]) else float(out[c][-1]) for c in STATE_COLUMNS]
        recent = ([None if x is None or np.isnan(x) else float(x) for x in (old + now.tolist())[-back:]] for old, now in ((highs, high), (lows, low)))
        self._state.update((days[-1], count + len(days), *recent, *numbers))
        if count + len(days) == 1:
            return
        columns = {c: out[c] for c in FOLD_COLUMNS}
        if first is not None:
            days = [first["trade_date"], *days]
            columns = {c: np.concatenate([[first[c]], columns[c]]) for c in FOLD_COLUMNS}
        yield self._frame(key[0], days, columns, False)

    @staticmethod
    def _frame(symbol: str, days: list, columns: dict[str, np.ndarray], late: bool) -> pd.DataFrame:
        empty = np.full(len(days), np.nan)
        return pd.DataFrame({"stock_code": symbol, "trade_date": days, "late": late, **{c: columns.get(c, empty) for c in FOLD_COLUMNS}})

    def close(self) -> None:
        pass


def recursive_stream(bars: DataFrame) -> DataFrame:
    """``stock_code, trade_date, late`` and EMA, MACD, KDJ and SAR of a stream of bars, as the batch fold has them.

    Start the query inside :func:`keyed_state`.
    """
    numbers = bars.selectExpr("stock_code", "trade_date", *(f"{num(c)} AS {c}" for c in ("close", "high", "low")))
    folded = numbers.groupBy("stock_code").transformWithStateInPandas(
        SeriesProcessor(), outputStructType=_OUTPUT, outputMode="Append", timeMode="None"
    )
    clean = [f"{num(c)} AS {c}" for c in FOLD_COLUMNS]
    return folded.selectExpr("stock_code", "trade_date", "late", *clean).selectExpr(
        "*", "ema12 - ema26 AS macd_dif", "(ema12 - ema26 - macd_dea) * 2 AS macd_hist", "3 * kdj_k - 2 * kdj_d AS kdj_j"
    )


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started in here keep their state in RocksDB, which the processor needs; the session keeps its setting."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


# Ship this module with the processor, so that executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
