"""Technical indicators against the plain pandas definitions, on fixtures for every null rule."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tickloom.functions.folds import ExpMean, ParabolicStop, recursive_indicators
from tickloom.operators.daily import daily_basic, fill_turnover
from tickloom.operators.technical import moving_averages, technical
from tickloom.schema import TABLES

DAY0 = dt.date(2020, 1, 1)


def _bars(symbol, closes, spread=1.0, volume=None, highs=None, lows=None):
    rows = []
    for i, c in enumerate(closes):
        high = highs[i] if highs else c + spread
        low = lows[i] if lows else c - spread
        vol = volume[i] if volume else 100 + 10 * (i % 7)
        rows.append((symbol, DAY0 + dt.timedelta(days=i), c - spread / 2, high, low, c, vol, c * vol))
    return rows


def _frame(spark, rows):
    schema = (
        "stock_code string, trade_date date, open double, high double, low double, close double, "
        "volume bigint, amount double"
    )
    return spark.createDataFrame(rows, schema)


def _walk(n, seed):
    rng = np.random.default_rng(seed)
    return [round(float(x), 2) for x in 50 + np.cumsum(rng.normal(0, 1, n))]


def _sar(high, low):
    """Straight state machine, kept apart from the library's."""
    out, up, ep, af = [low[0]], True, high[0], 0.02
    for h, lo in zip(high[1:], low[1:]):
        s = out[-1] + af * (ep - out[-1])
        if up and lo < s:
            up, s, ep, af = False, ep, lo, 0.02
        elif not up and h > s:
            up, s, ep, af = True, ep, h, 0.02
        elif up and h > ep:
            ep, af = h, min(af + 0.02, 0.2)
        elif not up and lo < ep:
            ep, af = lo, min(af + 0.02, 0.2)
        out.append(s)
    return out


def _expected(df):
    """The definitions, in pandas."""
    o, h, low, c, v = (df[x] for x in ("open", "high", "low", "close", "volume"))

    def mean(s, n):
        return s.rolling(n, min_periods=1).mean()

    def total(s, n):
        return s.rolling(n, min_periods=1).sum()

    out = pd.DataFrame({"trade_date": df["trade_date"]})
    prev = c.shift(1)
    for n in (5, 10, 20, 60):
        out[f"ma{n}"] = mean(c, n)
        out[f"bias{n}"] = (c - mean(c, n)) / mean(c, n).replace(0, np.nan) * 100
    out["ema12"] = c.ewm(span=12, adjust=False).mean()
    out["ema26"] = c.ewm(span=26, adjust=False).mean()
    out["macd_dif"] = out["ema12"] - out["ema26"]
    out["macd_dea"] = out["macd_dif"].ewm(span=9, adjust=False).mean()
    out["macd_hist"] = (out["macd_dif"] - out["macd_dea"]) * 2
    out["std20"] = c.rolling(20, min_periods=1).std()
    out["boll_mid"] = out["ma20"]
    out["boll_upper"] = out["ma20"] + 2 * out["std20"]
    out["boll_lower"] = out["ma20"] - 2 * out["std20"]
    gain, loss = (c - prev).clip(lower=0).fillna(0), (prev - c).clip(lower=0).fillna(0)
    for n in (6, 12, 24):
        out[f"rsi{n}"] = 100 - 100 / (1 + mean(gain, n) / mean(loss, n).replace(0, np.nan))
    lo9, hi9 = low.rolling(9, min_periods=1).min(), h.rolling(9, min_periods=1).max()
    rsv = ((c - lo9) / (hi9 - lo9).replace(0, np.nan) * 100).fillna(50)
    out["kdj_k"] = rsv.ewm(com=2, adjust=False).mean()
    out["kdj_d"] = out["kdj_k"].ewm(com=2, adjust=False).mean()
    out["kdj_j"] = 3 * out["kdj_k"] - 2 * out["kdj_d"]
    tp = (h + low + c) / 3
    dev = tp.rolling(20, min_periods=1).apply(lambda x: np.abs(x - x.mean()).mean(), raw=True)
    out["cci20"] = ((tp - mean(tp, 20)) / (0.015 * dev).replace(0, np.nan)).fillna(0)
    lo14, hi14 = low.rolling(14, min_periods=1).min(), h.rolling(14, min_periods=1).max()
    out["wr14"] = ((hi14 - c) / (hi14 - lo14).replace(0, np.nan) * 100).fillna(50)
    tr = pd.concat([h - low, (h - prev).abs(), (low - prev).abs()], axis=1).max(axis=1)
    out["atr14"] = mean(tr, 14)
    out["vol_ma5"], out["vol_ma10"] = mean(v, 5), mean(v, 10)
    out["obv"] = (v * np.sign(c - prev).fillna(0)).cumsum()
    up, down = (tp * v).where(tp > tp.shift(1), 0), (tp * v).where(tp < tp.shift(1), 0)
    out["mfi14"] = (100 - 100 / (1 + total(up, 14) / total(down, 14).replace(0, np.nan))).fillna(50)
    vu, vd, vf = v.where(c > prev, 0), v.where(c < prev, 0), v.where(c == prev, 0)
    half = total(vf, 24) / 2
    out["vr"] = ((total(vu, 24) + half) / (total(vd, 24) + half).replace(0, np.nan) * 100).fillna(100)
    out["dmi_pdi"] = 100 * mean(h.diff().clip(lower=0), 14) / out["atr14"].replace(0, np.nan)
    out["dmi_mdi"] = 100 * mean((-low.diff()).clip(lower=0), 14) / out["atr14"].replace(0, np.nan)
    both = out["dmi_pdi"] + out["dmi_mdi"]
    dx = 100 * (out["dmi_pdi"] - out["dmi_mdi"]).abs() / both.replace(0, np.nan)
    out["dmi_adx"] = mean(dx, 14)
    out["dmi_adxr"] = mean(out["dmi_adx"] + out["dmi_adx"].shift(14), 2)
    out["sar"] = _sar(list(h), list(low))
    out["wvad"] = ((c - o) / (h - low).replace(0, np.nan) * v).fillna(0)
    return out


FIXTURES = {
    "sh600001": _bars("sh600001", _walk(90, 1)),
    "sz000002": _bars("sz000002", _walk(75, 2), spread=0.3),
    "sz300003": _bars("sz300003", [10.0] * 20, spread=0.0),
    "sh600004": _bars("sh600004", [10.0 + i for i in range(20)] + [30.0 - 1.5 * i for i in range(20)]),
    "sh600005": _bars("sh600005", [20.0, 20.0, 21.0, 21.0, 20.0, 20.0, 19.5, 19.5]),
    "sh600006": _bars("sh600006", [7.0]),
}


@pytest.fixture(scope="module")
def computed(spark):
    rows = [r for rows in FIXTURES.values() for r in rows]
    rows = rows[::-1]
    return technical(_frame(spark, rows)).toPandas()


@pytest.mark.parametrize("symbol", [s for s in FIXTURES if s != "sh600006"])
def test_all_columns(computed, symbol):
    ours = computed[computed.stock_code == symbol].sort_values("trade_date").reset_index(drop=True)
    names = "stock_code trade_date open high low close volume amount".split()
    theirs = _expected(pd.DataFrame(FIXTURES[symbol], columns=names))
    for column in TABLES["technical_indicators"].values:
        a, b = ours[column].astype(float), theirs[column].astype(float)
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-7, err_msg=f"{symbol} {column}")


def test_single_bar_is_skipped(computed):
    assert "sh600006" not in set(computed.stock_code)


def test_flat_prices_take_their_defaults(computed):
    last = computed[computed.stock_code == "sz300003"].sort_values("trade_date").iloc[-1]
    assert (last.kdj_k, last.wr14, last.cci20, last.mfi14, last.vr) == (50, 50, 0, 50, 100)
    assert math.isnan(last.rsi6) and math.isnan(last.dmi_adx)


def test_sar_reverses_and_reaches_its_limit():
    rows = FIXTURES["sh600004"]
    stop = ParabolicStop()
    sar = stop.run([r[3] for r in rows], [r[4] for r in rows])
    assert sar == pytest.approx(_sar([r[3] for r in rows], [r[4] for r in rows]))
    assert not stop.rising


@pytest.mark.parametrize("gaps", [False, True])
def test_exponential_mean_like_pandas(gaps):
    xs = _walk(50, 3)
    if gaps:
        xs = [math.nan if i in (4, 5, 17) else x for i, x in enumerate(xs)]
    mean = ExpMean.of_span(12)
    parts = mean.run(xs[:20]) + mean.run(xs[20:])
    expected = pd.Series(xs).ewm(span=12, adjust=False).mean()
    np.testing.assert_allclose(parts, expected, rtol=1e-12)


def test_fold_does_not_depend_on_batch_sizes():
    walk = _walk(100, 4)
    table = pa.table(
        {"close": walk, "high": [x + 1 for x in walk], "low": [x - 1 for x in walk], "rsv": walk}
    )

    def run(size):
        parts = list(recursive_indicators(iter(table.to_batches(max_chunksize=size))))
        return {k: [v for p in parts for v in p[k]] for k in parts[0]}

    assert run(100) == run(7) == run(1)


def test_one_shuffle_and_no_python_in_rolling(spark):
    from tickloom.operators.technical import technical_rolling

    bars = _frame(spark, FIXTURES["sh600001"])
    plans = [f(bars)._jdf.queryExecution().executedPlan().toString() for f in (technical_rolling, technical)]
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 1]
    assert "Arrow" not in plans[0]


def test_moving_averages_need_full_windows(spark):
    out = moving_averages(_frame(spark, FIXTURES["sh600001"])).orderBy("trade_date").collect()
    assert len(out) == 86
    assert out[0].ma5 is not None and out[0].ma10 is None
    assert out[-1].ma60 == pytest.approx(np.mean([r[5] for r in FIXTURES["sh600001"]][-60:]), abs=0.006)
    assert moving_averages(_frame(spark, FIXTURES["sh600001"][:4])).count() == 0


def test_zero_previous_close_gives_null(spark):
    rows = _bars("sh600007", [0.0, 5.0, 6.0])
    out = daily_basic(_frame(spark, rows)).orderBy("trade_date").collect()
    assert out[1].change_pct is None and out[2].change_pct == pytest.approx(20.0)
    assert out[0].prev_close is None


def test_turnover_needs_a_share_count(spark):
    bars = _frame(spark, _bars("a", [1.0], volume=[50]) + _bars("b", [1.0]) + _bars("c", [1.0]))
    capital = spark.createDataFrame(
        [("a", DAY0, 500), ("a", DAY0 - dt.timedelta(1), 900), ("b", DAY0, 0)],
        "stock_code string, record_date date, total_shares bigint",
    )
    out = {r.stock_code: r.turnover for r in fill_turnover(bars, capital).collect()}
    assert out == {"a": 10.0, "b": None, "c": None}


def test_no_frame_is_as_long_as_its_longest_sum(spark):
    import re

    from tickloom.operators.technical import technical_rolling

    plan = technical_rolling(_frame(spark, FIXTURES["sh600001"]))._jdf.queryExecution().optimizedPlan().toString()
    ends = [int(n) for n in re.findall(r"RowFrame, -(\d+), currentrow", plan)]
    assert ends and max(ends) < 20 and plan.count("-19, currentrow") <= 2


def test_series_are_told_apart_whatever_the_batches(spark, computed):
    rows = [r for rows in FIXTURES.values() for r in rows]
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        ours = technical(_frame(spark, rows).coalesce(1)).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    order = ["stock_code", "trade_date"]
    pd.testing.assert_frame_equal(*(f.sort_values(order).reset_index(drop=True) for f in (ours, computed)))


def test_a_fold_takes_many_series_in_one_call(spark):
    plan = technical(_frame(spark, FIXTURES["sh600001"]))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan


def test_missing_values_in_composed_sums(spark):
    rows = [list(r) for r in FIXTURES["sh600001"]]
    for i in (0, 3, 4, 5, 30, 41, 42):
        rows[i][5] = None
    out = technical(_frame(spark, [tuple(r) for r in rows])).toPandas().sort_values("trade_date")
    close = pd.Series([r[5] for r in rows], dtype=float)
    for n in (5, 10, 20, 60):
        theirs = close.rolling(n, min_periods=1).mean()
        np.testing.assert_allclose(out[f"ma{n}"].astype(float), theirs, rtol=1e-9)
