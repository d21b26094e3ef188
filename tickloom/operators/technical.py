"""Technical indicators of daily bars.

Window stages and one fold, all on (stock_code, trade_date): one shuffle, one sort. Rolling windows
take what the start of a series offers; each indicator has its own value for an undefined ratio
(NULL, 0, 50 or 100).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.folds import MEANS, FOLD_COLUMNS, STATE_COLUMNS, fold_series, recursive_indicators
from tickloom.functions.scalar import floor_at_zero, ndiv, num, pct
from tickloom.functions.series import BARS, mean_abs_deviation
from tickloom.operators.scan import exp_means
from tickloom.schema import TABLES

MA_WINDOWS = (5, 10, 20, 60)
RSI_WINDOWS = (6, 12, 24)

ROLLING_COLUMNS = (
    "ma5", "ma10", "ma20", "ma60", "boll_mid", "boll_upper", "boll_lower",
    "bias5", "bias10", "bias20", "bias60", "rsi6", "rsi12", "rsi24",
    "cci20", "wr14", "atr14", "std20", "vol_ma5", "vol_ma10", "obv", "mfi14", "vr",
    "dmi_pdi", "dmi_mdi", "dmi_adx", "dmi_adxr", "wvad",
)

_KEY = ("stock_code", "trade_date")


def _steps(daily: DataFrame) -> DataFrame:
    """Row-to-row changes. Symbols with a single bar have no neighbour and drop out."""
    bars = daily.selectExpr(
        *_KEY, *(f"{num(c)} AS {c}" for c in ("open", "high", "low", "close", "volume"))
    ).selectExpr("*", "(high + low + close) / 3 AS tp")
    lagged = bars.selectExpr(
        "*",
        *(f"{BARS.lag(c)} AS prev_{c}" for c in ("close", "high", "low", "tp")),
        f"coalesce({BARS.lag('trade_date')}, {BARS.lead('trade_date')}) AS neighbour",
    ).where("neighbour IS NOT NULL")
    return lagged.selectExpr(
        *_KEY, "open", "high", "low", "close", "volume", "tp",
        "if(close > prev_close, close - prev_close, 0D) AS gain",
        "if(close < prev_close, prev_close - close, 0D) AS loss",
        "greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS tr",
        "if(tp > prev_tp, tp * volume, 0D) AS flow_up",
        "if(tp < prev_tp, tp * volume, 0D) AS flow_down",
        "if(close > prev_close, volume, 0D) AS vol_up",
        "if(close < prev_close, volume, 0D) AS vol_down",
        "if(close = prev_close, volume, 0D) AS vol_flat",
        f"{floor_at_zero('high - prev_high')} AS dm_up",
        f"{floor_at_zero('prev_low - low')} AS dm_down",
    )


#: What each sum over a few rows is taken of; of NULLs it takes none, so those columns are counted beside it.
_SHORT = {5: ("close", "tp", "volume"), 6: ("gain", "loss", "vol_up", "vol_down", "vol_flat"), 7: ("tr", "flow_up", "flow_down", "dm_up", "dm_down")}
_COUNTED = ("close", "tp", "volume", "tr", "dm_up", "dm_down")


def _sums(columns: Sequence[str], n: int) -> list[str]:
    """The names of the sums over n rows, and of the counts that belong to them."""
    return [f"{c}_{kind}{n}" for c in columns for kind in ("sum", "n") if kind == "sum" or c in _COUNTED]


def _longer(columns: Sequence[str], n: int, m: int) -> list[str]:
    """Sums over m rows from those over n."""
    steps = range(n, m, n)
    return [f"{BARS.longer(one, *steps)} AS {more}" for one, more in zip(_sums(columns, n), _sums(columns, m))]


def _mean(x: str, n: int) -> str:
    return f"try_divide({x}_sum{n}, {x}_n{n})"


def _rolled(daily: DataFrame) -> DataFrame:
    """Every rolling aggregate the indicators need.

    A frame of n rows costs n additions a row. Sums over many rows are put together from sums over 5 to 7 rows that end at
    this row and at earlier ones; nothing is subtracted, so they are as exact as sums over the whole frame.
    """
    w = BARS
    bars = [*_KEY, "open", "high", "low", "close", "volume", "tp"]
    at_hand = [*bars, "obv", "std20", "tp_values"]
    short = _steps(daily).selectExpr(
        *bars,
        *(f"coalesce({w.sum(c, n)}, 0D) AS {c}_sum{n}" for n, columns in _SHORT.items() for c in columns),
        *(f"double({w.last_rows(f'count({c})', n)}) AS {c}_n{n}" for n, columns in _SHORT.items() for c in columns if c in _COUNTED),
        f"{w.min('low', 7)} AS low7",
        f"{w.max('high', 7)} AS high7",
        f"{w.std('close', 20)} AS std20",
        f"{w.values('tp', 20)} AS tp_values",
        f"{w.so_far('sum(coalesce(vol_up - vol_down, 0D))')} AS obv",
    )
    longer = short.selectExpr(
        *at_hand, *_sums(_SHORT[5], 5), *_sums(("gain", "loss"), 6),
        *_longer(_SHORT[5], 5, 10), *_longer(_SHORT[6], 6, 12), *_longer(_SHORT[7], 7, 14),
        *(f"least(low7, {w.lag('low7', n - 7)}) AS low{n}" for n in (9, 14)),
        *(f"greatest(high7, {w.lag('high7', n - 7)}) AS high{n}" for n in (9, 14)),
    )
    rest = [c for c in longer.columns if c not in _sums(("vol_up", "vol_down", "vol_flat"), 12)]
    longer = longer.selectExpr(*rest, *_longer(("close", "tp"), 10, 20), *_longer(_SHORT[6], 12, 24))
    longer = longer.selectExpr("*", *_longer(("close",), 20, 60))
    return longer.selectExpr(
        *at_hand, "low9", "low14", "high9", "high14",
        *(f"{_mean('close', n)} AS ma{n}" for n in MA_WINDOWS),
        *(f"{side}_sum{n} AS {side}{n}" for side in ("gain", "loss") for n in RSI_WINDOWS),
        f"{_mean('tp', 20)} AS tp_mean",
        f"{_mean('tr', 14)} AS atr14",
        *(f"{_mean('volume', n)} AS vol_ma{n}" for n in (5, 10)),
        *(f"{c}_sum14 AS {c}14" for c in ("flow_up", "flow_down")),
        *(f"{c}_sum24 AS {c}24" for c in ("vol_up", "vol_down", "vol_flat")),
        *(f"{_mean(c, 14)} AS {c}14" for c in ("dm_up", "dm_down")),
    )


def _indicators(daily: DataFrame) -> DataFrame:
    def strength(up: str, down: str) -> str:
        return f"100 - try_divide(100D, 1 + {ndiv(up, down)})"

    deviation = mean_abs_deviation("tp_values", "tp_mean")
    base = _rolled(daily).selectExpr(
        *_KEY, "open", "high", "low", "close", "volume",
        *(f"ma{n}" for n in MA_WINDOWS), "std20", "atr14", "vol_ma5", "vol_ma10", "obv",
        "ma20 AS boll_mid",
        "ma20 + 2 * std20 AS boll_upper",
        "ma20 - 2 * std20 AS boll_lower",
        *(f"{pct(f'close - ma{n}', f'ma{n}')} AS bias{n}" for n in MA_WINDOWS),
        *(f"{strength(f'gain{n}', f'loss{n}')} AS rsi{n}" for n in RSI_WINDOWS),
        f"coalesce({pct('close - low9', 'high9 - low9')}, 50D) AS rsv",
        f"coalesce({ndiv('tp - tp_mean', f'0.015D * {deviation}')}, 0D) AS cci20",
        f"coalesce({pct('high14 - close', 'high14 - low14')}, 50D) AS wr14",
        f"coalesce({strength('flow_up14', 'flow_down14')}, 50D) AS mfi14",
        f"coalesce({pct('vol_up24 + vol_flat24 / 2', 'vol_down24 + vol_flat24 / 2')}, 100D) AS vr",
        f"{pct('dm_up14', 'atr14')} AS dmi_pdi",
        f"{pct('dm_down14', 'atr14')} AS dmi_mdi",
        f"coalesce({ndiv('close - open', 'high - low')} * volume, 0D) AS wvad",
    )
    dx = pct("abs(dmi_pdi - dmi_mdi)", "dmi_pdi + dmi_mdi")
    base = base.selectExpr("*", f"{dx} AS dx")
    base = base.selectExpr("*", f"coalesce({BARS.sum('dx', 7)}, 0D) AS dx_sum7", f"double({BARS.last_rows('count(dx)', 7)}) AS dx_n7")
    base = base.selectExpr("*", f"{BARS.longer('dx_sum7', 7)} AS dx_sum14", f"{BARS.longer('dx_n7', 7)} AS dx_n14")
    base = base.selectExpr("*", f"{_mean('dx', 14)} AS dmi_adx").drop("dx", "dx_sum7", "dx_n7", "dx_sum14", "dx_n14")
    base = base.selectExpr("*", f"dmi_adx + {BARS.lag('dmi_adx', 14)} AS adx_pair", f"{BARS.lag('dmi_adx')} + {BARS.lag('dmi_adx', 15)} AS adx_pair_before")
    both = "(coalesce(adx_pair, 0D) + coalesce(adx_pair_before, 0D))"
    known = "(int(adx_pair IS NOT NULL) + int(adx_pair_before IS NOT NULL))"
    return base.selectExpr("*", f"try_divide({both}, {known}) AS dmi_adxr").drop("adx_pair", "adx_pair_before")


def technical_rolling(daily: DataFrame) -> DataFrame:
    """The indicators that are window expressions: no Python anywhere in the plan."""
    return _indicators(daily).select(*_KEY, *ROLLING_COLUMNS)


def _finished(folded: DataFrame) -> DataFrame:
    return folded.selectExpr(
        "*",
        "ema12 - ema26 AS macd_dif",
        "(ema12 - ema26 - macd_dea) * 2 AS macd_hist",
        "3 * kdj_k - 2 * kdj_d AS kdj_j",
    )


def technical(daily: DataFrame, columns: Sequence[str] = TABLES["technical_indicators"].columns) -> DataFrame:
    """The key and the named ones of the 37 indicators, by default all.

    The optimizer does not look into the fold, so windows that are not asked for are left out here, and the fold
    itself where only windows or keys are.
    """
    wanted = [*_KEY, *(c for c in columns if c not in _KEY)]
    rolling = [c for c in wanted if c in ROLLING_COLUMNS]
    if len(_KEY) + len(rolling) == len(wanted):
        return _indicators(daily).select(wanted)
    windowed = _indicators(daily).select(*_KEY, "close", "high", "low", "rsv", *rolling)
    folded = fold_series(
        windowed, "stock_code", "trade_date", FOLD_COLUMNS, recursive_indicators
    )
    return _finished(folded).select(wanted)


SCANNED_COLUMNS = ("ema12", "ema26", "macd_dif", "macd_dea", "macd_hist", "kdj_k", "kdj_d", "kdj_j")


def technical_scanned(daily: DataFrame, block: str = "year(trade_date)") -> DataFrame:
    """EMA, MACD and KDJ by prefix scans, for series too long for one task; ``block`` as in :func:`exp_means`.

    The parabolic stop is no linear recurrence and stays with the fold of :func:`technical`.
    """
    rows = _indicators(daily).select(*_KEY, "close", "rsv")
    one = exp_means(rows, *_KEY, block, {m: (c, MEANS[m]) for m, c in (("ema12", "close"), ("ema26", "close"), ("kdj_k", "rsv"))})
    one = one.selectExpr("*", "ema12 - ema26 AS macd_dif")
    two = exp_means(one, *_KEY, block, {m: (c, MEANS[m]) for m, c in (("macd_dea", "macd_dif"), ("kdj_d", "kdj_k"))})
    return two.selectExpr("*", "(macd_dif - macd_dea) * 2 AS macd_hist", "3 * kdj_k - 2 * kdj_d AS kdj_j").select(*_KEY, *SCANNED_COLUMNS)


#: A window of windows looks back on no more rows than these.
LOOK_BACK = 61


def _with_state(folded: DataFrame) -> DataFrame:
    full = _finished(folded)
    return full.select(*TABLES["technical_indicators"].columns, "window_from", "month_end", *(c for c in STATE_COLUMNS if c not in FOLD_COLUMNS))


def technical_with_states(daily: DataFrame) -> DataFrame:
    """All indicators and behind them what :func:`fold_states` takes: the fold's state after each row."""
    windowed = _snapshot_marks(_indicators(daily).drop("open", "volume"))
    return _with_state(fold_series(windowed, *_KEY, STATE_COLUMNS, recursive_indicators))


def _snapshot_marks(windowed: DataFrame) -> DataFrame:
    """Whether a row is the last of its month so far, and the day from which bars are read to go on after it."""
    month = "trunc(trade_date, 'MM')"
    return windowed.selectExpr(
        "*",
        f"{BARS.lag('trade_date', LOOK_BACK)} AS window_from",
        f"{month} <> coalesce({BARS.lead(month)}, date'9999-12-01') AS month_end",
    )


def fold_states(rows: DataFrame) -> DataFrame:
    """The state of each symbol at its month ends, from rows of :func:`technical_with_states`."""
    return rows.where("month_end").select(*_KEY, "window_from", "obv", *STATE_COLUMNS)


def technical_since(daily: DataFrame, starts: DataFrame, states: DataFrame) -> DataFrame:
    """Indicators from each symbol's ``first_day`` on, equal to those of :func:`technical_with_states` of all bars.

    ``starts`` (stock_code, first_day) are the symbols with new or changed bars and the first day of these;
    ``states`` the snapshots of the bars before the change. A symbol is continued from its newest snapshot before that
    day: bars are read from there, and as far back as its windows look. One without a snapshot is computed whole.
    All rows of such a symbol are returned, of the others those from ``first_day`` on.
    """
    held = [c for c in states.columns if c != "stock_code"]
    before = states.join(starts, "stock_code").where("trade_date < first_day")
    newest = before.groupBy("stock_code").agg(F.max_by(F.struct(*held), "trade_date").alias("_state"))
    named = {"trade_date": "from_day", "window_from": "read_from"}
    begin = starts.join(newest, "stock_code", "left").selectExpr(
        "stock_code", "if(_state IS NULL, date'0001-01-01', first_day) AS since",
        *(f"_state.{c} AS {named.get(c, f'from_{c}')}" for c in held),
    )
    bars = daily.join(begin.select("stock_code", "read_from"), "stock_code").where("read_from IS NULL OR trade_date >= read_from")
    windowed = _snapshot_marks(_indicators(bars.drop("read_from")).drop("open", "volume"))
    going = windowed.join(begin.drop("read_from"), "stock_code")
    at_start = BARS.whole("max(if(trade_date = from_day, obv, NULL))")
    going = going.selectExpr("*", f"coalesce(from_obv - {at_start}, 0D) AS _obv_before").where("from_day IS NULL OR trade_date > from_day")
    folded = fold_series(going, *_KEY, STATE_COLUMNS, recursive_indicators, grouped=True)
    moved = folded.withColumn("obv", F.expr("obv + _obv_before"))
    full = _finished(moved).where("trade_date >= since")
    return full.select(*_with_state(folded).columns)


def moving_averages(daily: DataFrame) -> DataFrame:
    """Full-window averages only, two digits; rows before the first one are left out."""
    out = daily.selectExpr(
        *_KEY, *(f"{BARS.full_mean('close', n, 2)} AS ma{n}" for n in MA_WINDOWS)
    )
    return out.where("coalesce(ma5, ma10, ma20, ma60) IS NOT NULL")
