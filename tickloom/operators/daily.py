"""Derived daily-bar columns and the turnover fill."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.scalar import ndiv, num, pct, positive, rounded
from tickloom.functions.series import BARS
from tickloom.operators.latest import latest_value


DERIVED = (
    "prev_close", "change_pct", "amplitude", "body_size", "upper_shadow", "lower_shadow",
    "high_20", "low_20", "high_60", "low_60",
)


def with_daily_basic(daily: DataFrame) -> DataFrame:
    """The bars with prev_close, change, amplitude, candle parts and 20/60-row extremes replaced.

    The columns are added where the bars already are: no join back.
    """
    own = [c for c in daily.columns if c not in DERIVED]
    o, h, low, c = (num(x) for x in ("open", "high", "low", "close"))
    bars = daily.selectExpr(
        *own,
        f"{BARS.lag(c)} AS prev_close",
        *(f"{BARS.max(h, n)} AS high_{n}" for n in (20, 60)),
        *(f"{BARS.min(low, n)} AS low_{n}" for n in (20, 60)),
    )
    parts = {
        "prev_close": "prev_close",
        "change_pct": pct(f"{c} - prev_close", "prev_close"),
        "amplitude": pct(f"{h} - {low}", "prev_close"),
        "body_size": f"abs({c} - {o})",
        "upper_shadow": f"{h} - greatest({o}, {c})",
        "lower_shadow": f"least({o}, {c}) - {low}",
        **{f"{side}_{n}": f"{side}_{n}" for n in (20, 60) for side in ("high", "low")},
    }
    return bars.selectExpr(*own, *(f"{parts[d]} AS {d}" for d in DERIVED))


def daily_basic(daily: DataFrame) -> DataFrame:
    """Only the key and the derived columns."""
    return with_daily_basic(daily).select("stock_code", "trade_date", *DERIVED)


def fill_turnover(daily: DataFrame, capital: DataFrame) -> DataFrame:
    """Outstanding shares and turnover percent from the latest share count.

    Total shares stand in for the float; no count, or one not above zero, leaves both NULL.
    """
    shares = latest_value(capital, "stock_code", "record_date", "total_shares")
    joined = daily.drop("turnover", "outstanding_share").join(shares, "stock_code", "left")
    count = positive("total_shares")
    return joined.selectExpr(
        *(c for c in joined.columns if c != "total_shares"),
        f"{count} AS outstanding_share",
        f"{rounded(f'{ndiv(num('volume'), num(count))} * 100', 6)} AS turnover",
    )
