"""Northbound and margin series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.scalar import num, pct
from tickloom.functions.series import BARS

INFLOW_WINDOWS = (5, 10, 30)


def inflow_sums(flow: DataFrame, min_rows: int = 0) -> DataFrame:
    """Rolling net inflow; symbols with fewer than ``min_rows`` rows keep their stored sums."""
    names = {n: f"inflow_{n}d" for n in INFLOW_WINDOWS}
    base = [c for c in flow.columns if c not in names.values()]
    sums = {n: BARS.sum("net_inflow", n) for n in INFLOW_WINDOWS}
    if min_rows:
        kept = {n: c if c in flow.columns else "NULL" for n, c in names.items()}
        rows = BARS.whole("count(*)")
        sums = {n: f"if({rows} >= {min_rows}, {sums[n]}, {kept[n]})" for n in names}
    return flow.selectExpr(*base, *(f"{sums[n]} AS {names[n]}" for n in names))


def margin_changes(margin: DataFrame) -> DataFrame:
    """Day-on-day change of each leg and of their total, over the whole history."""
    rows = margin.selectExpr(
        "stock_code",
        "trade_date",
        "rz_balance",
        "rq_balance",
        "rz_balance + rq_balance AS total_balance",
    )
    legs = ("rz", "rq", "total")
    rows = rows.selectExpr("*", *(f"{BARS.lag(f'{x}_balance')} AS {x}_before" for x in legs))
    rows = rows.selectExpr(
        "*", *(f"{x}_balance - {x}_before AS {x}_change" for x in legs[:2])
    ).selectExpr("*", "rz_change + rq_change AS total_change")
    columns = ["stock_code", "trade_date"]
    for x in legs:
        change = pct(num(f"{x}_change"), num(f"{x}_before"))
        columns += [f"{x}_balance", f"{x}_change", f"{change} AS {x}_change_pct"]
    return rows.selectExpr(*columns)
