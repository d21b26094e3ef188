"""Corporate-risk events per symbol and their summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import text_literal
from tickloom.operators.filters import range_query
from tickloom.operators.latest import latest_value, top_rows
from tickloom.schema import TABLES
from tickloom.sources.feeds import DECREASE

EVENT_TABLES = (
    "risk_pledge", "risk_holder_change", "risk_buyback", "risk_unlock", "risk_holder_num",
)

# Buyback states that count as ongoing, and risk levels.
ONGOING = ("实施中", "董事会预案", "股东大会通过")
LEVEL_NONE, LEVEL_LOW, LEVEL_MIDDLE, LEVEL_HIGH = "无质押记录(视为零质押)", "低", "中", "高"
NO_EVENTS = (
    "该股票暂无风险面数据(可能采集尚未覆盖, 或确实零质押/无相关公告; ETF 无风险面属正常)"
)
HORIZON_DAYS = 90
TREND_ROWS = 4


def risk_events(tables: Mapping[str, DataFrame], symbol: str | None) -> dict[str, DataFrame]:
    """The five event lists of one symbol or of all, newest first."""
    out = {}
    for name in EVENT_TABLES:
        order = [F.col(TABLES[name].date_col).desc()]
        if name == "risk_holder_change":
            order.append(F.col("holder_name").asc())
        out[name] = range_query(tables[name], symbol, order_by=order)
    return out


def risk_level(ratio: str) -> str:
    none, low, middle, high = (
        text_literal(t) for t in (LEVEL_NONE, LEVEL_LOW, LEVEL_MIDDLE, LEVEL_HIGH)
    )
    return (
        f"CASE WHEN {ratio} IS NULL THEN {none} WHEN {ratio} <= 5 THEN {low} "
        f"WHEN {ratio} <= 20 THEN {middle} ELSE {high} END"
    )


def holder_trend(holder_num: DataFrame) -> DataFrame:
    """The four newest counts of each symbol as one ordered array."""
    newest = top_rows(holder_num, "stock_code", TREND_ROWS, F.desc("stat_date"))
    return newest.groupBy("stock_code").agg(
        F.expr(
            "sort_array(collect_list(struct(stat_date, holder_num, change_ratio)), false) "
            "AS holder_num_trend"
        )
    )


def risk_summary(tables: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """One row per listed symbol, from one small aggregate per event table."""
    since = f"date_sub(date'{as_of}', {HORIZON_DAYS})"
    until = f"date_add(date'{as_of}', {HORIZON_DAYS})"
    pledge = latest_value(
        tables["risk_pledge"], "stock_code", "trade_date", "trade_date", "pledge_ratio"
    ).selectExpr(
        "stock_code", "pledge_ratio AS latest_pledge_ratio", "trade_date AS latest_pledge_date"
    )
    reduced = f"change_type = {text_literal(DECREASE)} AND announcement_date >= {since}"
    running = f"progress IN ({', '.join(text_literal(t) for t in ONGOING)})"
    due = f"free_date BETWEEN date'{as_of}' AND {until}"
    # A zero actual count reads as "not known yet", so the planned one stands in.
    freed = "coalesce(nullif(actual_free_shares, 0), free_shares, 0)"
    totals = {
        "risk_holder_change": (
            "count(*) AS holder_rows",
            f"count_if({reduced}) AS reduce_count_recent_90d",
        ),
        "risk_buyback": (
            "count(*) AS buyback_rows",
            f"count_if({running}) AS ongoing_buyback_count",
            f"sum(if({running}, coalesce(done_amount, 0), NULL)) AS ongoing_buyback_amount",
        ),
        "risk_unlock": (
            "count(*) AS unlock_rows",
            f"count_if({due}) AS unlock_upcoming_90d_count",
            f"sum(if({due}, {freed}, NULL)) AS unlock_upcoming_90d_shares",
        ),
    }
    parts = [
        tables[table].groupBy("stock_code").agg(*(F.expr(a) for a in aggregates))
        for table, aggregates in totals.items()
    ]
    counts = tables["risk_holder_num"]
    newest = latest_value(counts, "stock_code", "stat_date", "holder_num")
    parts += [newest.withColumnRenamed("holder_num", "holder_num_latest"), holder_trend(counts)]
    rows = tables["stock_master"].select("stock_code").join(pledge, "stock_code", "left")
    for part in parts:
        rows = rows.join(part, "stock_code", "left")
    seen = "latest_pledge_date, holder_rows, buyback_rows, unlock_rows, holder_num_trend"
    nothing = " AND ".join(f"{c} IS NULL" for c in seen.split(", "))
    zeroed = (
        "reduce_count_recent_90d", "ongoing_buyback_count", "ongoing_buyback_amount",
        "unlock_upcoming_90d_count", "unlock_upcoming_90d_shares",
    )
    return rows.selectExpr(
        "stock_code",
        "latest_pledge_ratio",
        "latest_pledge_date",
        f"{risk_level('latest_pledge_ratio')} AS risk_level",
        *(f"coalesce({c}, 0) AS {c}" for c in zeroed),
        "holder_num_latest",
        "holder_num_trend",
        f"if({nothing}, {text_literal(NO_EVENTS)}, NULL) AS note",
    )
