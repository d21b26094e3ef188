"""Watermarks, overlap windows and work lists of the incremental load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import merge
from tickloom.operators.latest import latest_date

OVERLAP_DAYS = 5
LOOKBACK_DAYS = 60
LIST_WINDOW_DAYS = 20


def next_dates(symbols: DataFrame, log: DataFrame, data_type: str, start: str) -> DataFrame:
    """First day still to load per symbol: the day after the watermark, or ``start``."""
    kind = log.where(F.col("data_type") == data_type)
    marks = latest_date(kind, "stock_code", "last_update_date", "mark")
    return symbols.join(marks, "stock_code", "left").selectExpr(
        "stock_code", f"coalesce(date_add(mark, 1), date'{start}') AS next_date"
    )


def stored_watermarks(data: DataFrame, date_col: str, data_type: str) -> DataFrame:
    """The watermark is the greatest date actually stored, never the day the job ran."""
    marks = latest_date(data, "stock_code", date_col, "last_update_date")
    return marks.selectExpr("stock_code", f"'{data_type}' AS data_type", "last_update_date")


def write_watermarks(log: DataFrame, marks: DataFrame) -> DataFrame:
    return merge.upsert(log, marks, ("stock_code", "data_type"), ["last_update_date"])


def overlap_start(calendar: DataFrame, as_of: str) -> DataFrame:
    """The fifth-latest trading day up to ``as_of``: where the self-healing overlap begins.

    A list shorter than that begins at its first day. The calendar has one row per trading day.
    """
    past = calendar.where(f"trade_date <= date'{as_of}'").orderBy(F.desc("trade_date"))
    return past.limit(OVERLAP_DAYS).agg(F.min("trade_date").alias("anchor"))


def margin_start(
    symbols: DataFrame, log: DataFrame, calendar: DataFrame, as_of: str, start: str
) -> DataFrame:
    """Where each symbol's reload begins: overlap at least, look-back at most."""
    anchor = overlap_start(calendar, as_of).scalar()
    wanted = next_dates(symbols, log, "margin", start)
    return wanted.select("stock_code", F.least("next_date", anchor).alias("begin")).selectExpr(
        "stock_code",
        f"greatest(begin, date_sub(date'{as_of}', {LOOKBACK_DAYS})) AS begin_date",
    )


def reload_dates(starts: DataFrame, calendar: DataFrame, as_of: str) -> DataFrame:
    """(symbol, trading day) pairs to request, at most the look-back's days per symbol."""
    days = starts.where(f"begin_date <= date'{as_of}'").selectExpr(
        "stock_code", f"explode(sequence(begin_date, date'{as_of}')) AS trade_date"
    )
    return days.join(calendar.select("trade_date"), "trade_date", "left_semi").select(
        "stock_code", "trade_date"
    )


def rolling_window(feed: DataFrame, date_col: str, as_of: str, days: int) -> DataFrame:
    """The last ``days`` days of a feed that publishes late; re-merged in full each run."""
    return feed.where(f"{date_col} BETWEEN date_sub(date'{as_of}', {days}) AND date'{as_of}'")


def missing_symbols(master: DataFrame, table: DataFrame) -> DataFrame:
    """Symbols still without any row."""
    have = table.select("stock_code")
    return master.select("stock_code").join(have, "stock_code", "left_anti")


def watermark_ahead(log: DataFrame, data: DataFrame, data_type: str) -> DataFrame:
    """Symbols whose watermark is past their data, or that have no data at all."""
    have = latest_date(data, "stock_code", "trade_date", "max_date")
    marks = log.where(F.col("data_type") == data_type)
    ahead = marks.join(have, "stock_code", "left").where(
        "max_date IS NULL OR last_update_date > max_date"
    )
    return ahead.select("stock_code", "last_update_date", "max_date")


def month_chunks(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Each [start, end] range cut at calendar months."""
    cut = ranges.where(f"{start} <= {end}").selectExpr(
        "*", f"explode(sequence(trunc({start}, 'MM'), {end}, interval 1 month)) AS _month"
    )
    return cut.selectExpr(
        *ranges.columns,
        f"greatest(_month, {start}) AS chunk_start",
        f"least(last_day(_month), {end}) AS chunk_end",
    )
