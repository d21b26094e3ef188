"""Filters shared by the read queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_codes(text: str | None) -> list[str]:
    """Comma-separated symbols, blanks dropped."""
    return [c.strip() for c in (text or "").split(",") if c.strip()]


def checked_limit(limit: int | None) -> int | None:
    """None asks for all rows; otherwise the first ``limit`` of the order."""
    if limit is not None and limit < 1:
        raise ValueError(f"limit must be positive, got {limit}")
    return limit


def range_query(
    df: DataFrame,
    symbol: str | None = None,
    date_col: str = "trade_date",
    start: str | None = None,
    end: str | None = None,
    extra: Sequence[Column] = (),
    order_by: Sequence[Column] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Symbol, inclusive date range and further predicates; newest first unless told otherwise.

    All of it stays declarative, so symbol and dates reach the Parquet scan as pushed filters, and
    order plus limit become one top-n instead of a sort of the table.
    """
    if symbol:
        df = df.where(F.col("stock_code") == symbol)
    if start:
        df = df.where(F.col(date_col) >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col(date_col) <= F.lit(end).cast("date"))
    for predicate in extra:
        df = df.where(predicate)
    order = [F.col(date_col).desc()] if order_by is None else list(order_by)
    if order:
        df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def in_list(df: DataFrame, column: str, wanted: Sequence[str] | DataFrame) -> DataFrame:
    """Short lists as IN, frames as a semi join."""
    if isinstance(wanted, DataFrame):
        keys = wanted.select(F.col(wanted.columns[0]).alias(column))
        return df.join(keys, column, "left_semi")
    return df.where(F.col(column).isin(list(wanted))) if wanted else df


def excluding(df: DataFrame, exceptions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Leave out documented exceptions."""
    return df.join(exceptions.select(*keys), list(keys), "left_anti")
