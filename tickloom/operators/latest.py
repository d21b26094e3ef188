"""Latest row, top rows and duplicate removal per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def narrow(tables: Mapping[str, DataFrame], table: str, *columns: str) -> DataFrame:
    """Some columns of a table; tables that can derive fewer columns for less (``narrow``) do so."""
    own = getattr(tables, "narrow", None)
    return own(table, columns) if own else tables[table].select(*columns)


def latest_value(
    df: DataFrame, keys: str | Sequence[str], order: str, *values: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The given columns at the greatest ``order`` of each key; among equals at the greatest ``ties``.

    Without ties fixed-width columns keep this a hash aggregate with map-side combine: a hot key
    shrinks to one row per task before the shuffle. ``ties`` are for tables with several rows of a
    key on one date; there aggregation sorts, but still combines on the map side.
    """
    by = F.struct(order, *ties) if ties else F.col(order)
    picked = [F.max_by(v, by).alias(v) for v in values if v != order]
    if order in values:
        picked.append(F.max(order).alias(order))
    out = df.where(F.col(order).isNotNull()).groupBy(*_names(keys)).agg(*picked)
    return out.select(*_names(keys), *values)


def latest_date(df: DataFrame, keys: str | Sequence[str], order: str, name: str) -> DataFrame:
    return df.groupBy(*_names(keys)).agg(F.max(order).alias(name))


def top_rows(df: DataFrame, keys: str | Sequence[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each key; Spark limits each group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*_names(keys)).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def keep_last(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """One row per key: the last one in landing order, which must be a column."""
    return top_rows(df, keys, 1, *(F.col(c).desc_nulls_last() for c in order))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)
