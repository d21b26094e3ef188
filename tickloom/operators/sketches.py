"""Partial aggregates by month that are stored and merged on reading.

Counts and dates merge exactly. Distinct symbols are HyperLogLog sketches (relative standard error 1.6 %),
quantiles are KLL sketches (rank error 1.4 % of the rows at the usual confidence), so a
profile of all history reads one small row per month, and an update recomputes the months it touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalar import num
from tickloom.sources.tables import commit_version, latest_version, read_version

#: Sizes of the sketches: 2^12 registers, and the accuracy parameter of the quantiles.
LG_REGISTERS, ACCURACY = 12, 200
#: Bounds that the sketches keep with better than 99 % confidence.
SYMBOL_ERROR, RANK_ERROR = 0.05, 0.02


def month_sketches(df: DataFrame, day: str, columns: Sequence[str] = ()) -> DataFrame:
    """A row for each month of ``day``: rows, dates, symbols and the quantiles of ``columns``.

    The sketches are built on the map side, so a task sends one row per month.
    """
    return df.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(
        F.count("*").alias("rows"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.expr(f"hll_sketch_agg(stock_code, {LG_REGISTERS})").alias("symbols"),
        *(F.expr(f"kll_sketch_agg_double({num(c)}, {ACCURACY})").alias(f"{c}_sketch") for c in columns),
        *(F.expr(f"count({num(c)})").alias(f"{c}_known") for c in columns),
    )


def merged(sketches: DataFrame, columns: Sequence[str] = (), points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row from the sketches of any months: counts, dates, symbols and quantiles at ``points``."""
    together = sketches.agg(
        F.sum("rows").alias("rows"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.expr("hll_sketch_estimate(hll_union_agg(symbols))").alias("symbols"),
        *(F.expr(f"kll_merge_agg_double(if({c}_known > 0, {c}_sketch, NULL))").alias(f"{c}_sketch") for c in columns),
        *(F.sum(f"{c}_known").alias(f"{c}_known") for c in columns),
    )
    asked = f"array({', '.join(f'{p!r}D' for p in points)})"
    return together.selectExpr(
        "rows", "first_date", "last_date", "symbols", *(f"{c}_known" for c in columns),
        *(f"if({c}_known > 0, kll_sketch_get_quantile_double({c}_sketch, {asked}), NULL) AS {c}_quantiles" for c in columns),
    )


def store_sketches(spark: SparkSession, df: DataFrame, root: str, name: str, day: str, columns: Sequence[str] = ()) -> int:
    """Sketches of the months in ``df`` (their whole rows) in place of the stored ones of those months."""
    fresh = month_sketches(df, day, columns)
    version = latest_version(spark, root)
    if version is not None:
        old = read_version(spark, root, name, version)
        fresh = old.join(fresh.select("month"), "month", "left_anti").unionByName(fresh)
    return commit_version(spark, {name: fresh}, root)


def stored_profile(spark: SparkSession, root: str, name: str, columns: Sequence[str] = (), first: str = "", last: str = "9999-12") -> DataFrame:
    """The profile of the stored months between two, both included."""
    months = read_version(spark, root, name).where(F.col("month").between(first, last))
    return merged(months, columns)
