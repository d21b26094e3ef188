"""Landed data to derived tables, for all symbols at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.daily import DERIVED as DAILY_DERIVED
from tickloom.operators.daily import with_daily_basic
from tickloom.operators.flows import inflow_sums
from tickloom.operators.fundamentals import fundamentals
from tickloom.operators.incremental import stored_watermarks, write_watermarks
from tickloom.operators.technical import fold_states, technical_since, technical_with_states
from tickloom.operators.valuation import DIVIDEND_DAYS, valuation
from tickloom.schema import TABLES
from tickloom.sources.tables import (
    Landing,
    Store,
    _remove,
    commit_version,
    conform,
    has_table,
    land,
    latest_version,
    merge_landed,
    read_version,
    scan,
    staging,
)

DERIVED = (
    "stock_daily",
    "technical_indicators",
    "financial_intermediate",
    "valuation_indicators",
    "northbound_flow",
)

DERIVED_FROM = ("stock_daily", "stock_capital", "financial_statements", "dividends", "northbound_flow")


#: State of the recursive indicators by symbol and month, from which a run goes on.
STATES = "fold_states"


def derive(tables: Mapping[str, DataFrame], as_of: str) -> dict[str, DataFrame]:
    """The five derived tables as lazy frames at their stored scales, and the states behind the indicators."""
    return {**_derive_rest(tables, as_of), **_from_series(technical_with_states(tables["stock_daily"]))}


def _series_with_states(series: DataFrame) -> DataFrame:
    """Indicators as stored, and in each symbol's last row of a month the state, from which :func:`_states_in` takes it."""
    held = ", ".join(c for c in fold_states(series).columns if c not in TABLES["technical_indicators"].keys)
    return conform(series, "technical_indicators", [f"if(month_end, struct({held}), NULL) AS _state"])


def _states_in(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/technical_indicators")
    return rows.where("_state IS NOT NULL").select(*TABLES["technical_indicators"].keys, "_state.*")


def _from_series(series: DataFrame) -> dict[str, DataFrame]:
    return {"technical_indicators": conform(series, "technical_indicators"), STATES: fold_states(series)}


def _derive_rest(tables: Mapping[str, DataFrame], as_of: str) -> dict[str, DataFrame]:
    bars, capital = tables["stock_daily"], tables["stock_capital"]
    figures = conform(
        fundamentals(tables["financial_statements"], capital), "financial_intermediate"
    )
    values = valuation(bars, figures, capital, tables["dividends"], as_of)
    return {
        "stock_daily": conform(with_daily_basic(bars), "stock_daily"),
        "financial_intermediate": figures,
        "valuation_indicators": conform(values, "valuation_indicators"),
        "northbound_flow": conform(
            inflow_sums(tables["northbound_flow"], min_rows=5), "northbound_flow"
        ),
    }


#: Derived tables that are not made for the named symbols alone.
_SEPARATE = ("technical_indicators", "valuation_indicators")


def _underived(bars: DataFrame) -> DataFrame:
    """Bars without the columns that are derived anew: several tables read them, and what they come from may have to be derived itself."""
    return bars.select([c for c in bars.columns if c not in DAILY_DERIVED])


#: One row in each version: the day its dividend year ends on.
RUN = "derived_run"


def _leaving(dividends: DataFrame, before: str, as_of: str) -> DataFrame:
    """Symbols with dividends that are in the year before one of two days, but not the other."""
    first, last = (f"date_sub({f}(date'{before}', date'{as_of}'), {DIVIDEND_DAYS})" for f in ("least", "greatest"))
    return dividends.where(f"dividend_date >= {first} AND dividend_date < {last}").select("stock_code")


def recompute(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    as_of: str,
    root: str,
    symbols: DataFrame | None = None,
    first_days: DataFrame | None = None,
) -> int:
    """Derive the tables and commit them as one version under ``root``.

    With ``symbols`` (a frame with ``stock_code``) only theirs are derived and replace their rows of
    the newest version, and so are the valuations of symbols whose dividends enter or leave the year before
    ``as_of`` since that version; all others are copied as they are, and a table of which nothing changes is
    that of the newest version. With ``first_days`` (stock_code, first_day)
    indicators are derived for those symbols only and from those days on, going on from the stored state before
    them. The result is that of a full run.
    """
    run = spark.createDataFrame([(as_of,)], "as_of string")
    version = latest_version(spark, root)
    with staging(spark, root) as stage:
        if symbols is None or version is None or not has_table(spark, root, RUN, version):
            given = {name: tables[name] for name in DERIVED_FROM}
            if not isinstance(tables, Store):
                given["stock_daily"] = stage(_underived(given["stock_daily"]))
            series = _series_with_states(technical_with_states(given["stock_daily"]))
            frames = {**_derive_rest(given, as_of), "technical_indicators": series, STATES: partial(_states_in, spark), RUN: run}
            return commit_version(spark, frames, root)
        before = read_version(spark, root, RUN, version).first().as_of
        # Lists of symbols are written, so that Spark knows their size: old rows are not shuffled to meet a short one.
        wanted = stage(symbols.select("stock_code").distinct())
        valued = wanted
        if before != as_of:  # only valuations depend on the day
            valued = stage(wanted.unionByName(_leaving(tables["dividends"], before, as_of)).distinct())
        old = {name: read_version(spark, root, name, version) for name in (*DERIVED, STATES)}
        frames: dict[str, DataFrame | Callable[[str], DataFrame]] = {RUN: run}
        given = {name: tables[name] for name in DERIVED_FROM}
        if not isinstance(tables, Store) and first_days is None and not valued.isEmpty():
            given["stock_daily"] = stage(_underived(given["stock_daily"]).join(valued, "stock_code", "left_semi"))
        for chosen, names in ((wanted, [n for n in DERIVED if n not in _SEPARATE]), (valued, ["valuation_indicators"])):
            if chosen.isEmpty():
                continue
            fresh = _derive_rest({name: rows.join(chosen, "stock_code", "left_semi") for name, rows in given.items()}, as_of)
            frames |= {n: old[n].join(chosen, "stock_code", "left_anti").unionByName(fresh[n]) for n in names}
        if first_days is None and not wanted.isEmpty():
            # Whole series need no states: they are derived as in a full run, and the states are taken from what it stores.
            bars = given["stock_daily"].join(wanted, "stock_code", "left_semi")
            series = _series_with_states(technical_with_states(bars)).where("trade_date >= date'0001-01-01'")
            others = {n: old[n].join(wanted, "stock_code", "left_anti") for n in ("technical_indicators", STATES)}
            frames["technical_indicators"] = others["technical_indicators"].unionByName(series, allowMissingColumns=True)
            frames[STATES] = lambda folder: others[STATES].unionByName(_states_in(spark, folder))
        elif first_days is not None:
            starts = stage(first_days.groupBy("stock_code").agg(F.min("first_day").alias("first_day")))
            if not starts.isEmpty():
                series = stage(technical_since(given["stock_daily"], starts, old[STATES]))
                states = starts.join(old[STATES], "stock_code", "left").groupBy("stock_code", "first_day")
                known = states.agg(F.bool_or(F.col("trade_date") < F.col("first_day")).alias("known"))
                cut = stage(known.selectExpr("stock_code", "if(known, first_day, date'0001-01-01') AS since"))
                for name, fresh in _from_series(series).items():
                    kept = old[name].join(cut, "stock_code", "left").where("since IS NULL OR trade_date < since").drop("since")
                    frames[name] = kept.unionByName(fresh)
        return commit_version(spark, frames, root, (version, [n for n in (*DERIVED, STATES) if n not in frames]))


def load(
    spark: SparkSession, landed: Mapping[str, DataFrame], root: str, unreadable: Mapping[str, DataFrame] | None = None
) -> dict[str, Landing]:
    """Merge landed rows month by month, then advance the watermarks in one commit.

    ``unreadable`` are the rows that a table's feed could not parse (``feeds.unreadable``); they go to its
    ``rejects`` as they landed, next to the rows that cannot be stored.

    Each landed frame is read once: what cannot be stored goes to ``rejects`` with a reason, and counts
    and NULLs are observed, in the pass that writes the rows; merge and watermarks read what it wrote. ``rejects`` and
    ``load_report`` are those of the last load. A job that dies in between leaves the old watermarks, so the next run
    loads the same rows again, to the same result. Watermarks are taken from what is stored, so they are
    never ahead of the data and a backfill does not move them back.
    """
    marks, out, before = None, {}, Store(spark, f"{root}/tables")
    folder = f"{root}/landing/{uuid.uuid4().hex}"
    for table, rows in landed.items():
        spec = TABLES[table]
        out[table] = landing = land(rows, spec, f"{folder}/{table}")
        rejects = landing.rejects
        if unreadable and table in unreadable:
            rejects = rejects.unionByName(unreadable[table], allowMissingColumns=True)
        rejects.write.mode("overwrite").parquet(f"{root}/rejects/{table}")
        known = table in before
        if landing.rows > landing.rejected:
            merge_landed(spark, landing.good, f"{root}/tables", table, [c for c in rows.columns if c in spec.values])
        if "stock_code" in spec.keys and spec.date_col in rows.columns and landing.rows > landing.rejected:
            # A row per symbol meets a row per symbol: the stored rows are not shuffled to meet all that landed.
            part = stored_watermarks(scan(spark, f"{root}/tables", table), spec.date_col, table)
            if known:  # else all that is stored has landed now
                part = part.join(landing.good.select("stock_code").distinct(), "stock_code", "left_semi")
            marks = part if marks is None else marks.unionByName(part)
    report = [
        (t, c, x.rows, x.rejected, n) for t, x in out.items() for c, n in x.nulls.items()
    ]  # a row for each column of each table
    fields = "table_name string, column_name string, rows long, rejected long, nulls long"
    spark.createDataFrame(report, fields).coalesce(1).write.mode("overwrite").parquet(f"{root}/load_report")
    if marks is not None:
        log_root = f"{root}/update_log"
        log = conform(marks, "update_log")
        if latest_version(spark, log_root) is not None:
            log = write_watermarks(read_version(spark, log_root, "update_log"), marks)
        commit_version(spark, {"update_log": log}, log_root)
    return out


def load_and_derive(
    spark: SparkSession, landed: Mapping[str, DataFrame], as_of: str, root: str
) -> int:
    """The whole update: merge, watermarks, then the derived tables from the stored ones.

    Symbols without landed rows keep their derived rows. Once rows are merged, the folder they landed in goes.
    """
    touched, first_days, loaded = None, None, load(spark, landed, root)
    for table, landing in loaded.items():
        if "stock_code" in landed[table].columns:
            part = landing.good.select("stock_code")
            touched = part if touched is None else touched.unionByName(part)
        if table == "stock_daily":
            first_days = landing.good.groupBy("stock_code").agg(F.min("trade_date").alias("first_day"))
    if first_days is None and touched is not None:
        first_days = touched.limit(0).selectExpr("stock_code", "date(NULL) AS first_day")
    with staging(spark, root) as stage:
        lists = [rows if rows is None else stage(rows.distinct()) for rows in (touched, first_days)]
        for landing in loaded.values():
            _remove(spark, landing.folder)
        return recompute(spark, Store(spark, f"{root}/tables"), as_of, f"{root}/derived", *lists)


def updated(spark: SparkSession, root: str) -> Store:
    """What :func:`load_and_derive` stored under ``root``: raw tables, the derived ones before them, the log."""
    return Store(spark, f"{root}/tables", (f"{root}/derived", f"{root}/update_log"))
