"""The update path: landed rows, stored tables, watermarks, and reading what was stored."""

from __future__ import annotations

import uuid

from checks.present import Check
from pyspark.sql import functions as F

from tickloom.operators import quality
from tickloom.operators.valuation import valuation
from tickloom.plans import queries as Q
from tickloom.plans.pipeline import load, load_and_derive, recompute, updated
from tickloom.session import shared_folder
from tickloom.sources.buckets import bucketed, replace_symbols, store_bucketed
from tickloom.sources.market_views import AS_OF, RISK_AS_OF, MarketTables, view
from tickloom.sources.tables import export, read_version, scan

KEY, DAY = "stock_code", "trade_date"
SPLIT = "1995-06-30"
#: A third of the symbols.
CHOSEN = f"right({KEY}, 1) IN ('1', '4', '7')"
#: Inflows at this scale exceed their column when they are large.
SCALE = 10**13


def _root(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _loaded(spark, d):
    """New days twice over, each row repeated and some without a key, and then a backfill of old days."""
    root, rows = _root(spark, "updates"), view(spark, d, "northbound_rows")
    new = rows.where(f"trade_date > date'{SPLIT}'")
    nameless = new.withColumn(KEY, F.lit(None).cast("string"))
    for _ in range(2):
        load(spark, {"northbound_flow": new.unionByName(new).unionByName(nameless)}, root)
    load(spark, {"northbound_flow": rows.where(f"trade_date <= date'{SPLIT}'")}, root)
    return root


def _update_twice(spark, d):
    return scan(spark, f"{_loaded(spark, d)}/tables", "northbound_flow")


def _watermarks(spark, d):
    return read_version(spark, f"{_loaded(spark, d)}/update_log", "update_log")


def _rejected(spark, d):
    root = _root(spark, "rejects")
    rows = view(spark, d, "northbound_rows").withColumn("net_inflow", F.col("net_inflow").cast("double") * SCALE)
    load(spark, {"northbound_flow": rows}, root)
    return spark.read.parquet(f"{root}/rejects/northbound_flow")


def _report(spark, d):
    """What the loading pass itself counted: rows in, rows set aside, and NULLs of each column among the rest."""
    root = _root(spark, "report")
    rows = view(spark, d, "northbound_rows").withColumn("net_inflow", F.col("net_inflow").cast("double") * SCALE)
    keyless = rows.limit(0).unionByName(rows.withColumn(KEY, F.lit(None).cast("string")))
    load(spark, {"northbound_flow": rows.withColumn("holding_value", F.lit(None).cast("double")).unionByName(keyless)}, root)
    return spark.read.parquet(f"{root}/load_report").where("column_name IN ('net_inflow', 'holding_shares', 'holding_value', 'inflow_5d')")


def _market(spark, d):
    landed = {n: MarketTables(spark, d)[n] for n in ("stock_master",)}
    landed |= {
        "stock_daily": view(spark, d, "bars"), "financial_statements": view(spark, d, "statements"),
        "stock_capital": view(spark, d, "capital"), "dividends": view(spark, d, "dividends"),
        "northbound_flow": view(spark, d, "northbound_rows"),
    }
    root = _root(spark, "market")
    load_and_derive(spark, landed, AS_OF, root)
    return updated(spark, root)


def _stored_info(spark, d):
    return Q.basic_info(_market(spark, d))


def _stored_counts(spark, d):
    return quality.table_counts(spark, _market(spark, d), ("stock_daily", "stock_master", "northbound_flow", "margin_trading"))


def _differing(one, two):
    """How many rows either has beyond the other, repeats included, in one grouping of both."""
    both = one.withColumn("_side", F.lit(1)).unionByName(two.withColumn("_side", F.lit(-1)))
    sides = both.groupBy(*one.columns).agg(F.sum("_side").alias("surplus"))
    return sides.agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("differing"))


def _recomputed_symbols(spark, d):
    """Everything derived once, then half of the symbols again: rows that differ, by table."""
    root, tables, out = _root(spark, "again"), MarketTables(spark, d), None
    full = recompute(spark, tables, AS_OF, root)
    half = tables["stock_master"].where("pmod(crc32(cast(stock_code AS binary)), 2) = 0").select(KEY)
    part = recompute(spark, tables, AS_OF, root, half)
    for name in ("stock_daily", "technical_indicators", "valuation_indicators"):
        one, two = (read_version(spark, root, name, v) for v in (full, part))
        differing = _differing(one, two)
        row = two.selectExpr(f"'{name}' AS table_name", "count(*) AS rows").crossJoin(differing)
        out = row if out is None else out.unionByName(row)
    return out


def _recomputed_on_another_day(spark, d):
    """A full run, a run without landed rows a quarter later, and a full run of that day: valuations that differ."""
    root, other, tables, out = _root(spark, "days"), _root(spark, "day"), MarketTables(spark, d), None
    recompute(spark, tables, RISK_AS_OF, root)
    part = recompute(spark, tables, AS_OF, root, tables["stock_master"].where("false").select(KEY))
    recompute(spark, tables, AS_OF, other)
    one, two = read_version(spark, root, "valuation_indicators", part), read_version(spark, other, "valuation_indicators")
    differing = _differing(one, two)
    return two.selectExpr("count(*) AS rows", "round(sum(dividend_yield), 2) AS yields").crossJoin(differing)


def _bucketed(spark, d, names=("stock_daily", "financial_intermediate", "stock_capital", "dividends")):
    """The named tables stored by symbol; then the bars of a third of the symbols replaced by their later half."""
    root, tables = _root(spark, "buckets"), MarketTables(spark, d)
    for name in names:
        store_bucketed(tables[name], root, name, 8)
    later = bucketed(spark, root, "stock_daily").drop("bucket").where(f"{CHOSEN} AND {DAY} > date'{SPLIT}'")
    replace_symbols(later, root, "stock_daily")
    return {n: bucketed(spark, root, n).drop("bucket") for n in names}


def _bucketed_values(spark, d):
    held = _bucketed(spark, d)
    return valuation(held["stock_daily"], held["financial_intermediate"], held["stock_capital"], held["dividends"], AS_OF)


def _bucketed_counts(spark, d):
    return _bucketed(spark, d, ("stock_daily",))["stock_daily"].groupBy(KEY).agg(F.count("*").alias("rows"), F.min(DAY).alias("first_date"))


def _exported(spark, d):
    root = _root(spark, "export")
    export(MarketTables(spark, d), root, ["stock_capital"])
    return scan(spark, root, "stock_capital")


_KEPT = f"""(NOT ({CHOSEN}) OR trade_date > DATE '{SPLIT}'
    OR NOT EXISTS (SELECT 1 FROM bars l WHERE l.stock_code = b.stock_code AND l.trade_date > DATE '{SPLIT}'))"""

CHECKS = [
    Check("update_twice", _update_twice, "SELECT * FROM northbound_rows", KEY,
          "net_inflow holding_shares holding_value", DAY),
    Check("update_watermarks", _watermarks, """
        SELECT stock_code, 'northbound_flow' AS data_type, max(trade_date) AS last_update_date
        FROM northbound_rows GROUP BY stock_code""", f"{KEY} data_type", "", "last_update_date"),
    Check("update_rejects", _rejected, f"""
        SELECT stock_code, trade_date, 'overflow net_inflow' AS reject_reason FROM northbound_rows
        WHERE round(abs(CAST(net_inflow AS DOUBLE)) * {SCALE}) >= 1e16""", f"{KEY} reject_reason", "", DAY),
    Check("load_report", _report, f"""
        WITH fate AS (SELECT *, round(abs(CAST(net_inflow AS DOUBLE)) * {SCALE}) >= 1e16 AS bad FROM northbound_rows)
        SELECT 'northbound_flow' AS table_name, c.column_name, 2 * count(*) AS rows, count(*) + count(*) FILTER (bad) AS rejected,
               count(*) FILTER (NOT bad AND CASE c.column_name WHEN 'net_inflow' THEN net_inflow IS NULL
                                WHEN 'holding_shares' THEN holding_shares IS NULL ELSE true END) AS nulls
        FROM fate, (VALUES ('net_inflow'), ('holding_shares'), ('holding_value'), ('inflow_5d')) c(column_name)
        GROUP BY c.column_name""", "table_name column_name", "", "", "rows rejected nulls"),
    Check("recomputed_on_another_day", _recomputed_on_another_day, """
        SELECT count(*) AS rows, round(sum(CAST(dividend_yield AS DECIMAL(18,4))), 2) AS yields, 0 AS differing FROM valuation""",
          "", "yields", "", "rows differing"),
    Check("stored_basic_info", _stored_info, """
        SELECT m.stock_code, m.stock_name, b.trade_date AS price_date, b.close AS close_price, b.change_pct AS pct_chg,
               v.pe_ttm, v.pb
        FROM stock_daily b JOIN (SELECT stock_code, max(trade_date) AS m FROM bars GROUP BY stock_code) l
          ON b.stock_code = l.stock_code AND b.trade_date = l.m
        LEFT JOIN master m ON b.stock_code = m.stock_code
        LEFT JOIN valuation v ON b.stock_code = v.stock_code AND b.trade_date = v.trade_date""",
          f"{KEY} stock_name", "close_price pct_chg pe_ttm pb", "price_date"),
    Check("stored_counts", _stored_counts, """
        SELECT 'stock_daily' AS table_name, count(*) AS rows FROM bars UNION ALL SELECT 'stock_master', count(*) FROM master
        UNION ALL SELECT 'northbound_flow', count(*) FROM northbound_rows UNION ALL SELECT 'margin_trading', NULL""",
          "table_name", "", "", "rows"),
    Check("recomputed_symbols", _recomputed_symbols, """
        SELECT 'stock_daily' AS table_name, count(*) AS rows, 0 AS differing FROM bars
        UNION ALL SELECT 'technical_indicators', count(*), 0 FROM bars
        UNION ALL SELECT 'valuation_indicators', count(*), 0 FROM valuation""", "table_name", "", "", "rows differing"),
    Check("bucketed_replace", _bucketed_counts, f"""
        SELECT stock_code, count(*) AS rows, min(trade_date) AS first_date FROM bars b WHERE {_KEPT}
        GROUP BY stock_code""", KEY, "", "first_date", "rows"),
    Check("bucketed_valuation", _bucketed_values, f"SELECT * FROM valuation b WHERE {_KEPT}",
          KEY, "pe_ttm pb ps_ttm dividend_yield roe pe_annual ps_annual roe_ttm roe_annual", f"{DAY} used_report_date used_announcement_date"),
    Check("exported_capital", _exported, "SELECT * FROM capital", KEY, "", "record_date", "total_shares"),
]
