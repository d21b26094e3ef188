"""Data-quality checks and the incremental work lists."""

from __future__ import annotations

import uuid

from checks.duck_views import W
from checks.landing import flow_rows
from checks.present import Check
from pyspark.sql import functions as F

from tickloom.operators import incremental as inc
from tickloom.operators import quality as Q
from tickloom.operators import sketches as S
from tickloom.operators.daily import daily_basic, with_daily_basic
from tickloom.operators.latest import duplicate_keys
from tickloom.operators.technical import technical
from tickloom.plans.pipeline import DERIVED, recompute
from tickloom.schema import TABLES
from tickloom.session import shared_folder
from tickloom.sources import market_views as V
from tickloom.sources.market_views import BUILDERS, MarketTables, view
from tickloom.sources.tables import conform, read_version, table_profile

KEY, DAY = "stock_code", "trade_date"
AS_OF = "2001-06-30"


def _bars(spark, d):
    return view(spark, d, "bars")


def _report(name: str, bad: str, source: str) -> str:
    return f"""SELECT '{name}' AS "check", count(*) FILTER ({bad}) AS violations, count(*) AS sample_size,
        count(*) FILTER ({bad}) = 0 AS passed FROM {source}"""


def _reports(source: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(_report(n, bad, source) for n, bad in checks.items())


def _reported(name, build, sql):
    return Check(
        name, lambda s, d: build(s, d).withColumnRenamed("check", "check_name"),
        f'SELECT *, "check" AS check_name FROM ({sql})', "check_name passed", "", "",
        "violations sample_size",
    )


_SIZES = ("xlarge", "large", "medium", "small")
_TOTAL = "abs(" + " + ".join(f"{s}_net_amount" for s in _SIZES) + ")"
_SCALE = "(" + " + ".join(f"abs({s}_net_amount)" for s in _SIZES) + ")"
_IDENTITIES = {
    "main_amount": "abs(main_net_amount - large_net_amount - xlarge_net_amount) > 1.0",
    "main_ratio": "abs(main_net_ratio - large_net_ratio - xlarge_net_ratio) > 0.05",
    "conservation": f"{_TOTAL} > greatest({_SCALE}, 1.0) * 1e-3",
    "conservation_on_load": f"{_TOTAL} > greatest({_SCALE} * 1e-3, 10.0)",
}


def _skewed_flow(spark, d):
    """Flows whose main ratio is misstated on some days."""
    return view(spark, d, "capital_flow").selectExpr(
        "stock_code", "trade_date", "main_net_amount",
        "if(small_net_amount > 30000, main_net_ratio + 1, main_net_ratio) AS main_net_ratio",
    )


def _exceptions(spark, d):
    """Documented exceptions: the misstated days of large main flows."""
    rows = view(spark, d, "capital_flow").where("small_net_amount > 30000 AND main_net_amount > 50000")
    return rows.select("stock_code", "trade_date")


_CROSS = """
SELECT c.stock_code, c.trade_date, CAST(main_net_amount AS DOUBLE) / CAST(b.amount AS DOUBLE) * 100 AS implied,
       CAST(main_net_ratio AS DOUBLE) + CASE WHEN small_net_amount > 30000 THEN 1 ELSE 0 END AS stated,
       small_net_amount > 30000 AND main_net_amount > 50000 AS known
FROM capital_flow c JOIN bars b ON c.stock_code = b.stock_code AND c.trade_date = b.trade_date WHERE b.amount <> 0
"""
_CROSS_BAD = "abs(implied - stated) > greatest(0.05, abs(stated) * 0.01) AND NOT known"


def _quoted_closes(spark, d):
    """Closes of the flow lines, two percent off on days of net selling."""
    return flow_rows(spark, d).selectExpr(
        "stock_code", "trade_date", "if(main_net_amount < 0, close * 1.02, close) AS close"
    )


def _listed_days(spark, d):
    """Valuation days as if one were written for every calendar day a notice appeared."""
    return view(spark, d, "announcements").selectExpr("stock_code", "announcement_date AS trade_date").distinct()


# Turnover of four kinds of instruments: percent, fraction, empty and off.
_TURNOVER = """
SELECT stock_code, trade_date, turnover AS ref,
       CASE WHEN stock_code LIKE 'sh6%' THEN if(volume % 300 = 0, 0, if(volume % 700 = 0, turnover * 1.1, turnover))
            WHEN stock_code LIKE 'sz0%' THEN turnover / 100 WHEN stock_code LIKE 'sz3%' THEN NULL
            ELSE turnover * 7 END AS turnover
FROM (SELECT b.*, round(double(volume) / (1000 + length(stock_code)), 6) AS turnover FROM bars b)
"""
_D_TURNOVER = _TURNOVER.replace("if(volume % 300 = 0, 0, if(volume % 700 = 0, turnover * 1.1, turnover))",
    "CASE WHEN volume % 300 = 0 THEN 0 WHEN volume % 700 = 0 THEN turnover * 1.1 ELSE turnover END").replace(
    "double(volume)", "CAST(volume AS DOUBLE)")


def _turnovers(spark, d):
    rows = V.query(spark, d, _TURNOVER)
    # The reference has no value on days of the smallest volume.
    reference = V.query(spark, d, f"SELECT stock_code, trade_date, ref AS turnover FROM ({_TURNOVER}) WHERE ref > 0.2")
    return rows.select("stock_code", "trade_date", "turnover"), reference


_D_RATIOS = f"""
SELECT stock_code, trade_date, turnover, CASE WHEN ref > 0.2 THEN ref END AS ref,
       CASE WHEN turnover > 0 AND ref > 0.2 THEN turnover / ref END AS ratio FROM ({_D_TURNOVER})
"""
_D_UNITS = f"""
SELECT stock_code, samples, CASE WHEN samples >= 20 THEN med END AS median_ratio,
       CASE WHEN samples = 0 AND empty THEN 'vacant' WHEN samples < 20 THEN 'unknown' WHEN med BETWEEN 0.8 AND 1.25 THEN 'percent'
            WHEN med BETWEEN 0.008 AND 0.0125 THEN 'fraction' ELSE 'unknown' END AS unit
FROM (SELECT stock_code, count(ratio) AS samples, list_sort(list(ratio) FILTER (ratio IS NOT NULL))[count(ratio) // 2 + 1] AS med,
             bool_and(coalesce(turnover = 0, true)) AS empty FROM ({_D_RATIOS}) GROUP BY stock_code)
"""
_D_RECONCILED = f"""
SELECT *, CASE WHEN kind IN ('no_ref', 'same') THEN stored ELSE ref END AS turnover FROM (
  SELECT r.stock_code, r.trade_date, r.turnover AS stored, r.ref,
         CASE WHEN ref IS NULL THEN 'no_ref' WHEN r.turnover IS NULL OR r.turnover = 0 THEN 'fill'
              WHEN abs(r.turnover - ref) <= greatest(0.005, ref * 0.02) THEN 'same'
              WHEN u.unit = 'fraction' THEN 'fix_unit' ELSE 'overwrite' END AS kind
  FROM ({_D_RATIOS}) r JOIN ({_D_UNITS}) u ON r.stock_code = u.stock_code WHERE u.unit <> 'unknown')
"""

_NULLS = ("equity_parent", "announcement_date", "total_revenue", "net_profit")
_BOUNDS = {"close": (1000.0, 90000.0), "volume": (100.0, 4000.0)}
_RISK = {
    "risk_pledge": ("risk_pledge.ratio_bounds", "pledge_ratio < 0 OR pledge_ratio > 100"),
    "risk_holder_change": ("risk_holder_change.shares_positive", "change_shares <= 0"),
    "risk_buyback": ("risk_buyback.amounts_ordered", "done_amount < 0 OR done_shares < 0 OR amount_upper < amount_lower"),
    "risk_unlock": ("risk_unlock.shares_positive", "free_shares <= 0 OR ratio_to_float <= 0"),
    "risk_holder_num": ("risk_holder_num.count_positive", "holder_num <= 0"),
}
_DERIVED = ("change_pct", "amplitude", "body_size", "upper_shadow", "lower_shadow", "high_20", "low_60")


def _stored_and_fresh(spark, d):
    """Bars at stored scale against the recomputation, with one column spoiled."""
    stored = conform(with_daily_basic(_bars(spark, d)), "stock_daily")
    return stored.withColumn("low_60", F.col("low_60") + 1), daily_basic(_bars(spark, d))


def _family(table, build, spoiled):
    """A stored family of indicators against its recomputation, one column of it spoiled."""
    spec = TABLES[table]
    columns = [f.name for f in spec.fields if f.spark_type.startswith("decimal")]

    def query(spark, d):
        # Both sides are made of it. Dealt by key here, its rows are shuffled once for both, and the fold is computed once.
        fresh = build(spark, d).select(*spec.keys, *columns).repartition(*spec.keys)
        stored = conform(fresh, table).withColumn(spoiled, F.col(spoiled) + 1)
        return Q.recompute_deviation(stored, fresh, spec.keys, columns)

    kinds = {c: spec.type_of(c).upper() for c in columns}
    off = ", ".join(
        f"avg(coalesce(abs(CAST(CAST({c} AS {kinds[c]}) AS DOUBLE) + {int(c == spoiled)} - CAST({c} AS DOUBLE)), 0)) AS {c}" for c in columns
    )
    source = {"technical_indicators": "technical_indicators", "valuation_indicators": "valuation", "financial_intermediate": "intermediate"}[table]
    sql = f"""SELECT column_name, mean_abs_diff, mean_abs_diff < 0.02 AS passed
        FROM (UNPIVOT (SELECT {off} FROM {source}) ON COLUMNS(*) INTO NAME column_name VALUE mean_abs_diff)"""
    return Check(f"recompute_{table}", query, sql, "column_name passed", "mean_abs_diff")


def _completeness(spark, d):
    return Q.completeness(MarketTables(spark, d))


def _counted(spark, d):
    names = ("stock_daily", "financial_statements", "announcements", "dividends", "update_log", "absent_table")
    return Q.table_counts(spark, MarketTables(spark, d), names)


def _recomputed(spark, d):
    """Derive the five tables, commit them as one version, and count what a reader sees."""
    root = f"{shared_folder(spark)}/recomputed-{uuid.uuid4().hex}"
    version = recompute(spark, MarketTables(spark, d), AS_OF, root)
    stored = {n: read_version(spark, root, n, version) for n in DERIVED}
    return table_profile(stored, DERIVED)


def _calendar(spark, d):
    return Q.trading_calendar(_bars(spark, d))


def _symbols(spark, d):
    return view(spark, d, "master").select("stock_code")


def _starts(spark, d):
    return inc.margin_start(_symbols(spark, d), view(spark, d, "update_log"), _calendar(spark, d), AS_OF, "1995-01-01")


def _reload(spark, d):
    """With watermarks a year old, so that the look-back clamp decides."""
    log = view(spark, d, "update_log").selectExpr(
        "stock_code", "data_type", "date_sub(last_update_date, 160) AS last_update_date")
    starts = inc.margin_start(_symbols(spark, d), log, _calendar(spark, d), AS_OF, "1995-01-01")
    return inc.reload_dates(starts, _calendar(spark, d), AS_OF)


_CAL = "(SELECT trade_date FROM bars GROUP BY trade_date HAVING count(DISTINCT stock_code) >= 8)"
_MARK = "SELECT stock_code, max(last_update_date) AS mark FROM update_log WHERE data_type = 'margin' GROUP BY stock_code"


def _d_start(shift: int) -> str:
    return f"""
    SELECT m.stock_code, greatest(least(coalesce(u.mark + 1 - {shift}, DATE '1995-01-01'),
             (SELECT min(trade_date) FROM (SELECT trade_date FROM {_CAL} WHERE trade_date <= DATE '{AS_OF}' ORDER BY trade_date DESC LIMIT 5))),
             DATE '{AS_OF}' - 60) AS begin_date
    FROM master m LEFT JOIN ({_MARK}) u ON m.stock_code = u.stock_code"""


def _sketched(spark, d):
    """Valuations profiled from stored sketches, half of the months first; how far the estimates are off."""
    root, values = f"{shared_folder(spark)}/sketches-{uuid.uuid4().hex}", BUILDERS["valuation_indicators"](spark, d)
    early = f"{DAY} < DATE '1995-01-01'"
    for part in (early, f"NOT ({early})"):
        S.store_sketches(spark, values.where(part), root, "valuation_indicators", DAY, ["pe_ttm"])
    profile = S.stored_profile(spark, root, "valuation_indicators", ["pe_ttm"])
    points = profile.selectExpr("*", "pe_ttm_quantiles[0] AS q1", "pe_ttm_quantiles[1] AS q2", "pe_ttm_quantiles[2] AS q3")
    exact = values.crossJoin(points.select("q1", "q2", "q3")).agg(
        F.count_distinct(KEY).alias("exact"), *(F.expr(f"count_if(pe_ttm <= q{i}) / count(pe_ttm)").alias(f"r{i}") for i in (1, 2, 3))
    )
    near = " AND ".join(f"abs(r{i} - {i / 4}) <= {S.RANK_ERROR}" for i in (1, 2, 3))
    return points.crossJoin(exact).selectExpr(
        "rows", "pe_ttm_known", "first_date", "last_date", f"abs(symbols - exact) <= {S.SYMBOL_ERROR} * exact AS symbols_near", f"{near} AS quantiles_near"
    )


CHECKS = [
    _reported("flow_identities", lambda s, d: Q.flow_identities(view(s, d, "capital_flow")), _reports("capital_flow", _IDENTITIES)),
    Check("flow_cross_source", lambda s, d: Q.flow_against_bars(_skewed_flow(s, d), _bars(s, d), _exceptions(s, d)),
          f"SELECT *, {_CROSS_BAD} AS bad FROM ({_CROSS})", f"{KEY} bad", "implied stated", DAY),
    _reported("flow_cross_source_report", lambda s, d: Q.flow_against_bars_report(_skewed_flow(s, d), _bars(s, d), _exceptions(s, d)),
              _report("cross_source", _CROSS_BAD, f"({_CROSS})")),
    Check("flow_close_mismatch", lambda s, d: Q.close_mismatch(_quoted_closes(s, d), _bars(s, d)), """
        SELECT c.stock_code, count(*) AS checked, count(*) FILTER (main_net_amount < 0) AS mismatch FROM capital_flow c
        WHERE NOT (abs(main_net_amount) BETWEEN 30000 AND 31000 OR abs(main_net_amount) BETWEEN 40000 AND 41000)
        GROUP BY c.stock_code""", KEY, "", "", "checked mismatch"),
    Check("orphan_rows", lambda s, d: Q.orphans(_listed_days(s, d), _bars(s, d)), """
        SELECT DISTINCT stock_code, announcement_date AS trade_date FROM announcements a
        WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.stock_code = a.stock_code AND b.trade_date = a.announcement_date)""", KEY, "", DAY),
    Check("bars_without_master", lambda s, d: Q.orphans(view(s, d, "announcements").select("stock_code").distinct(), view(s, d, "master"), ["stock_code"]),
          "SELECT DISTINCT a.stock_code FROM announcements a LEFT JOIN master m ON a.stock_code = m.stock_code WHERE m.stock_code IS NULL", KEY),
    Check("duplicate_keys", lambda s, d: duplicate_keys(V.query(s, d, "SELECT orderkey, linenumber FROM trades"), ["orderkey", "linenumber"]),
          "SELECT orderkey, linenumber, count(*) AS rows FROM trades GROUP BY ALL HAVING count(*) > 1", "", "", "", "orderkey linenumber rows"),
    _reported("duplicate_report", lambda s, d: Q.duplicate_report(V.query(s, d, "SELECT orderkey, linenumber FROM trades"), ["orderkey", "linenumber"], "line_key"), """
        SELECT 'line_key' AS "check", (SELECT count(*) FROM (SELECT 1 FROM trades GROUP BY orderkey, linenumber HAVING count(*) > 1)) AS violations,
               count(*) AS sample_size, (SELECT count(*) FROM (SELECT 1 FROM trades GROUP BY orderkey, linenumber HAVING count(*) > 1)) = 0 AS passed FROM trades"""),
    Check("trading_calendar", _calendar, f"SELECT trade_date FROM {_CAL}", "", "", DAY),
    Check("calendar_gaps", lambda s, d: Q.calendar_gaps(_bars(s, d)), f"""
        SELECT s.stock_code, c.trade_date FROM (SELECT DISTINCT stock_code FROM bars) s CROSS JOIN {_CAL} c
        WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.stock_code = s.stock_code AND b.trade_date = c.trade_date)""", KEY, "", DAY),
    Check("calendar_gaps_since", lambda s, d: Q.calendar_gaps(_bars(s, d), "2001-03-01", 12), """
        SELECT s.stock_code, c.trade_date FROM (SELECT DISTINCT stock_code FROM bars) s
        CROSS JOIN (SELECT trade_date FROM bars WHERE trade_date >= DATE '2001-03-01' GROUP BY trade_date HAVING count(*) >= 12) c
        WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.stock_code = s.stock_code AND b.trade_date = c.trade_date)""", KEY, "", DAY),
    Check("long_gaps", lambda s, d: Q.long_gaps(_bars(s, d)), f"""
        SELECT * FROM (SELECT stock_code, trade_date, prev_date, trade_date - prev_date AS gap_days
          FROM (SELECT stock_code, trade_date, lag(trade_date) {W} AS prev_date FROM bars)) WHERE gap_days > 7""",
          KEY, "", "trade_date prev_date", "gap_days"),
    Check("price_jumps", lambda s, d: Q.price_jumps(_bars(s, d)), f"""
        SELECT stock_code, trade_date, move_pct, coalesce(move_pct <= 30, true) AS accepted FROM (
          SELECT stock_code, trade_date, abs(CAST(close AS DOUBLE) / nullif(lag(CAST(close AS DOUBLE)) {W}, 0) - 1) * 100 AS move_pct FROM bars)""",
          f"{KEY} accepted", "move_pct", DAY),
    Check("null_profile", lambda s, d: Q.null_profile(view(s, d, "statements"), _NULLS), " UNION ALL ".join(f"""
        SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_rows,
               CASE WHEN count(*) = count({c}) THEN 'PASS' WHEN count(*) - count({c}) < count(*) * 0.1 THEN 'WARN' ELSE 'FAIL' END AS grade
        FROM statements""" for c in _NULLS), "column_name grade", "", "", "total_rows null_rows"),
    _reported("range_violations", lambda s, d: Q.range_violations(_bars(s, d), _BOUNDS),
              _reports("bars", {c: f"{c} < {a} OR {c} > {b}" for c, (a, b) in _BOUNDS.items()})),
    _reported("non_positive_prices", lambda s, d: Q.non_positive_prices(_bars(s, d)),
              _report("non_positive_price", "least(open, high, low, close) <= 0", "bars")),
    Check("filled_counts", lambda s, d: Q.filled_counts(view(s, d, "statements"), "stock_code", ["equity_parent", "announcement_date"]), """
        SELECT stock_code, count(*) AS total_rows, count(equity_parent) AS equity_parent_filled, count(announcement_date) AS announcement_date_filled
        FROM statements GROUP BY stock_code""", KEY, "", "", "total_rows equity_parent_filled announcement_date_filled"),
    Check("pe_bands", lambda s, d: Q.pe_bands(V.valuations(s, d)), """
        SELECT count(*) FILTER (pe_ttm <= 0) AS negative, count(*) FILTER (pe_ttm > 0 AND pe_ttm < 15) AS low,
               count(*) FILTER (pe_ttm >= 15 AND pe_ttm < 30) AS middle, count(*) FILTER (pe_ttm >= 30 AND pe_ttm < 60) AS high,
               count(*) FILTER (pe_ttm >= 60) AS very_high, count(*) FILTER (pe_ttm IS NULL) AS unknown FROM valuation""",
          "", "", "", "negative low middle high very_high unknown"),
    Check("latest_pe_bands", lambda s, d: Q.latest_pe_bands(V.valuations(s, d)), """
        SELECT count(*) AS total, count(*) FILTER (pe_ttm > 0 AND pe_ttm < 30) AS normal, count(*) FILTER (pe_ttm >= 30 AND pe_ttm < 100) AS high,
               count(*) FILTER (pe_ttm >= 100 OR pe_ttm IS NULL) AS very_high, count(*) FILTER (pe_ttm < 1) AS abnormal
        FROM valuation WHERE (stock_code, trade_date) IN (SELECT stock_code, max(trade_date) FROM valuation GROUP BY stock_code)""",
          "", "", "", "total normal high very_high abnormal"),
    Check("kdj_stats", lambda s, d: Q.column_stats(technical(_bars(s, d), ["kdj_j"]), "kdj_j"),
          "SELECT min(kdj_j) AS min_value, max(kdj_j) AS max_value, avg(kdj_j) AS avg_value FROM technical_fold", "",
          "min_value max_value avg_value"),
    Check("turnover_units", lambda s, d: Q.turnover_units(*_turnovers(s, d)), _D_UNITS, f"{KEY} unit", "median_ratio", "", "samples"),
    Check("turnover_reconciled", lambda s, d: Q.reconcile_turnover(*_turnovers(s, d)), _D_RECONCILED, f"{KEY} kind", "turnover", DAY),
    _reported("risk_rules", lambda s, d: Q.risk_rules(MarketTables(s, d)),
              " UNION ALL ".join(_report(n, bad, t) for t, (n, bad) in _RISK.items())),
    Check("funds_ratio", lambda s, d: Q.funds_ratio(view(s, d, "statements")), """
        SELECT stock_code, count(*) AS total_rows, count(monetary_funds) AS filled, max(CAST(monetary_funds AS DOUBLE) / nullif(CAST(current_assets AS DOUBLE), 0)) AS max_ratio,
               coalesce(max(CAST(monetary_funds AS DOUBLE) / nullif(CAST(current_assets AS DOUBLE), 0)) > 1, false) AS suspicious
        FROM statements GROUP BY stock_code""", f"{KEY} suspicious", "max_ratio", "", "total_rows filled"),
    Check("recompute_deviation", lambda s, d: Q.recompute_deviation(*_stored_and_fresh(s, d), ["stock_code", "trade_date"], _DERIVED),
          " UNION ALL ".join(f"""SELECT '{c}' AS column_name, avg(coalesce(abs(CAST(CAST({c} AS DECIMAL(10,{2 if c[-3:] in ('_20', '_60') else 4})) AS DOUBLE) + {1 if c == 'low_60' else 0} - {c}), 0)) AS mean_abs_diff,
              {c == 'low_60'} = false AS passed FROM daily_basic""" for c in _DERIVED), "column_name passed", "mean_abs_diff"),
    _family("technical_indicators", BUILDERS["technical_indicators"], "macd_dea"),
    _family("valuation_indicators", BUILDERS["valuation_indicators"], "pe_ttm"),
    _family("financial_intermediate", BUILDERS["financial_intermediate"], "roe_ttm"),
    Check("relative_deviation", lambda s, d: Q.relative_deviation(*_stored_and_fresh(s, d), ["stock_code", "trade_date"], "low_60", 0.01),
          "SELECT stock_code, trade_date, low_60 + 1 AS stored_value, low_60 AS fresh_value, 1 / low_60 * 100 < 0.01 AS passed FROM daily_basic",
          f"{KEY} passed", "stored_value fresh_value", DAY),
    Check("sketch_profile", _sketched, """
        SELECT count(*) AS rows, count(pe_ttm) AS pe_ttm_known, min(trade_date) AS first_date, max(trade_date) AS last_date,
               true AS symbols_near, true AS quantiles_near FROM valuation""", "symbols_near quantiles_near", "", "first_date last_date", "rows pe_ttm_known"),
    Check("completeness", _completeness, """
        SELECT b.stock_code, b.n AS daily_rows, b.n AS technical_rows, coalesce(v.n, 0) AS valuation_rows, s.n AS statements_rows,
               s.n AS fundamentals_rows, 2 AS capital_rows, true AS complete
        FROM (SELECT stock_code, count(*) AS n FROM bars GROUP BY stock_code) b
        LEFT JOIN (SELECT stock_code, count(*) AS n FROM valuation GROUP BY stock_code) v ON b.stock_code = v.stock_code
        LEFT JOIN (SELECT stock_code, count(*) AS n FROM statements GROUP BY stock_code) s ON b.stock_code = s.stock_code""",
          f"{KEY} complete", "", "", "daily_rows technical_rows valuation_rows statements_rows fundamentals_rows capital_rows"),
    Check("table_counts", _counted, """
        SELECT 'stock_daily' AS table_name, count(*) AS rows FROM bars UNION ALL SELECT 'financial_statements', count(*) FROM statements
        UNION ALL SELECT 'announcements', count(*) FROM announcements UNION ALL SELECT 'dividends', count(*) FROM dividends
        UNION ALL SELECT 'update_log', count(*) FROM update_log UNION ALL SELECT 'absent_table', NULL""", "table_name", "rows"),
    # --- incremental ---
    Check("recomputed_tables", _recomputed, """
        SELECT 'stock_daily' AS table_name, count(*) AS rows, count(DISTINCT stock_code) AS symbols, max(trade_date) AS last_date FROM bars
        UNION ALL SELECT 'technical_indicators', count(*), count(DISTINCT stock_code), max(trade_date) FROM tech_steps
        UNION ALL SELECT 'financial_intermediate', count(*), count(DISTINCT stock_code), max(report_date) FROM statements
        UNION ALL SELECT 'valuation_indicators', count(*), count(DISTINCT stock_code), max(trade_date) FROM valuation
        UNION ALL SELECT 'northbound_flow', count(*), count(DISTINCT stock_code), max(trade_date) FROM northbound_rows""",
          "table_name", "", "last_date", "rows symbols"),
    Check("next_dates", lambda s, d: inc.next_dates(_symbols(s, d), view(s, d, "update_log").where("last_update_date > date'2001-10-30'"), "daily", "1995-01-01"), """
        SELECT m.stock_code, coalesce(max(u.last_update_date) + 1, DATE '1995-01-01') AS next_date FROM master m
        LEFT JOIN update_log u ON m.stock_code = u.stock_code AND data_type = 'daily' AND last_update_date > DATE '2001-10-30' GROUP BY m.stock_code""",
          KEY, "", "next_date"),
    Check("stored_watermarks", lambda s, d: inc.write_watermarks(view(s, d, "update_log"), inc.stored_watermarks(_bars(s, d), "trade_date", "margin")), """
        SELECT u.stock_code, data_type, CASE WHEN data_type = 'margin' THEN m ELSE last_update_date END AS last_update_date
        FROM update_log u JOIN (SELECT stock_code, max(trade_date) AS m FROM bars GROUP BY stock_code) b ON u.stock_code = b.stock_code""",
          f"{KEY} data_type", "", "last_update_date"),
    Check("watermark_ahead", lambda s, d: inc.watermark_ahead(view(s, d, "update_log"), _bars(s, d), "margin"), """
        SELECT u.stock_code, last_update_date, m AS max_date FROM update_log u
        LEFT JOIN (SELECT stock_code, max(trade_date) AS m FROM bars GROUP BY stock_code) b ON u.stock_code = b.stock_code
        WHERE data_type = 'margin' AND (m IS NULL OR last_update_date > m)""", KEY, "", "last_update_date max_date"),
    Check("reload_start", _starts, _d_start(0), KEY, "", "begin_date"),
    Check("reload_dates", _reload, f"""
        SELECT s.stock_code, c.trade_date FROM ({_d_start(160)}) s JOIN {_CAL} c ON c.trade_date BETWEEN s.begin_date AND DATE '{AS_OF}'""", KEY, "", DAY),
    Check("missing_symbols", lambda s, d: inc.missing_symbols(view(s, d, "announcements").select("stock_code").distinct(), _bars(s, d)),
          "SELECT DISTINCT stock_code FROM announcements WHERE stock_code NOT IN (SELECT stock_code FROM bars)", KEY),
    Check("late_window", lambda s, d: inc.rolling_window(view(s, d, "announcements"), "announcement_date", AS_OF, inc.LIST_WINDOW_DAYS),
          f"SELECT * FROM announcements WHERE announcement_date BETWEEN DATE '{AS_OF}' - 20 AND DATE '{AS_OF}'", f"{KEY} title", "", "announcement_date"),
]
