"""Daily columns, technical indicators, fundamentals, valuation and flow series."""

from __future__ import annotations

import uuid

from checks.duck_views import W, rows
from checks.present import Check
from pyspark.sql import functions as F

from tickloom.operators import asof, daily, flows, fundamentals, technical, valuation
from tickloom.operators.latest import latest_value
from tickloom.schema import TABLES
from tickloom.session import shared_folder
from tickloom.sources.market_views import AS_OF, BUILDERS, view
from tickloom.sources.tables import write_packed

KEY = "stock_code"
DAY = "trade_date"
ROLLING = " ".join(technical.ROLLING_COLUMNS)
FOLDED = "ema12 ema26 macd_dif macd_dea macd_hist kdj_k kdj_d kdj_j sar"

_SPEC = TABLES["financial_intermediate"]
_FIGURES = " ".join(
    c for c in _SPEC.columns if c not in ("stock_code", "report_date", "report_type", "announcement_date")
)
_VALUES = "pe_ttm pb ps_ttm dividend_yield roe pe_annual ps_annual roe_ttm roe_annual"
_USED = "trade_date used_report_date used_announcement_date"


def _bars(spark, d):
    return view(spark, d, "bars")


def _capital(spark, d):
    return view(spark, d, "capital")


def _figures(method):
    def build(spark, d):
        return fundamentals.fundamentals(view(spark, d, "statements"), _capital(spark, d), method)

    return build


def _valuation(**options):
    def build(spark, d):
        return valuation.valuation(
            _bars(spark, d), _figures("positional")(spark, d), _capital(spark, d),
            view(spark, d, "dividends"), AS_OF, **options,
        )

    return build


def _per_share(spark, d):
    return valuation.valuation_per_share(
        _bars(spark, d), _figures("positional")(spark, d), view(spark, d, "dividends"), AS_OF
    )


def _asof_statement(spark, d):
    """The bare as-of join: which statement serves each bar."""
    return asof.asof_newest(
        _bars(spark, d).select("stock_code", "trade_date"), view(spark, d, "statements"),
        "stock_code", "trade_date", "announcement_date", "report_date",
        ["announcement_date", "net_profit"], ["report_type"],
    )


def _folded(spark, d):
    return technical.technical(_bars(spark, d), FOLDED.split())


def _backfilled(spark, d):
    """Indicators of bars that lack a week for a third of the symbols, then gone on with from the snapshots before that week."""
    folder = f"{shared_folder(spark)}/backfill-{uuid.uuid4().hex}"
    # Written, as a stored table's bars are: they are read three times.
    write_packed(_bars(spark, d), f"{folder}-bars")
    bars = spark.read.parquet(f"{folder}-bars")
    week = "trade_date BETWEEN '1995-03-03' AND '1995-03-10' AND pmod(crc32(CAST(stock_code AS BINARY)), 3) = 0"
    before = technical.technical_with_states(bars.where(f"NOT ({week})"))
    write_packed(before, folder)
    before = spark.read.parquet(folder)
    # Written too, so that Spark knows how few they are and does not shuffle all indicators to meet them.
    write_packed(bars.where(week).groupBy(KEY).agg(F.min(DAY).alias("first_day")), f"{folder}-starts")
    starts = spark.read.parquet(f"{folder}-starts")
    after = technical.technical_since(bars, starts, technical.fold_states(before))
    kept = before.join(starts, KEY, "left").where(f"first_day IS NULL OR {DAY} < first_day").drop("first_day")
    return kept.unionByName(after)


MA = technical.MA_WINDOWS


def _half_even(cents: str, n: int) -> str:
    """cents / n rounded to whole cents, ties to even, in whole numbers."""
    q, twice = f"({cents} // {n})", f"({cents} % {n} * 2)"
    up = f"{twice} > {n} OR ({twice} = {n} AND {q} % 2 = 1)"
    return f"({q} + CASE WHEN {up} THEN 1 ELSE 0 END) / 100e0"


CHECKS = [
    Check("bars", _bars, "SELECT * FROM bars", KEY, "open high low close amount", DAY, "volume"),
    Check("statements", lambda s, d: view(s, d, "statements"), "SELECT * FROM statements",
          f"{KEY} report_type",
          " ".join(c for c in TABLES["financial_statements"].values
                   if c not in ("announcement_date", "roe")),
          "report_date announcement_date"),
    Check("daily_basic", lambda s, d: daily.daily_basic(_bars(s, d)), "SELECT * FROM daily_basic", KEY,
          "prev_close change_pct amplitude body_size upper_shadow lower_shadow high_20 low_20 high_60 low_60", DAY),
    Check("turnover_fill", lambda s, d: daily.fill_turnover(_bars(s, d), _capital(s, d)),
          "SELECT * FROM stock_daily", KEY, "close turnover outstanding_share", DAY, "volume"),
    Check("technical_rolling", lambda s, d: technical.technical_rolling(_bars(s, d)),
          "SELECT * FROM technical_rolling", KEY, ROLLING, DAY),
    Check("technical_recursive", _folded, "SELECT * FROM technical_fold", KEY, FOLDED, DAY),
    Check("technical_all", BUILDERS["technical_indicators"], "SELECT * FROM technical_indicators", KEY,
          f"{ROLLING} {FOLDED}", DAY),
    Check("technical_scanned", lambda s, d: technical.technical_scanned(_bars(s, d)),
          "SELECT * FROM technical_fold", KEY, " ".join(technical.SCANNED_COLUMNS), DAY),
    Check("technical_backfilled", _backfilled, "SELECT * FROM technical_indicators", KEY, f"{ROLLING} {FOLDED}", DAY),
    Check("moving_averages", lambda s, d: technical.moving_averages(_bars(s, d)), f"""
        SELECT * FROM (SELECT stock_code, trade_date, {", ".join(
            f"CASE WHEN c{n} >= {n} THEN {_half_even(f's{n}', n)} END AS ma{n}" for n in MA)}
          FROM (SELECT stock_code, trade_date, {", ".join(
            f"{rows('count(close)', n)} AS c{n}, CAST({rows('sum(close)', n)} * 100 AS BIGINT) AS s{n}" for n in MA)}
                FROM bars))
        WHERE coalesce(ma5, ma10, ma20, ma60) IS NOT NULL""", KEY, "ma5 ma10 ma20 ma60", DAY),
    Check("fundamentals_positional", _figures("positional"), "SELECT * FROM intermediate",
          f"{KEY} report_type", _FIGURES, "report_date announcement_date"),
    Check("fundamentals_calendar", _figures("calendar"), "SELECT * FROM intermediate_calendar",
          f"{KEY} report_type", _FIGURES, "report_date announcement_date"),
    Check("cumulative_to_quarterly",
          lambda s, d: fundamentals.cumulative_to_quarterly(view(s, d, "statements"), "eps", "total_revenue"), """
        SELECT *, CASE WHEN month(report_date) = 3 THEN eps ELSE coalesce(eps - e, eps) END AS eps_q,
               CASE WHEN month(report_date) = 3 THEN total_revenue ELSE coalesce(total_revenue - r, total_revenue) END AS total_revenue_q
        FROM (SELECT a.stock_code, a.report_date, a.eps, a.total_revenue, b.eps AS e, b.total_revenue AS r
              FROM statements a ASOF LEFT JOIN statements b ON a.stock_code = b.stock_code
               AND a.report_date > b.report_date
              WHERE b.report_date IS NULL OR year(b.report_date) = year(a.report_date)
              UNION ALL
              SELECT a.stock_code, a.report_date, a.eps, a.total_revenue, NULL, NULL
              FROM statements a ASOF JOIN statements b ON a.stock_code = b.stock_code AND a.report_date > b.report_date
              WHERE year(b.report_date) <> year(a.report_date))""",
          KEY, "eps_q total_revenue_q", "report_date"),
    Check("latest_capital", lambda s, d: latest_value(_capital(s, d), "stock_code", "record_date", "record_date", "total_shares"),
          "SELECT stock_code, max(record_date) AS record_date, arg_max(total_shares, record_date) AS total_shares FROM capital GROUP BY stock_code",
          KEY, "", "record_date", "total_shares"),
    Check("asof_statement", _asof_statement, """
        SELECT * FROM (SELECT b.stock_code, b.trade_date, i.report_date, i.announcement_date, i.net_profit,
                 row_number() OVER (PARTITION BY b.stock_code, b.trade_date ORDER BY i.report_date DESC NULLS LAST, i.report_type DESC) AS place
          FROM bars b LEFT JOIN statements i ON i.stock_code = b.stock_code AND i.announcement_date <= b.trade_date)
        WHERE place = 1""", KEY, "net_profit", "trade_date report_date announcement_date"),
    Check("valuation", _valuation(), "SELECT * FROM valuation", KEY, _VALUES, _USED),
    Check("valuation_null_announcement", _valuation(null_announcement="always"),
          "SELECT * FROM valuation_always", KEY, _VALUES, _USED),
    Check("valuation_point_in_time", _valuation(point_in_time=True), "SELECT * FROM valuation_pit", KEY,
          _VALUES, _USED),
    Check("valuation_per_share", _per_share, "SELECT * FROM valuation_per_share", KEY, _VALUES, _USED),
    Check("trailing_dividends", lambda s, d: valuation.trailing_dividends(view(s, d, "dividends"), AS_OF), """
        SELECT stock_code, coalesce(sum(cash_per_share) FILTER (dividend_date >= DATE '2001-06-30' - 365), 0) AS dividend_cash
        FROM dividends GROUP BY stock_code""", KEY, "dividend_cash"),
    Check("northbound_sums", BUILDERS["northbound_flow"], f"""
        SELECT *, {", ".join(f"{rows('sum(net_inflow)', n)} AS inflow_{n}d" for n in flows.INFLOW_WINDOWS)}
        FROM northbound_rows""", KEY,
          "net_inflow holding_shares holding_value holding_ratio inflow_5d inflow_10d inflow_30d", DAY),
    Check("northbound_resum", lambda s, d: flows.inflow_sums(view(s, d, "northbound_rows"), min_rows=530), f"""
        SELECT stock_code, trade_date, net_inflow, {", ".join(
            f"CASE WHEN n >= 530 THEN s{k} END AS inflow_{k}d" for k in flows.INFLOW_WINDOWS)}
        FROM (SELECT *, count(*) OVER (PARTITION BY stock_code) AS n,
              {", ".join(f"{rows('sum(net_inflow)', k)} AS s{k}" for k in flows.INFLOW_WINDOWS)} FROM northbound_rows)""",
          KEY, "net_inflow inflow_5d inflow_10d inflow_30d", DAY),
    Check("margin_changes", BUILDERS["margin_trading"], f"""
        SELECT *, {", ".join(f"CAST({x}_change AS DOUBLE) / nullif(CAST({x}_before AS DOUBLE), 0) * 100 AS {x}_change_pct" for x in ("rz", "rq", "total"))}
        FROM (SELECT *, rz_change + rq_change AS total_change FROM (
          SELECT *, rz_balance - lag(rz_balance) {W} AS rz_change, rq_balance - lag(rq_balance) {W} AS rq_change,
                 lag(rz_balance) {W} AS rz_before, lag(rq_balance) {W} AS rq_before, lag(total_balance) {W} AS total_before
          FROM (SELECT *, rz_balance + rq_balance AS total_balance FROM margin_legs)))""", KEY,
          " ".join(f"{x}_{k}" for x in ("rz", "rq", "total") for k in ("balance", "change", "change_pct")), DAY),
]
