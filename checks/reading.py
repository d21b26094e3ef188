"""The read queries and the risk summary over all instruments."""

from __future__ import annotations

from checks.duck_views import SEAT_REASON, symbol
from checks.present import Check
from pyspark.sql import functions as F

from tickloom.functions import scalar
from tickloom.operators.filters import in_list
from tickloom.operators.incremental import month_chunks
from tickloom.operators.latest import top_rows
from tickloom.plans import queries as Q
from tickloom.plans import risk
from tickloom.schema import COVERAGE_TABLES, TABLES
from tickloom.sources.market_views import RISK_AS_OF, MarketTables
from tickloom.sources.tables import table_profile

KEY, DAY = "stock_code", "trade_date"
START, END = "1998-01-01", "2000-12-31"
RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"

PRICE_FLOATS = (
    "open_price close_price high_price low_price turnover_amount pct_chg turnover_rate prev_close "
    "outstanding_share"
)
LATEST = """
SELECT b.stock_code, b.trade_date AS price_date, open AS open_price, close AS close_price, high AS high_price,
       low AS low_price, volume, amount AS turnover_amount, change_pct AS pct_chg, turnover AS turnover_rate,
       prev_close, outstanding_share
FROM stock_daily b JOIN (SELECT stock_code, max(trade_date) AS m FROM bars GROUP BY stock_code) l
  ON b.stock_code = l.stock_code AND b.trade_date = l.m
"""


def _tables(build):
    return lambda spark, d: build(MarketTables(spark, d))


def _range(table: str) -> str:
    return f"SELECT * FROM {table} WHERE trade_date {RANGE}"


def _top(table: str, day: str, others: str, n: int, where: str = "") -> str:
    return f"SELECT * FROM {table} {where} ORDER BY {day} DESC, {others} LIMIT {n}"


def _narrow_tables(tables):
    """Bars in an old layout: no derived columns; no master, no valuations."""
    bars = tables["stock_daily"].select(
        "stock_code", "trade_date", "open", "high", "low", "close", "volume", "amount"
    )
    return {"stock_daily": bars}


def _listed(tables):
    """Bars of instruments that have notices, and conversions of their codes."""
    rows = in_list(tables["stock_daily"], "stock_code", tables["announcements"].select("stock_code"))
    return rows.groupBy("stock_code").agg(F.count("*").alias("bar_rows")).selectExpr(
        "stock_code", "bar_rows",
        f"{scalar.to_dotted('stock_code')} AS dotted",
        f"{scalar.from_dotted(scalar.to_dotted('stock_code'))} AS undotted",
        f"{scalar.to_upper_symbol('stock_code')} AS upper_code",
        f"{scalar.to_market_id('stock_code')} AS market_id",
        f"{scalar.is_fund('stock_code')} AS fund",
    )


def _notes(tables):
    """The notes of an answer without rows and of one with rows."""
    none = Q.empty_note(Q.capital_flow(tables, "sh999999"), "sh999999", Q.NO_FLOW)
    return none.unionByName(Q.empty_note(Q.northbound(tables, None), "all", Q.NO_NORTHBOUND))


def _flat_summary(tables):
    reasons = "array_join(transform(unavailable_fields, x -> concat(x.field, ':', x.reason)), '|')"
    return Q.summary(tables).selectExpr("*", f"{reasons} AS reasons")


def _flat_risk(tables):
    trend = (
        "array_join(transform(holder_num_trend, x -> concat(string(x.stat_date), ':', "
        "string(cast(x.holder_num AS bigint)))), '|')"
    )
    return risk.risk_summary(tables, RISK_AS_OF).selectExpr("*", f"{trend} AS trend")


_BASIC_TEXT = "stock_code stock_name stock_name_cn market board status is_etf _warning"
_SUMMARY_VALUES = (
    "pe_ttm pb ps_ttm dividend_yield roe pe_annual ps_annual roe_ttm roe_annual"
).split()
_SUMMARY_FIGURES = {
    "eps": "eps", "roe_ttm": "roe_ttm", "gross_margin_ttm": "gross_margin_ttm",
    "net_margin_ttm": "net_margin_parent_ttm", "current_ratio": "current_ratio",
    "quick_ratio": "quick_ratio", "roa_ttm": "roa_ttm", "revenue_yoy_ttm": "revenue_yoy_ttm",
    "net_profit_yoy_ttm": "net_profit_yoy_ttm",
}
_R = Q.REASONS
_WHY = [
    ("v_fin", f, _R[f]) for f in ("roe_ttm", "gross_margin_ttm", "current_ratio", "quick_ratio")
]

# Oracle relation of each covered table.
_DUCK = {
    "stock_daily": "bars", "technical_indicators": "tech_steps", "valuation_indicators": "valuation",
    "margin_trading": "margin_legs", "capital_flow": "capital_flow",
    "financial_intermediate": "statements", "financial_statements": "statements",
    "stock_capital": "capital", "dividends": "dividends", "dragon_tiger": "dragon_tiger",
    "risk_pledge": "risk_pledge", "risk_holder_change": "risk_holder_change",
    "risk_buyback": "risk_buyback", "risk_unlock": "risk_unlock",
    "risk_holder_num": "risk_holder_num",
}
_COVER = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{TABLES[t].date_col}' AS date_column, stock_code, count(*) AS rows, "
    f"max({TABLES[t].date_col}) AS latest_date FROM {_DUCK[t]} GROUP BY stock_code"
    for t in COVERAGE_TABLES
)
_DUE = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, stock_code FROM master"
    + (" WHERE NOT is_etf" if TABLES[t].equity_only else "")
    for t in COVERAGE_TABLES
)
_MISSING = f"""
SELECT d.* FROM ({_DUE}) d
WHERE NOT EXISTS (SELECT 1 FROM ({_COVER}) c WHERE c.table_name = d.table_name AND c.stock_code = d.stock_code)
"""
_PROFILED = ("stock_daily", "financial_statements", "dividends", "northbound_market_flow")

CHECKS = [
    Check("basic_info", _tables(Q.basic_info), f"""
        SELECT p.*, m.stock_name, m.stock_name_cn, m.market, m.board, m.listing_date, m.status, m.is_etf,
               v.pe_ttm, v.pb, v.ps_ttm, v.dividend_yield, NULL AS _warning
        FROM ({LATEST}) p LEFT JOIN master m ON p.stock_code = m.stock_code
        LEFT JOIN valuation v ON p.stock_code = v.stock_code AND p.price_date = v.trade_date""",
          _BASIC_TEXT, f"{PRICE_FLOATS} pe_ttm pb ps_ttm dividend_yield", "price_date listing_date", "volume"),
    Check("basic_info_old_schema", _tables(lambda t: Q.basic_info(_narrow_tables(t))), f"""
        SELECT stock_code, price_date, open_price, close_price, high_price, low_price, volume, turnover_amount,
               '' AS stock_name, '' AS market, '正常' AS status, false AS is_etf, CAST(NULL AS DOUBLE) AS pct_chg
        FROM ({LATEST})""", "stock_code stock_name market status is_etf",
          "open_price close_price high_price low_price turnover_amount pct_chg", "price_date", "volume"),
    Check("stocks", _tables(Q.stocks), "SELECT DISTINCT stock_code FROM bars", KEY),
    Check("latest_dates", _tables(Q.latest),
          "SELECT stock_code, max(trade_date) AS latest_date FROM bars GROUP BY stock_code", KEY, "", "latest_date"),
    Check("symbol_codes", _tables(_listed), """
        SELECT b.stock_code, count(*) AS bar_rows, left(b.stock_code, 2) || '.' || substr(b.stock_code, 3) AS dotted,
               b.stock_code AS undotted, upper(b.stock_code) AS upper_code,
               CASE WHEN left(b.stock_code, 2) = 'sh' THEN '1.' ELSE '0.' END || substr(b.stock_code, 3) AS market_id,
               left(b.stock_code, 3) IN ('sh5', 'sz1') AS fund
        FROM bars b WHERE b.stock_code IN (SELECT stock_code FROM announcements) GROUP BY b.stock_code""",
          "stock_code dotted undotted upper_code market_id fund", "", "", "bar_rows"),
    Check("coverage", _tables(Q.coverage), f"""
        SELECT c.table_name, c.date_column, count(*) AS stocks, sum(c.rows) AS rows, max(c.latest_date) AS latest_date,
               coalesce(max(m.n), 0) AS missing_stocks
        FROM ({_COVER}) c LEFT JOIN (SELECT table_name, count(*) AS n FROM ({_MISSING}) GROUP BY table_name) m
          ON c.table_name = m.table_name GROUP BY c.table_name, c.date_column""",
          "table_name date_column", "", "latest_date", "stocks rows missing_stocks"),
    Check("coverage_of_absent_tables", _tables(lambda t: Q.coverage(
              {n: t[n] for n in ("stock_master", "stock_daily", "margin_trading")}, ("stock_daily", "margin_trading", "risk_pledge"))), f"""
        SELECT c.table_name, c.date_column, count(*) AS stocks, sum(c.rows) AS rows, max(c.latest_date) AS latest_date,
               coalesce(max(m.n), 0) AS missing_stocks
        FROM ({_COVER}) c LEFT JOIN (SELECT table_name, count(*) AS n FROM ({_MISSING}) GROUP BY table_name) m
          ON c.table_name = m.table_name WHERE c.table_name IN ('stock_daily', 'margin_trading') GROUP BY c.table_name, c.date_column
        UNION ALL SELECT 'risk_pledge', '{TABLES["risk_pledge"].date_col}', NULL, NULL, NULL, NULL""",
          "table_name date_column", "", "latest_date", "stocks rows missing_stocks"),
    Check("coverage_latest", _tables(Q.coverage_latest), _COVER, "table_name date_column stock_code", "",
          "latest_date", "rows"),
    Check("coverage_missing", _tables(Q.coverage_missing), _MISSING, "table_name stock_code"),
    Check("table_profile", _tables(lambda t: table_profile(t, _PROFILED)), """
        SELECT 'stock_daily' AS table_name, count(*) AS rows, count(DISTINCT stock_code) AS symbols, min(trade_date) AS first_date, max(trade_date) AS last_date FROM bars
        UNION ALL SELECT 'financial_statements', count(*), count(DISTINCT stock_code), min(report_date), max(report_date) FROM statements
        UNION ALL SELECT 'dividends', count(*), count(DISTINCT stock_code), min(dividend_date), max(dividend_date) FROM dividends
        UNION ALL SELECT 'northbound_market_flow', count(*), NULL, min(trade_date), max(trade_date) FROM northbound_market""",
          "table_name", "", "first_date last_date", "rows symbols"),
    Check("daily_range", _tables(lambda t: Q.daily(t, None, START, END)),
          _range("stock_daily"), KEY,
          "open close amount change_pct high_60 turnover", DAY, "volume"),
    Check("technical_range", _tables(lambda t: Q.technical_indicators(t, None, START, END)),
          _range("technical_indicators"), KEY,
          "ma5 ema12 macd_hist rsi6 kdj_j sar obv", DAY),
    Check("valuation_range", _tables(lambda t: Q.valuation_indicators(t, None, START, END)), f"""
        SELECT v.*, b.close FROM ({_range("valuation")}) v
        LEFT JOIN bars b ON v.stock_code = b.stock_code AND v.trade_date = b.trade_date""", KEY,
          "pe_ttm pb ps_ttm dividend_yield roe close", DAY),
    Check("financial_range", _tables(lambda t: Q.financial(t, None, START, END, "合并期末")),
          f"SELECT * FROM statements WHERE report_date {RANGE} AND report_type = '合并期末'", f"{KEY} report_type",
          "total_revenue net_profit eps equity_parent", "report_date announcement_date"),
    Check("financial_indicators_range", _tables(lambda t: Q.financial_indicators(t, None, START, END)),
          f"SELECT * FROM intermediate WHERE report_date {RANGE}", KEY,
          "net_profit_ttm roe_ttm gross_margin_ttm cash_cycle_ttm current_ratio", "report_date"),
    Check("northbound_range", _tables(lambda t: Q.northbound(t, None, START, END)), _range("""
        (SELECT *, sum(net_inflow) OVER (PARTITION BY stock_code ORDER BY trade_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inflow_5d
         FROM northbound_rows)"""), KEY,
          "net_inflow inflow_5d", DAY),
    Check("northbound_market", _tables(Q.northbound_market), "SELECT * FROM northbound_market", "",
          "net_buy_amount buy_amount sell_amount cumulative_net_buy daily_inflow daily_balance holding_market_value", DAY),
    Check("margin_range", _tables(lambda t: Q.margin(t, None, START, END)),
          _range("margin_legs"), KEY,
          "rz_balance rq_balance", DAY),
    Check("capital_flow_range", _tables(lambda t: Q.capital_flow(t, None, START, END)),
          _range("capital_flow"), KEY,
          "main_net_amount small_net_amount main_net_ratio small_net_ratio", DAY),
    Check("dragon_tiger_top", _tables(lambda t: Q.dragon_tiger(t, None, START, END, 1000)),
          _top("dragon_tiger", "trade_date", "stock_code, list_type", 1000, f"WHERE trade_date {RANGE}"),
          f"{KEY} list_type reason", "buy_amount sell_amount net_amount", DAY),
    Check("dragon_tiger_seats", _tables(lambda t: Q.dragon_tiger_seats(t, None)), f"""
        SELECT e.stock_code, e.trade_date, e.list_type, 'seat ' || CAST(s.partkey AS VARCHAR) AS seat_name,
               s.flag AS seat_type, s.gross AS buy_amount, s.net AS sell_amount, s.gross - s.net AS net_amount
        FROM dragon_tiger e JOIN (SELECT *, {SEAT_REASON} AS entry FROM trades WHERE qty >= 30) s
          ON e.stock_code = {symbol("s.suppkey")} AND e.trade_date = s.day AND e.list_type = s.entry""",
          f"{KEY} list_type seat_name seat_type", "buy_amount sell_amount net_amount", DAY),
    Check("dragon_tiger_range", _tables(lambda t: Q.dragon_tiger(t, None, START, END)), _range("dragon_tiger"),
          f"{KEY} list_type reason", "buy_amount sell_amount net_amount", DAY),
    Check("announcements_all", _tables(lambda t: Q.announcements(t, None)), "SELECT * FROM announcements",
          f"{KEY} title pdf_url announcement_type", "", "announcement_date"),
    Check("announcements_top", _tables(lambda t: Q.announcements(t, None, 1000)),
          _top("announcements", "announcement_date", "stock_code, title", 1000),
          f"{KEY} title pdf_url announcement_type", "", "announcement_date"),
    Check("dividends_all", _tables(lambda t: Q.dividends(t, None)), "SELECT * FROM dividends", KEY,
          "cash_per_share", "dividend_date announcement_date"),
    Check("capital_all", _tables(lambda t: Q.capital(t, None)), "SELECT * FROM capital", KEY, "", "record_date",
          "total_shares"),
    Check("industry_list", _tables(Q.industry_list), """
        SELECT industry_name, count(*) AS stock_count, max(update_date) AS latest_update FROM industry
        WHERE industry_name IS NOT NULL GROUP BY industry_name""", "industry_name", "", "latest_update", "stock_count"),
    Check("industry_stocks", _tables(lambda t: Q.industry_stocks(t, "NATION_7")),
          "SELECT * FROM industry WHERE industry_name = 'NATION_7'", f"{KEY} industry_name source", "", "update_date"),
    Check("industry_of_symbols", _tables(lambda t: Q.industry(t, None)), "SELECT * FROM industry",
          f"{KEY} industry_name industry_level source", "", "update_date"),
    Check("master", _tables(Q.master), "SELECT * FROM master",
          f"{KEY} stock_name stock_name_cn market board status is_etf", "", "listing_date"),
    Check("stock_detail", _tables(Q.stock_detail), f"""
        SELECT m.*, l.latest_daily, coalesce(l.n, 0) AS daily_count, f.latest_financial,
               coalesce(a.n, 0) AS announcement_count, p.* EXCLUDE (stock_code),
               CASE WHEN p.price_date IS NULL THEN '{Q.NO_BARS}' END AS _warning
        FROM master m
        LEFT JOIN (SELECT stock_code, max(trade_date) AS latest_daily, count(*) AS n FROM bars GROUP BY stock_code) l ON m.stock_code = l.stock_code
        LEFT JOIN (SELECT stock_code, max(report_date) AS latest_financial FROM statements GROUP BY stock_code) f ON m.stock_code = f.stock_code
        LEFT JOIN (SELECT stock_code, count(*) AS n FROM announcements GROUP BY stock_code) a ON m.stock_code = a.stock_code
        LEFT JOIN ({LATEST}) p ON m.stock_code = p.stock_code""",
          f"{KEY} stock_name board status is_etf _warning", "close_price pct_chg turnover_rate",
          "latest_daily latest_financial price_date", "daily_count announcement_count volume"),
    Check("summary", _tables(_flat_summary), f"""
        SELECT m.stock_code, p.price_date AS price_trade_date, p.close_price AS price_close, v.trade_date AS valuation_trade_date,
               {", ".join(f"v.{c} AS valuation_{c}" for c in _SUMMARY_VALUES)},
               {", ".join(f"f.{c} AS financial_{n}" for n, c in _SUMMARY_FIGURES.items())},
               f.report_date AS financial_report_date,
               CASE WHEN v.trade_date IS NOT NULL AND p.close_price <> 0 THEN p.close_price END AS valuation_stock_price,
               coalesce(n.n, 0) AS northbound_count, n.n IS NOT NULL AS northbound_available,
               concat_ws('|', CASE WHEN p.price_date IS NULL THEN 'close:{_R["close_none"]}' END,
                 {", ".join(f"CASE WHEN f.report_date IS NOT NULL AND f.{c} IS NULL THEN '{c}:{w}' END" for _, c, w in _WHY)},
                 CASE WHEN n.n IS NULL THEN 'northbound:{_R["northbound"]}' END) AS reasons
        FROM master m LEFT JOIN ({LATEST}) p ON m.stock_code = p.stock_code
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY trade_date DESC) AS o FROM valuation) WHERE o = 1) v ON m.stock_code = v.stock_code
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY report_date DESC) AS o FROM intermediate) WHERE o = 1) f ON m.stock_code = f.stock_code
        LEFT JOIN (SELECT stock_code, count(*) AS n FROM northbound_rows GROUP BY stock_code) n ON m.stock_code = n.stock_code""",
          f"{KEY} northbound_available reasons",
          "price_close valuation_stock_price " + " ".join(f"valuation_{c}" for c in _SUMMARY_VALUES) + " "
          + " ".join(f"financial_{n}" for n in _SUMMARY_FIGURES),
          "price_trade_date valuation_trade_date financial_report_date", "northbound_count"),
    Check("risk_summary", _tables(_flat_risk), f"""
        SELECT m.stock_code, p.pledge_ratio AS latest_pledge_ratio, p.trade_date AS latest_pledge_date,
               CASE WHEN p.pledge_ratio IS NULL THEN '{risk.LEVEL_NONE}' WHEN p.pledge_ratio <= 5 THEN '{risk.LEVEL_LOW}'
                    WHEN p.pledge_ratio <= 20 THEN '{risk.LEVEL_MIDDLE}' ELSE '{risk.LEVEL_HIGH}' END AS risk_level,
               coalesce(h.n, 0) AS reduce_count_recent_90d, coalesce(b.n, 0) AS ongoing_buyback_count,
               coalesce(b.amount, 0) AS ongoing_buyback_amount, coalesce(u.n, 0) AS unlock_upcoming_90d_count,
               coalesce(u.shares, 0) AS unlock_upcoming_90d_shares, c.holder_num AS holder_num_latest, t.trend,
               CASE WHEN p.trade_date IS NULL AND h.total IS NULL AND b.total IS NULL AND u.total IS NULL AND t.trend IS NULL
                    THEN '{risk.NO_EVENTS}' END AS note
        FROM master m
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY trade_date DESC) AS o FROM risk_pledge) WHERE o = 1) p ON m.stock_code = p.stock_code
        LEFT JOIN (SELECT stock_code, count(*) AS total, count(*) FILTER (change_type = '减持' AND announcement_date >= DATE '{RISK_AS_OF}' - 90) AS n FROM risk_holder_change GROUP BY stock_code) h ON m.stock_code = h.stock_code
        LEFT JOIN (SELECT stock_code, count(*) AS total, count(*) FILTER (progress <> '完成实施') AS n, sum(done_amount) FILTER (progress <> '完成实施') AS amount FROM risk_buyback GROUP BY stock_code) b ON m.stock_code = b.stock_code
        LEFT JOIN (SELECT stock_code, count(*) AS total, count(*) FILTER (free_date BETWEEN DATE '{RISK_AS_OF}' AND DATE '{RISK_AS_OF}' + 90) AS n,
                          sum(CASE WHEN actual_free_shares <> 0 THEN actual_free_shares ELSE free_shares END) FILTER (free_date BETWEEN DATE '{RISK_AS_OF}' AND DATE '{RISK_AS_OF}' + 90) AS shares
                   FROM risk_unlock GROUP BY stock_code) u ON m.stock_code = u.stock_code
        LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY stat_date DESC) AS o FROM risk_holder_num) WHERE o = 1) c ON m.stock_code = c.stock_code
        LEFT JOIN (SELECT stock_code, string_agg(strftime(stat_date, '%Y-%m-%d') || ':' || CAST(holder_num AS VARCHAR), '|' ORDER BY stat_date DESC) AS trend
                   FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY stat_date DESC) AS o FROM risk_holder_num) WHERE o <= 4 GROUP BY stock_code) t ON m.stock_code = t.stock_code""",
          f"{KEY} risk_level trend note", "latest_pledge_ratio ongoing_buyback_amount unlock_upcoming_90d_shares",
          "latest_pledge_date", "reduce_count_recent_90d ongoing_buyback_count unlock_upcoming_90d_count holder_num_latest"),
    Check("risk_pledges", _tables(lambda t: risk.risk_events(t, None)["risk_pledge"]), "SELECT * FROM risk_pledge", KEY,
          "pledge_ratio", DAY),
    Check("risk_holder_changes", _tables(lambda t: risk.risk_events(t, None)["risk_holder_change"]),
          "SELECT * FROM risk_holder_change", f"{KEY} holder_name change_type", "change_ratio", "announcement_date"),
    Check("risk_buybacks", _tables(lambda t: risk.risk_events(t, None)["risk_buyback"]), "SELECT * FROM risk_buyback",
          f"{KEY} progress", "done_amount", "announcement_date"),
    Check("risk_unlocks", _tables(lambda t: risk.risk_events(t, None)["risk_unlock"]), "SELECT * FROM risk_unlock",
          f"{KEY} free_type", "free_shares actual_free_shares", "free_date"),
    Check("risk_holder_numbers", _tables(lambda t: risk.risk_events(t, None)["risk_holder_num"]),
          "SELECT * FROM risk_holder_num", KEY, "change_ratio", "stat_date", "holder_num"),
    Check("empty_notes", _tables(_notes), f"""
        SELECT 'sh999999' AS stock_code, 0 AS count, '{Q.NO_FLOW}' AS note
        UNION ALL SELECT 'all', count(*), CASE WHEN count(*) = 0 THEN '{Q.NO_NORTHBOUND}' END FROM northbound_rows""",
          f"{KEY} note", "", "", "count"),
    Check("newest_holder_counts", _tables(lambda t: top_rows(t["risk_holder_num"], "stock_code", 4, F.desc("stat_date"))),
          "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY stat_date DESC) AS o FROM risk_holder_num) WHERE o <= 4",
          KEY, "change_ratio", "stat_date", "holder_num"),
    Check("month_chunks", _tables(lambda t: month_chunks(
              t["stock_daily"].groupBy("stock_code").agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("b")), "a", "b")), """
        SELECT stock_code, greatest(m, a) AS chunk_start, least(last_day(m), b) AS chunk_end
        FROM (SELECT stock_code, a, b, CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS DATE) AS m
              FROM (SELECT stock_code, min(trade_date) AS a, max(trade_date) AS b FROM bars GROUP BY stock_code))""",
          KEY, "", "chunk_start chunk_end"),
]
