"""Landed raw records: written as text from typed values, parsed back, compared with those values."""

from __future__ import annotations

import uuid

from checks.duck_views import relist
from checks.present import Check
from tickloom.functions.series import BARS
from tickloom.operators import merge, quality
from tickloom.plans.pipeline import load
from tickloom.session import shared_folder
from tickloom.sources import feeds, raw_text
from tickloom.sources import market_views as V
from tickloom.sources.tables import scan

KEY, DAY = "stock_code", "trade_date"
AS_OF = "2000-03-31"
_PERIOD = ("stock_code", "report_date")


def _view(name):
    return lambda spark, d: V.view(spark, d, name)


# --- flow lines -------------------------------------------------------------------------------

# Days of some net amounts are written short, others with a field that is no number.
_SHORT = "abs(main_net_amount) BETWEEN 30000 AND 31000"
_BROKEN = "abs(main_net_amount) BETWEEN 40000 AND 41000"
_FLOW_TEXT = f"""
SELECT stock_code, concat('{{"data":{{"klines":["', concat_ws('","', sort_array(collect_list(line))), '"]}}}}') AS payload
FROM (
  SELECT stock_code, month(trade_date) AS m, year(trade_date) AS y, trade_date,
    CASE WHEN {_SHORT} THEN concat(string(trade_date), ',', main_net_amount)
         WHEN {_BROKEN} THEN concat_ws(',', string(trade_date), '-', small_net_amount, medium_net_amount,
              large_net_amount, xlarge_net_amount, main_net_ratio, small_net_ratio, medium_net_ratio,
              large_net_ratio, xlarge_net_ratio, '0', '0')
         ELSE concat_ws(',', string(trade_date), main_net_amount, small_net_amount, medium_net_amount,
              large_net_amount, xlarge_net_amount, main_net_ratio, small_net_ratio, medium_net_ratio,
              large_net_ratio, xlarge_net_ratio, close, '1.5', 'extra') END AS line
  FROM (SELECT c.*, b.close FROM capital_flow c JOIN bars b ON c.stock_code = b.stock_code AND c.trade_date = b.trade_date)
) GROUP BY stock_code, y, m
"""


def flow_payloads(spark, d):
    """One JSON payload per instrument and month."""
    return V.query(spark, d, _FLOW_TEXT)


def flow_rows(spark, d):
    return raw_text.parse_flow(raw_text.flow_lines(flow_payloads(spark, d)))


# Symbols whose payloads have named fields, one of them new; those with a 9 send no JSON on some months.
_NAMED = "right(stock_code, 1) IN ('0', '2', '4', '6', '8')"
_NAMED_TEXT = f"""
SELECT stock_code, if(max(b9) AND m = 5, concat('<html>', m), to_json(named_struct('data', named_struct('klines', collect_list(record))))) AS payload
FROM (SELECT c.stock_code, month(c.trade_date) AS m, year(c.trade_date) AS y, contains(c.stock_code, '9') AS b9,
        named_struct('trade_date', string(c.trade_date), {", ".join(f"'{n}', {n}" for n in list(raw_text.FLOW_FIELDS.values())[:10])},
                     'close', close, 'change_pct', 1.5BD, 'rating', concat('r', c.stock_code)) AS record
      FROM capital_flow c JOIN bars b ON c.stock_code = b.stock_code AND c.trade_date = b.trade_date)
WHERE {_NAMED} GROUP BY stock_code, y, m
"""


def _drifting(spark, d):
    """Lines of some symbols and objects of others in one frame, the objects' new field beside the known ones."""
    payloads = flow_payloads(spark, d).where(f"NOT ({_NAMED})").unionByName(V.query(spark, d, _NAMED_TEXT))
    rows = raw_text.flow_variants(payloads)
    return rows.selectExpr("*", f"{raw_text.record_field('rating')} AS rating")


def _drift_rejects(spark, d):
    rows = _drifting(spark, d).where("reject_reason IS NOT NULL")
    return rows.groupBy("stock_code", "reject_reason").count().withColumnRenamed("count", "rows")


def _flow_rejects(spark, d):
    rejects = raw_text.rejected_flow(raw_text.flow_lines(flow_payloads(spark, d)))
    return rejects.selectExpr("stock_code", "reason", "left(line, 10) AS line_date")


_FLOW_COLUMNS = " ".join(raw_text.FLOW_FIELDS.values())
_FLOW_SQL = """
SELECT c.*, b.close, 1.5 AS change_pct FROM capital_flow c
JOIN bars b ON c.stock_code = b.stock_code AND c.trade_date = b.trade_date
"""

# --- quotes -----------------------------------------------------------------------------------

_QUOTE_FIELDS = {
    3: "close", 4: "prev_close", 5: "open", 6: "volume", 30: "quote_time", 31: "change",
    32: "change_pct", 33: "high", 34: "low", 37: "amount", 38: "turnover", 39: "pe_ttm",
    43: "amplitude", 44: "circ_mv", 45: "total_mv", 46: "pb", 47: "high_limit", 48: "low_limit",
}


def quote_records(spark, d):
    """Each bar as a quote of 88 fields; a day's volume of 3000 is cut short, 1000 lacks PE and PB."""
    rows = V.query(spark, d, "SELECT * FROM bars")
    rows = rows.selectExpr("*", f"{BARS.lag('close')} AS prev_close")
    fields = {
        "change": "close - prev_close",
        "change_pct": "round(double(close - prev_close) / double(prev_close) * 100, 2)",
        "amplitude": "round(double(high - low) / double(prev_close) * 100, 2)",
        "quote_time": "date_format(trade_date, 'yyyyMMdd150000')",
        "circ_mv": "double(amount) / 1e4",
        "total_mv": "if(volume % 700 = 0, double(amount) / 2e4, double(amount) / 1e4)",
        "turnover": "double(volume) * 100 / (double(amount) / 1e4 * 1e8 / double(close)) * 100",
        "pe_ttm": "if(volume = 1000, NULL, double(volume) / 800)",
        "pb": "if(volume = 1000, NULL, double(volume) / 40)",
        "high_limit": "if(volume % 300 = 0, prev_close * 1.3, prev_close * 1.1)",
        "low_limit": "prev_close * 0.9",
    }
    values = []
    for i in range(88):
        name = _QUOTE_FIELDS.get(i)
        values.append(f"coalesce(string({fields.get(name, name)}), '')" if name else "''")
    full = f"concat_ws('~', {', '.join(values)})"
    short = "concat_ws('~', '1', stock_code, string(close))"
    return rows.selectExpr("stock_code", "trade_date", f"if(volume = 3000, {short}, {full}) AS record")


def quotes(spark, d):
    return raw_text.parse_quotes(quote_records(spark, d))


_QUOTE_SQL = """
SELECT stock_code, close, prev_close, high, low, CAST(volume AS DOUBLE) / 800 AS pe_ttm, CAST(volume AS DOUBLE) / 40 AS pb,
       amount, strftime(trade_date, '%Y%m%d150000') AS quote_time, volume, CAST(amount AS DOUBLE) / 1e4 AS circ_mv,
       CAST(amount AS DOUBLE) / CASE WHEN volume % 700 = 0 THEN 2e4 ELSE 1e4 END AS total_mv,
       prev_close * CASE WHEN volume % 300 = 0 THEN 1.3 ELSE 1.1 END AS high_limit
FROM (SELECT *, lag(close) OVER (PARTITION BY stock_code ORDER BY trade_date) AS prev_close FROM bars)
WHERE volume NOT IN (1000, 3000)
"""

# --- bars and statements ------------------------------------------------------------------------


def raw_bars(spark, d):
    return V.query(spark, d, """
        SELECT stock_code, concat(string(trade_date), ' 15:00:00') AS datetime, open, high, low, close, volume AS vol,
               amount, 'x' AS note FROM bars""")


def _daily_feed(spark, d):
    return feeds.daily_bars(raw_bars(spark, d), V.view(spark, d, "capital"), "1998-06-01")


def _daily_feed_marks(spark, d):
    starts = V.query(spark, d, "SELECT stock_code, date_sub(max(trade_date), 200) AS next_date FROM bars GROUP BY stock_code")
    return feeds.daily_bars(raw_bars(spark, d), V.view(spark, d, "capital"), starts)


def _sina(spark, d):
    """The three statements; one in seven cash statements and some announcement dates are missing."""
    q = lambda text: V.query(spark, d, text)
    key = "stock_code, date_format(report_date, 'yyyyMMdd') AS `报告日`, report_type AS `类型`"
    income = q(f"""SELECT {key}, if(quarter(report_date) = 2, NULL, date_format(announcement_date, 'yyyy-MM-dd')) AS `公告日期`,
        string(total_revenue) AS `营业总收入`, string(net_profit) AS `净利润`, string(eps) AS `基本每股收益`,
        if(quarter(report_date) = 3, '--', string(operating_cost)) AS `营业成本`, string(operating_cost + 1) AS `营业总成本`,
        string(net_profit_deducted) AS `扣除非经常性损益后的净利润`, string(interest_expense) AS `利息支出` FROM statements""")
    balance = q(f"""SELECT {key}, date_format(report_date, 'yyyy/MM/dd') AS `公告日期`, string(total_assets) AS `资产总计`,
        string(total_liabilities) AS `负债合计`, coalesce(string(equity_parent), 'nan') AS `归属于母公司股东权益合计`,
        string(inventory) AS `存货`, string(accounts_receivable) AS `应收账款`, string(accounts_payable) AS `应付账款`
        FROM statements""")
    cash = q(f"""SELECT {key}, string(operating_cash_flow) AS `经营活动产生的现金流量净额`,
        string(capex) AS `购建固定资产、无形资产和其他长期资产支付的现金` FROM statements
        WHERE equity_parent IS NOT NULL""")
    return income, balance, cash


def _em(spark, d):
    q = lambda text: V.query(spark, d, text)
    key = "stock_code, concat(string(report_date), ' 00:00:00') AS REPORT_DATE"
    income = q(f"""SELECT {key}, coalesce(concat(string(announcement_date), ' 00:00:00'), 'NaT') AS NOTICE_DATE,
        string(total_revenue) AS TOTAL_OPERATE_INCOME, string(operating_cost) AS OPERATE_COST, string(net_profit) AS PARENT_NETPROFIT,
        if(quarter(report_date) = 1, '', string(net_profit_deducted)) AS DEDUCT_PARENT_NETPROFIT, string(eps) AS BASIC_EPS,
        if(quarter(report_date) = 1, NULL, string(interest_expense)) AS FE_INTEREST_EXPENSE,
        string(interest_expense + 5) AS FINANCE_EXPENSE FROM statements""")
    # Every balance lands twice; the first landing counts.
    balance = q(f"""SELECT {key}, n AS _seq, string(total_assets + n) AS TOTAL_ASSETS, string(total_liabilities) AS TOTAL_LIABILITIES,
        string(equity_parent) AS TOTAL_PARENT_EQUITY, string(current_assets) AS TOTAL_CURRENT_ASSETS,
        if(quarter(report_date) = 4, NULL, string(current_liabilities)) AS TOTAL_CURRENT_LIAB, string(inventory) AS INVENTORY,
        string(accounts_receivable) AS ACCOUNTS_RECE, string(accounts_payable) AS ACCOUNTS_PAYABLE,
        string(monetary_funds) AS MONETARYFUNDS FROM (SELECT *, explode(array(0, 1)) AS n FROM statements)""")
    cash = q(f"""SELECT {key}, string(operating_cash_flow) AS NETCASH_OPERATE, string(capex) AS CONSTRUCT_LONG_ASSET FROM statements""")
    return income, balance, cash


_ROE_ASSETS = "round(CAST(net_profit AS DOUBLE) / nullif(CAST(total_assets AS DOUBLE) - CAST(total_liabilities AS DOUBLE), 0) * 100, 4)"
_ROE_PARENT = "round(CAST(net_profit AS DOUBLE) / nullif(CAST(equity_parent AS DOUBLE), 0) * 100, 4)"
_STATEMENT_VALUES = (
    "total_revenue net_profit eps operating_cost net_profit_deducted interest_expense total_assets "
    "total_liabilities equity_parent inventory accounts_receivable accounts_payable operating_cash_flow capex roe"
)


def _incomplete(spark, d):
    """Stored statements that lack deducted profit, current items and some interest."""
    st = V.query(spark, d, """SELECT stock_code, report_date, report_type, cast(NULL AS decimal(18,2)) AS net_profit_deducted,
        if(quarter(report_date) = 2, NULL, interest_expense) AS interest_expense, current_assets, current_liabilities,
        if(net_profit < 0, NULL, monetary_funds) AS monetary_funds FROM statements""")
    return st


def _deducted_patch(spark, d):
    """Deducted profit is overwritten where known; interest only fills gaps."""
    income, _, _ = _em(spark, d)
    fresh = feeds.deducted_profit_patch(income)
    rows = merge.update_from(_incomplete(spark, d), fresh, _PERIOD, ["net_profit_deducted"], merge.protect)
    return merge.update_from(rows, fresh, _PERIOD, ["interest_expense"], merge.fill)


def _balance_patch(spark, d):
    """The three balance items are overwritten together if any is known."""
    _, balance, _ = _em(spark, d)
    fresh = feeds.balance_patch(balance.where("_seq = 0"))
    return merge.patch_group(_incomplete(spark, d), fresh, _PERIOD, ["current_assets", "current_liabilities", "monetary_funds"])


def _quote_upsert(spark, d):
    """One day's quotes into the valuations: no orphan rows, no known value lost to a NULL."""
    day = V.AS_OF
    today = quote_records(spark, d).where(f"trade_date = date'{day}'")
    fresh = raw_text.quote_valuation(raw_text.parse_quotes(today), day)
    kept = merge.with_parent(fresh, V.view(spark, d, "bars"), ("stock_code", "trade_date"))
    stored = V.valuations(spark, d).select("stock_code", "trade_date", "pe_ttm", "pb", "ps_ttm")
    return merge.upsert(stored, kept, ("stock_code", "trade_date"), ["pe_ttm", "pb"], merge.protect)


def _minimal(spark, d):
    raw = V.query(spark, d, """SELECT stock_code, year(report_date) AS year, quarter(report_date) AS quarter,
        if(net_profit < 0, '', string(net_profit)) AS netProfit, if(net_profit < 0, 'None', string(total_revenue)) AS MBRevenue,
        string(announcement_date) AS pubDate FROM statements""")
    return feeds.statements_minimal(raw)


# --- dimensions and actions -----------------------------------------------------------------------


def _industries(spark, d):
    """Every code lands twice with the later name last; a nation without name drops out."""
    raw = V.query(spark, d, f"""SELECT concat(left(stock_code, 2), '.', substring(stock_code, 3)) AS code, n AS _seq,
        if(n = 0, 'old', industry_name) AS industry, industry_level AS industryClassification
        FROM (SELECT *, explode(array(0, 1)) AS n FROM industry)""")
    return feeds.industries(raw, AS_OF)


def _dividends(spark, d):
    raw = V.query(spark, d, """SELECT stock_code, 1 AS _seq, string(cash_per_share) AS dividCashPsBeforeTax,
        if(cash_per_share > 0.3, '', string(dividend_date)) AS dividOperateDate, string(announcement_date) AS dividPlanAnnounceDate FROM dividends
        UNION ALL SELECT stock_code, 0, '0.5', string(dividend_date), '' FROM dividends""")
    return feeds.dividends(raw)


def _dividends_per_ten(spark, d):
    raw = V.query(spark, d, """SELECT stock_code, date_format(dividend_date, 'yyyyMMdd') AS `除权除息日`, string(cash_per_share * 10) AS `派息`,
        if(cash_per_share > 0.2, '预案', '已实施完成') AS `进度`, date_format(announcement_date, 'yyyy/MM/dd') AS `公告日期` FROM dividends""")
    return feeds.dividends_per_ten(raw)


def _share_items(spark, d):
    items = V.query(spark, d, """SELECT stock_code, p AS position,
        CASE WHEN p = 1 THEN '行业' WHEN p = 2 THEN 'A股总股本' ELSE '总股本' END AS item,
        CASE WHEN p = 2 AND total_shares % 2 = 0 THEN 'unknown' ELSE string(total_shares + p) END AS value
        FROM (SELECT *, explode(array(1, 2, 3)) AS p FROM capital WHERE record_date = date'1999-06-30')""")
    return feeds.total_shares_from_items(items, AS_OF)


def _share_quarters(spark, d):
    profit = V.query(spark, d, """SELECT stock_code, year(report_date) AS year, quarter(report_date) AS quarter,
        if(net_profit < 0, '0', string(floor(total_revenue))) AS totalShare FROM statements""")
    return feeds.total_shares_from_quarters(profit, AS_OF)


def _northbound(spark, d):
    raw = V.query(spark, d, """SELECT stock_code, string(trade_date) AS `持股日期`, string(holding_shares) AS `持股数量`,
        string(holding_value) AS `持股市值`, string(holding_ratio) AS `持股数量占A股百分比`,
        if(net_inflow = 0, '-', string(net_inflow)) AS `今日增持资金` FROM northbound_rows""")
    return feeds.northbound(raw)


def _northbound_market(spark, d):
    raw = V.query(spark, d, """SELECT date_format(trade_date, 'yyyyMMdd') AS `日期`, string(net_buy_amount) AS `当日成交净买额`,
        string(buy_amount) AS `买入成交额`, string(sell_amount) AS `卖出成交额`, string(cumulative_net_buy) AS `历史累计净买额`,
        string(daily_inflow) AS `当日资金流入`, 'n/a' AS `当日余额`, string(holding_market_value) AS `持股市值` FROM northbound_market""")
    return feeds.northbound_market(raw)


def _margin(spark, d):
    """Two exchanges' files with different code columns, put together."""
    raw = V.query(spark, d, """SELECT if(left(stock_code, 2) = 'sh', substring(stock_code, 3), NULL) AS `标的证券代码`,
        if(left(stock_code, 2) = 'sz', substring(stock_code, 3), NULL) AS `证券代码`, date_format(trade_date, 'yyyyMMdd') AS _trade_date,
        coalesce(string(rz_balance), 'None') AS `融资余额`, string(rq_balance) AS `融券余额` FROM margin_legs""")
    return feeds.margin(raw, V.view(spark, d, "master"))


def _announcements(spark, d):
    raw = V.query(spark, d, """SELECT stock_code, date_format(announcement_date, 'yyyy-MM-dd') AS `公告日期`, title AS `公告标题`,
        pdf_url AS `网址`, announcement_type AS `公告类型` FROM announcements""")
    return feeds.announcements(raw)


#: Symbols that land without a code, and days whose dates land in another format.
_NAMELESS, _ODD_DAY = "right(stock_code, 1) = '7'", 13


def _broken(day: str) -> str:
    """Key columns of a feed in which some rows cannot be read."""
    return f"if({_NAMELESS}, NULL, stock_code) AS stock_code, if(day({day}) = {_ODD_DAY}, date_format({day}, 'dd.MM.yyyy'), string({day}))"


def _broken_feeds(spark, d):
    q = lambda text: V.query(spark, d, text)
    return {
        "northbound": q(f"SELECT {_broken('trade_date')} AS `持股日期`, string(net_inflow) AS `今日增持资金`, string(holding_shares) AS `持股数量`, "
                        "string(holding_value) AS `持股市值`, string(holding_ratio) AS `持股数量占A股百分比` FROM northbound_rows"),
        "announcements": q(f"SELECT {_broken('announcement_date')} AS `公告日期`, title AS `公告标题`, pdf_url AS `网址`, "
                           "announcement_type AS `公告类型` FROM announcements"),
        "margin": q(f"SELECT code AS `证券代码`, day AS _trade_date, '1' AS `融资余额`, '2' AS `融券余额` FROM (SELECT stock_code AS code, day FROM "
                    f"(SELECT {_broken('trade_date')} AS day FROM margin_legs))"),
        "statements_sina": q("SELECT stock_code, if(quarter(report_date) = 3, date_format(report_date, 'dd.MM.yyyy'), string(report_date)) AS `报告日`, "
                             "report_type AS `类型` FROM statements"),
        "statements_minimal": q("SELECT stock_code, if(quarter(report_date) = 3, 'x', string(year(report_date))) AS year, "
                                "quarter(report_date) AS quarter FROM statements"),
    }


def _feed_rejects(spark, d):
    """The rows whose keys cannot be read, with the reason, and how many rows the parsers return of the rest."""
    out = None
    for feed, raw in _broken_feeds(spark, d).items():
        rows = feeds.unreadable(feed, raw).selectExpr(f"'{feed}' AS feed", "reject_reason").groupBy("feed", "reject_reason").count()
        out = rows if out is None else out.unionByName(rows)
    return out.withColumnRenamed("count", "rows")


def _loaded_rejects(spark, d):
    """The same rows after a load, among the rejects of their table; all others are stored."""
    raw = _broken_feeds(spark, d)["northbound"]
    root = f"{shared_folder(spark)}/feed-rejects-{uuid.uuid4().hex}"
    load(spark, {"northbound_flow": feeds.northbound(raw)}, root, {"northbound_flow": feeds.unreadable("northbound", raw)})
    rejects = spark.read.parquet(f"{root}/rejects/northbound_flow").selectExpr("'rejects' AS place", "count(*) AS rows")
    stored = scan(spark, f"{root}/tables", "northbound_flow").selectExpr("'stored' AS place", "count(*) AS rows")
    return rejects.unionByName(stored)


def _newest_pledge(spark, d):
    return feeds.pledge(feeds.newest_pledge_snapshot(V.view(spark, d, "raw_pledge"), AS_OF))


def _top_list(spark, d):
    return feeds.top_list(V.view(spark, d, "raw_top_list"), V.view(spark, d, "master"))


def _collisions(spark, d):
    rows = feeds.top_list(V.view(spark, d, "raw_top_list"))
    return quality.truncation_collisions(rows, ["stock_code", "trade_date"], "reason", feeds.DISPLAY_WIDTH)


_UNLOCK_ALL = "SELECT * FROM risk_unlock"

CHECKS = [
    Check("flow_lines", flow_rows, f"{_FLOW_SQL} WHERE NOT ({_SHORT} OR {_BROKEN})", KEY, _FLOW_COLUMNS, DAY),
    Check("flow_drifting", lambda s, d: _drifting(s, d).where("reject_reason IS NULL").drop("record", "payload"), f"""
        SELECT *, CASE WHEN {_NAMED} THEN 'r' || stock_code END AS rating FROM ({_FLOW_SQL})
        WHERE CASE WHEN {_NAMED} THEN NOT (contains(stock_code, '9') AND month(trade_date) = 5) ELSE NOT ({_SHORT} OR {_BROKEN}) END""",
          f"{KEY} rating", _FLOW_COLUMNS, DAY),
    Check("flow_drift_rejects", _drift_rejects, f"""
        SELECT stock_code, 'unreadable record' AS reject_reason, count(*) AS rows FROM ({_FLOW_SQL})
        WHERE NOT ({_NAMED}) AND ({_SHORT} OR {_BROKEN}) GROUP BY stock_code
        UNION ALL SELECT stock_code, 'no JSON', count(DISTINCT year(trade_date)) FROM ({_FLOW_SQL})
        WHERE {_NAMED} AND contains(stock_code, '9') AND month(trade_date) = 5 GROUP BY stock_code""", f"{KEY} reject_reason", "", "", "rows"),
    Check("flow_rejects", _flow_rejects, f"""
        SELECT stock_code, CASE WHEN {_SHORT} THEN 'too_few_fields' ELSE 'unparsable' END AS reason,
               strftime(trade_date, '%Y-%m-%d') AS line_date
        FROM capital_flow WHERE {_SHORT} OR {_BROKEN}""", f"{KEY} reason line_date"),
    Check("quotes", quotes, _QUOTE_SQL, f"{KEY} quote_time", "close prev_close high low pe_ttm pb amount circ_mv total_mv high_limit", "", "volume"),
    Check("quote_identities", lambda s, d: quality.quote_identities(quotes(s, d)), f"""
        SELECT stock_code, coalesce(least(abs(CAST(high_limit AS DOUBLE) / prev_close - 1.05), abs(CAST(high_limit AS DOUBLE) / prev_close - 1.1), abs(CAST(high_limit AS DOUBLE) / prev_close - 1.2)) < 0.005, false) AS ok_limit_band,
               prev_close IS NOT NULL AS ok_change_pct, prev_close IS NOT NULL AS ok_amplitude, true AS ok_turnover,
               total_mv >= circ_mv - 1e-6 AS ok_cap_order, pe_ttm >= 1 AS ok_pe_not_tiny, pb < 100 AS ok_pb_range,
               low <= close AND close <= high AS ok_close_in_range
        FROM ({_QUOTE_SQL})""",
          "stock_code ok_limit_band ok_change_pct ok_amplitude ok_turnover ok_cap_order ok_pe_not_tiny ok_pb_range ok_close_in_range"),
    Check("daily_feed", _daily_feed, "SELECT * FROM stock_daily WHERE trade_date >= DATE '1998-06-01'", KEY,
          "open high low close amount turnover outstanding_share", DAY, "volume"),
    Check("daily_feed_watermarks", _daily_feed_marks, """
        SELECT b.* FROM stock_daily b JOIN (SELECT stock_code, max(trade_date) - 200 AS n FROM bars GROUP BY stock_code) s
          ON b.stock_code = s.stock_code AND b.trade_date >= s.n""", KEY, "close turnover", DAY, "volume"),
    Check("statements_sina", lambda s, d: feeds.statements_sina(*_sina(s, d)), f"""
        SELECT * EXCLUDE (operating_cost, announcement_date, operating_cash_flow, capex),
               CASE WHEN quarter(report_date) = 3 THEN operating_cost + 1 ELSE operating_cost END AS operating_cost,
               CASE WHEN quarter(report_date) <> 2 THEN announcement_date END AS announcement_date,
               CASE WHEN equity_parent IS NOT NULL THEN operating_cash_flow END AS operating_cash_flow,
               CASE WHEN equity_parent IS NOT NULL THEN capex END AS capex, {_ROE_ASSETS} AS roe FROM statements""",
          f"{KEY} report_type", _STATEMENT_VALUES, "report_date announcement_date"),
    Check("statements_balance_announces", lambda s, d: feeds.statements_sina(*_sina(s, d), balance_announces=True), """
        SELECT stock_code, report_type, report_date, total_revenue,
               CASE WHEN quarter(report_date) = 2 THEN report_date ELSE coalesce(announcement_date, report_date) END AS announcement_date
        FROM statements""", f"{KEY} report_type", "total_revenue", "report_date announcement_date"),
    Check("statements_em", lambda s, d: feeds.statements_em(*_em(s, d)), f"""
        SELECT * EXCLUDE (report_type, net_profit_deducted, interest_expense, current_liabilities), '合并报表' AS report_type,
               CASE WHEN quarter(report_date) <> 1 THEN net_profit_deducted END AS net_profit_deducted,
               CASE WHEN quarter(report_date) = 1 THEN interest_expense + 5 ELSE interest_expense END AS interest_expense,
               CASE WHEN quarter(report_date) <> 4 THEN current_liabilities END AS current_liabilities,
               {_ROE_PARENT} AS roe FROM statements""", f"{KEY} report_type",
          f"{_STATEMENT_VALUES} current_assets current_liabilities", "report_date announcement_date"),
    Check("statements_minimal", _minimal, "SELECT * EXCLUDE (report_type), '合并报表' AS report_type FROM statements WHERE net_profit >= 0",
          f"{KEY} report_type", "net_profit total_revenue", "report_date announcement_date"),
    Check("statement_deducted_patch", _deducted_patch, """
        SELECT stock_code, report_date, report_type, CASE WHEN quarter(report_date) <> 1 THEN net_profit_deducted END AS net_profit_deducted,
               interest_expense FROM statements""", f"{KEY} report_type", "net_profit_deducted interest_expense", "report_date"),
    Check("statement_balance_patch", _balance_patch, """
        SELECT stock_code, report_date, report_type, current_assets, monetary_funds,
               CASE WHEN quarter(report_date) <> 4 THEN current_liabilities END AS current_liabilities FROM statements""",
          f"{KEY} report_type", "current_assets current_liabilities monetary_funds", "report_date"),
    Check("quote_valuation_upsert", _quote_upsert, f"""
        SELECT coalesce(v.stock_code, q.stock_code) AS stock_code, coalesce(v.trade_date, q.trade_date) AS trade_date,
               coalesce(q.pe_ttm, v.pe_ttm) AS pe_ttm, coalesce(q.pb, v.pb) AS pb, v.ps_ttm
        FROM valuation v FULL JOIN (SELECT stock_code, trade_date, CAST(volume AS DOUBLE) / 800 AS pe_ttm, CAST(volume AS DOUBLE) / 40 AS pb
            FROM bars WHERE trade_date = DATE '{V.AS_OF}' AND volume NOT IN (1000, 3000)) q
          ON v.stock_code = q.stock_code AND v.trade_date = q.trade_date""", KEY, "pe_ttm pb ps_ttm", DAY),
    Check("pledges", V.BUILDERS["risk_pledge"], "SELECT * FROM risk_pledge", KEY, "pledge_ratio pledge_market_value", DAY,
          "pledge_shares pledge_count"),
    Check("newest_pledge_snapshot", _newest_pledge, """
        SELECT * FROM risk_pledge WHERE trade_date = (SELECT max(trade_date) FROM risk_pledge
          WHERE trade_date <= DATE '2000-03-24' AND trade_date > DATE '2000-03-24' - 28)""", KEY, "pledge_ratio", DAY, "pledge_shares"),
    Check("holder_changes", V.BUILDERS["risk_holder_change"], "SELECT * FROM risk_holder_change",
          f"{KEY} holder_name change_type", "change_ratio", "announcement_date change_start_date",
          "change_shares hold_after_shares"),
    Check("buybacks", V.BUILDERS["risk_buyback"], "SELECT * FROM risk_buyback", f"{KEY} progress",
          "amount_lower amount_upper done_amount", "announcement_date plan_start_date", "shares_lower shares_upper done_shares"),
    Check("unlocks", V.BUILDERS["risk_unlock"], _UNLOCK_ALL, f"{KEY} free_type",
          "actual_free_value ratio_to_float close_before", "free_date", "free_shares actual_free_shares"),
    Check("holder_counts", V.BUILDERS["risk_holder_num"], "SELECT * FROM risk_holder_num", KEY,
          "change_ratio avg_mktcap", "stat_date notice_date", "holder_num holder_num_prev holder_num_change total_shares"),
    Check("industries", _industries, f"""
        SELECT stock_code, coalesce(industry_name, 'old') AS industry_name, industry_level, DATE '{AS_OF}' AS update_date
        FROM industry""", f"{KEY} industry_name industry_level", "", "update_date"),
    Check("dividend_feed", _dividends, """
        SELECT stock_code, dividend_date, CASE WHEN cash_per_share > 0.3 OR cash_per_share = 0 THEN 0.5 ELSE cash_per_share END AS cash_per_share,
               CASE WHEN cash_per_share <= 0.3 AND cash_per_share <> 0 THEN announcement_date END AS announcement_date
        FROM dividends""", KEY, "cash_per_share", "dividend_date announcement_date"),
    Check("dividend_feed_per_ten", _dividends_per_ten, "SELECT * FROM dividends WHERE cash_per_share <= 0.2 AND cash_per_share <> 0",
          KEY, "cash_per_share", "dividend_date announcement_date"),
    Check("shares_from_items", _share_items, f"""
        SELECT stock_code, DATE '{AS_OF}' AS record_date, total_shares + CASE WHEN total_shares % 2 = 0 THEN 3 ELSE 2 END AS total_shares
        FROM capital WHERE record_date = DATE '1999-06-30'""", KEY, "", "record_date", "total_shares"),
    Check("shares_from_quarters", _share_quarters, f"""
        SELECT stock_code, DATE '{AS_OF}' AS record_date, arg_max(floor(total_revenue), report_date) AS total_shares
        FROM statements WHERE net_profit >= 0 AND floor(total_revenue) > 0 AND report_date BETWEEN DATE '1998-01-01' AND DATE '{AS_OF}'
        GROUP BY stock_code""", KEY, "", "record_date", "total_shares"),
    Check("top_list", _top_list, "SELECT * FROM top_list WHERE stock_code IN (SELECT stock_code FROM master)",
          f"{KEY} list_type reason", "buy_amount sell_amount net_amount", DAY),
    Check("list_truncation", _collisions, """
        SELECT stock_code, trade_date, left(reason, 50) AS short_text, count(DISTINCT reason) AS variants FROM top_list
        GROUP BY stock_code, trade_date, left(reason, 50) HAVING count(DISTINCT reason) > 1""", f"{KEY} short_text", "", DAY, "variants"),
    Check("feed_rejects", _feed_rejects, f"""
        SELECT feed, concat_ws(', ', CASE WHEN nameless THEN 'no stock_code' END,
                               CASE WHEN odd THEN 'unreadable ' || key || ': ' || landed END) AS reject_reason, count(*) AS rows
        FROM (
          SELECT 'northbound' AS feed, 'trade_date' AS key, {_NAMELESS} AS nameless, day(trade_date) = {_ODD_DAY} AS odd,
                 strftime(trade_date, '%d.%m.%Y') AS landed FROM northbound_rows
          UNION ALL SELECT 'announcements', 'announcement_date', {_NAMELESS}, day(announcement_date) = {_ODD_DAY},
                 strftime(announcement_date, '%d.%m.%Y') FROM announcements
          UNION ALL SELECT 'margin', 'trade_date', {_NAMELESS}, day(trade_date) = {_ODD_DAY}, strftime(trade_date, '%d.%m.%Y') FROM margin_legs
          UNION ALL SELECT 'statements_sina', 'report_date', false, quarter(report_date) = 3, strftime(report_date, '%d.%m.%Y') FROM statements
          UNION ALL SELECT 'statements_minimal', 'report_date', false, quarter(report_date) = 3, 'xQ3' FROM statements
        ) WHERE nameless OR odd GROUP BY ALL""", "feed reject_reason", "", "", "rows"),
    Check("feed_rejects_loaded", _loaded_rejects, f"""
        SELECT CASE WHEN {_NAMELESS} OR day(trade_date) = {_ODD_DAY} THEN 'rejects' ELSE 'stored' END AS place, count(*) AS rows
        FROM northbound_rows GROUP BY ALL""", "place", "", "", "rows"),
    Check("northbound_feed", _northbound, "SELECT * FROM northbound_rows", KEY,
          "net_inflow holding_shares holding_value holding_ratio", DAY),
    Check("northbound_market_feed", _northbound_market, "SELECT * EXCLUDE (daily_balance), CAST(NULL AS DOUBLE) AS daily_balance FROM northbound_market",
          "", "net_buy_amount buy_amount sell_amount cumulative_net_buy daily_inflow daily_balance holding_market_value", DAY),
    Check("margin_feed", _margin, f"""
        SELECT * FROM (SELECT {relist("substr(stock_code, 3)")} AS stock_code, trade_date, rz_balance, rq_balance FROM margin_legs)
        WHERE stock_code IN (SELECT stock_code FROM master)""", KEY, "rz_balance rq_balance", DAY),
    Check("announcement_feed", _announcements, "SELECT * FROM announcements", f"{KEY} title pdf_url announcement_type", "", "announcement_date"),
]
