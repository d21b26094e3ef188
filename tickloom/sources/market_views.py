"""The domain tables, derived from the supplied trade tables.

Every line item is read as a trade of its supplier's instrument: bars, statements, flows and
events are aggregates of those trades per instrument and period, so each table grows with the
data. Aggregates combine on the map side, which also shrinks a hot instrument to one row per day
and task before any shuffle; per-row amounts are whole cents, so sums do not depend on their order.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tickloom.functions.scalar import decimal4, is_fund, text_literal
from tickloom.operators.daily import fill_turnover, with_daily_basic
from tickloom.operators.flows import inflow_sums, margin_changes
from tickloom.operators.fundamentals import fundamentals
from tickloom.operators.latest import keep_last
from tickloom.operators.technical import technical
from tickloom.operators.valuation import valuation
from tickloom.schema import TABLES
from tickloom.sources import feeds
from tickloom.sources.sqltext import compose
from tickloom.sources.tables import surrogate_id

AS_OF = "2001-06-30"
RISK_AS_OF = "2000-03-31"

SOURCES = ("lineitem", "orders", "supplier", "customer", "nation", "region", "events")


def symbol(key: str) -> str:
    """Exchange, board digit and number; one in ten instruments is a fund."""
    digits = f"if({key} < 100000, lpad(string({key}), 5, '0'), string({key}))"
    return (
        f"concat(CASE WHEN {key} % 10 < 3 THEN 'sh6' WHEN {key} % 10 < 6 THEN 'sz0' "
        f"WHEN {key} % 10 < 9 THEN 'sz3' WHEN {key} % 20 = 9 THEN 'sh5' ELSE 'sz1' END, {digits})"
    )


def bare(key: str) -> str:
    return f"substring({symbol(key)}, 3)"


def quarter_day(day: str) -> str:
    return f"last_day(make_date(year({day}), quarter({day}) * 3, 1))"


def sum_if(condition: str, value: str) -> str:
    return f"sum(if({condition}, {value}, 0L))"


def yuan(cents: str, digits: int = 18) -> str:
    """Whole cents as a decimal amount."""
    return f"cast(cast({cents} AS decimal({digits},0)) * 0.01BD AS decimal({digits},2))"


# Trades: listed, net of discount, with tax, and the parts, all in whole cents. ``seq`` orders the
# trades of a day by one number, so that first and last stay hash aggregates.
_TRADES = """
SELECT suppkey, day, partkey, orderkey, linenumber, qty, flag, status, ep,
       (ep * (100 - off) + 50) div 100 AS net, (ep * (100 + tax) + 50) div 100 AS gross,
       (ep * off + 50) div 100 AS cut, (ep * tax + 50) div 100 AS fee,
       cast(cast(orderkey * 8 + linenumber AS decimal(22,0)) * cast(10000000000 AS decimal(11,0))
            + ep AS decimal(38,0)) AS seq
FROM (
  SELECT l_suppkey AS suppkey, date(l_shipdate) AS day, l_partkey AS partkey,
         l_orderkey AS orderkey, l_linenumber AS linenumber,
         cast(l_quantity AS bigint) AS qty, l_returnflag AS flag, l_linestatus AS status,
         cast(l_extendedprice * 100 + 0.5D AS bigint) AS ep,
         cast(l_discount * 100 + 0.5D AS bigint) AS off, cast(l_tax * 100 + 0.5D AS bigint) AS tax
  FROM lineitem_rows
)
"""

_BARS = f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       {yuan("open", 10)} AS open, {yuan("high", 10)} AS high, {yuan("low", 10)} AS low,
       {yuan("close", 10)} AS close, volume, {yuan("amount")} AS amount
FROM (
  SELECT suppkey, day, min_by(ep, seq) AS open, max(gross) AS high, min(net) AS low,
         max_by(net + fee, seq) AS close, sum(qty) * 100 AS volume, sum(ep) AS amount
  FROM trades GROUP BY suppkey, day
)
"""

# Quarterly statements: flows cumulated within the year, balances per quarter. Some instruments
# announce late or never, report no parent equity, or owe more than they own.
_QUARTERS = f"""
SELECT suppkey, {quarter_day("day")} AS report_date,
       sum(net) AS revenue, sum(cut) * 5 + sum(fee) * 4 AS cost,
       {sum_if("flag = 'R'", "ep")} AS returned, sum(fee) AS fees, sum(cut) AS cuts,
       sum(ep) AS listed, {sum_if("status = 'F'", "net")} AS cash_in,
       {sum_if("status = 'O'", "cut")} AS cash_out, {sum_if("flag = 'N'", "fee")} AS interest,
       {sum_if("status = 'O'", "net")} AS open_net, {sum_if("status = 'F'", "cut")} AS done_cut,
       sum(qty) AS qty
FROM trades GROUP BY suppkey, {quarter_day("day")}
"""

_POSITIONS = """
SELECT *, revenue - cost - returned AS profit, qty * 100000 AS stock,
       done_cut * 3 AS payable
FROM quarters
"""

_LEVELS = """
SELECT *, stock + open_net + fees AS current_assets, payable + cuts AS current_debts,
       stock + open_net + fees + listed * 2 AS assets,
       payable + cuts + cuts * CASE WHEN suppkey % 17 = 1 THEN 40 ELSE 2 END AS debts
FROM positions
"""


def _ytd(x: str) -> str:
    window = (
        "PARTITION BY suppkey, year(report_date) ORDER BY report_date "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    )
    return yuan(f"sum({x}) OVER ({window})")


_STATEMENTS = f"""
SELECT stock_code, report_date, report_type, total_revenue, net_profit, total_assets,
       total_liabilities, operating_cash_flow,
       cast(cast(floor(double(net_profit) / 100) AS decimal(18,0))
            * cast('0.0001' AS decimal(5,4)) AS decimal(10,4)) AS eps,
       equity_parent, announcement_date, operating_cost, net_profit_deducted, inventory,
       accounts_receivable, accounts_payable, capex, interest_expense, current_assets,
       current_liabilities, monetary_funds
FROM (
  SELECT {symbol("suppkey")} AS stock_code, report_date, '合并期末' AS report_type,
         {_ytd("revenue")} AS total_revenue, {_ytd("profit")} AS net_profit,
         {yuan("assets")} AS total_assets,
         {yuan("debts")} AS total_liabilities,
         {_ytd("cash_in - cash_out")} AS operating_cash_flow,
         {yuan("if(suppkey % 7 != 0, assets - debts, NULL)")} AS equity_parent,
         if(suppkey % 11 != 10, date_add(report_date, cast(20 + suppkey % 40
            + if(suppkey % 5 = 0 AND quarter(report_date) = 3, 200, 0) AS int)), NULL)
           AS announcement_date,
         {_ytd("cost")} AS operating_cost, {_ytd("profit - fees")} AS net_profit_deducted,
         {yuan("stock")} AS inventory,
         {yuan("open_net")} AS accounts_receivable,
         {yuan("payable")} AS accounts_payable,
         {_ytd("cuts")} AS capex, {_ytd("interest")} AS interest_expense,
         {yuan("current_assets")} AS current_assets,
         {yuan("current_debts")} AS current_liabilities,
         {yuan("fees + cash_in")} AS monetary_funds
  FROM levels
)
"""

# Two share counts per instrument; overdrawn suppliers have none.
_CAPITAL = f"""
SELECT {symbol("s_suppkey")} AS stock_code, d AS record_date,
       cast(if(d = date'1999-06-30' AND base > 0, base + s_suppkey % 3 * 500, base)
            AS decimal(20,0)) AS total_shares
FROM (
  SELECT s_suppkey, cast(floor(greatest(s_acctbal, 0D)) AS bigint) AS base,
         explode(array(date'1995-01-01', date'1999-06-30')) AS d
  FROM supplier_rows
)
"""

# Fees of returned trades, paid out per day.
_DIVIDENDS = f"""
SELECT {symbol("suppkey")} AS stock_code, day AS dividend_date,
       cast(cast(fee div 100 AS decimal(18,0)) * cast('0.0001' AS decimal(5,4)) AS decimal(10,4))
         AS cash_per_share,
       date_sub(day, 30) AS announcement_date
FROM (SELECT suppkey, day, sum(fee) AS fee FROM trades WHERE flag = 'R' GROUP BY suppkey, day)
"""

_MASTER = f"""
SELECT stock_code, s_name AS stock_name, concat(n_name, ' / ', s_name) AS stock_name_cn,
       upper(left(stock_code, 2)) AS market,
       if({is_fund("stock_code")}, 'ETF', n_name) AS board,
       if({is_fund("stock_code")}, NULL, date_add(date'1990-01-01', s_nationkey * 30))
         AS listing_date,
       '正常' AS status, {is_fund("stock_code")} AS is_etf
FROM (SELECT *, {symbol("s_suppkey")} AS stock_code FROM supplier_rows)
JOIN nation_rows ON s_nationkey = n_nationkey
"""

_INDUSTRY = f"""
SELECT {symbol("s_suppkey")} AS stock_code, if(n_nationkey != 24, n_name, NULL) AS industry_name,
       r_name AS industry_level, 'view' AS source,
       date_add(date'2000-01-01', cast(s_suppkey % 28 AS int)) AS update_date
FROM supplier_rows JOIN nation_rows ON s_nationkey = n_nationkey
JOIN region_rows ON n_regionkey = r_regionkey
"""

# Net amounts by trade size; returned trades count negative.
_SIGNED = "if(flag = 'R', -ep, ep)"
_FLOW_SIZES = {
    "xlarge": "qty >= 40",
    "large": "qty >= 25 AND qty < 40",
    "medium": "qty >= 10 AND qty < 25",
    "small": "qty < 10",
}
_FLOW_NAMES = ("main", *_FLOW_SIZES)
_CAPITAL_FLOW = f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       {", ".join(f"{yuan(n)} AS {n}_net_amount" for n in _FLOW_NAMES)},
       {", ".join(f"{decimal4(f'double({n}) / double(traded) * 100')} AS {n}_net_ratio"
                  for n in _FLOW_NAMES)}
FROM (
  SELECT *, xlarge + large AS main FROM (
    SELECT suppkey, day, sum(ep) AS traded,
           {", ".join(f"{sum_if(c, _SIGNED)} AS {n}" for n, c in _FLOW_SIZES.items())}
    FROM trades GROUP BY suppkey, day
  )
)
"""

# A day without trades of a leg leaves its balance NULL.
_MARGIN_LEGS = f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       {yuan("rz")} AS rz_balance, {yuan("rq")} AS rq_balance
FROM (
  SELECT suppkey, day, sum(if(status = 'O', ep, NULL)) AS rz, sum(if(status = 'F', ep, NULL)) AS rq
  FROM trades GROUP BY suppkey, day
)
"""

_NORTHBOUND_ROWS = f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       {yuan("inflow")} AS net_inflow, cast(qty AS decimal(20,0)) AS holding_shares,
       {yuan("value")} AS holding_value, {decimal4("double(qty) / 500")} AS holding_ratio
FROM (
  SELECT suppkey, day, sum(qty) AS qty, sum(gross) AS value,
         {sum_if("flag = 'A'", "net")} - {sum_if("flag = 'R'", "net")} AS inflow
  FROM trades GROUP BY suppkey, day
)
"""

_RUNNING = "sum(buy - sell) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_MARKET_COLUMNS = {
    "net_buy_amount": "buy - sell",
    "buy_amount": "buy",
    "sell_amount": "sell",
    "cumulative_net_buy": _RUNNING,
    "daily_inflow": "buy - sell + fee",
    "daily_balance": "fee",
    "holding_market_value": "held",
}
# One row per calendar day, so the running total needs no key.
_NORTHBOUND_MARKET = f"""
SELECT day AS trade_date,
       {", ".join(f"cast({yuan(x)} AS decimal(18,4)) AS {n}" for n, x in _MARKET_COLUMNS.items())}
FROM (
  SELECT day, {sum_if("flag = 'A'", "net")} AS buy, {sum_if("flag = 'R'", "net")} AS sell,
         sum(gross) AS held, sum(fee) AS fee
  FROM trades GROUP BY day
)
"""

# Orders as notices of their customer's instrument; not every customer is listed.
_ANNOUNCEMENTS = f"""
SELECT xxhash64(o_orderkey) AS id, {symbol("o_custkey")} AS stock_code,
       date(o_orderdate) AS announcement_date,
       concat(o_orderpriority, ' notice ', string(o_orderkey)) AS title,
       concat('/notices/', string(o_orderkey), '.pdf') AS pdf_url,
       o_orderstatus AS announcement_type
FROM orders_rows
"""

# Watermarks of two feeds; some run ahead of their data.
_UPDATE_LOG = f"""
SELECT {symbol("suppkey")} AS stock_code, data_type,
       if(data_type = 'margin', date_add(last, cast(suppkey % 4 AS int) - 1), last)
         AS last_update_date
FROM (
  SELECT suppkey, last, explode(array('margin', 'daily')) AS data_type
  FROM (SELECT suppkey, max(day) AS last FROM trades GROUP BY suppkey)
)
"""

# --- raw records, as providers would land them ---------------------------------------------------

# Fridays' trades as weekly pledge snapshots, numbers as text in ten-thousands.
_RAW_PLEDGE = f"""
SELECT {bare("suppkey")} AS `股票代码`, day AS snapshot_date,
       if(qty = 50, '--', string(cast(qty / 4 AS decimal(18,2)))) AS `质押比例`,
       string(cast(qty AS decimal(18,4)) * cast('0.0130' AS decimal(6,4))) AS `质押股数`,
       string({yuan("ep")}) AS `质押市值`, string(n) AS `质押笔数`
FROM (
  SELECT suppkey, day, sum(qty) AS qty, sum(ep) AS ep, count(*) AS n
  FROM trades WHERE dayofweek(day) = 6 GROUP BY suppkey, day
)
"""

# Each trade as one disclosure by the part's holder; dates in three spellings.
_RAW_HOLDER_CHANGE = f"""
SELECT {bare("suppkey")} AS `代码`,
       CASE WHEN qty = 13 THEN '--' WHEN qty % 3 = 0 THEN date_format(day, 'yyyy/MM/dd')
            WHEN qty % 3 = 1 THEN date_format(day, 'yyyyMMdd')
            ELSE date_format(day, 'yyyy-MM-dd') END AS `公告日`,
       if(qty = 7, ' ', concat(' holder ', string(partkey), ' ')) AS `股东名称`,
       CASE flag WHEN 'A' THEN '增持' WHEN 'R' THEN '减持' ELSE '其他' END AS `持股变动信息-增减`,
       if(qty = 1, '0', string({yuan("ep", 12)})) AS `持股变动信息-变动数量`,
       string(cast(qty / 10 AS decimal(10,2))) AS `持股变动信息-占总股本比例`,
       string({yuan("gross", 12)}) AS `变动后持股情况-持股总数`, '-' AS `变动后持股情况-占总股本比例`,
       date_format(date_sub(day, 10), 'yyyy-MM-dd') AS `变动开始日`, 'nan' AS `变动截止日`
FROM trades
"""

# Orders as buyback plans; the priority stands for the progress.
_RAW_BUYBACK = f"""
SELECT {bare("o_custkey")} AS `股票代码`,
       if(o_orderstatus = 'P', date_format(o_orderdate, 'yyyyMMdd'), day) AS `最新公告日期`,
       CASE o_orderpriority WHEN '1-URGENT' THEN '实施中' WHEN '2-HIGH' THEN '董事会预案'
            WHEN '3-MEDIUM' THEN '股东大会通过' WHEN '4-NOT SPECIFIED' THEN '完成实施'
            ELSE '' END AS `实施进度`,
       day AS `回购起始时间`, '--' AS `计划回购价格区间`,
       string(o_orderkey) AS `计划回购数量区间-下限`,
       string(o_orderkey + 10) AS `计划回购数量区间-上限`,
       string(total) AS `计划回购金额区间-下限`, string(total + 1) AS `计划回购金额区间-上限`,
       string(o_custkey) AS `已回购股份数量`,
       if(o_orderstatus != 'O', string(total), NULL) AS `已回购金额`,
       '' AS `已回购股份价格区间-下限`, '' AS `已回购股份价格区间-上限`
FROM (
  SELECT *, cast(o_totalprice AS decimal(12,2)) AS total,
         date_format(o_orderdate, 'yyyy-MM-dd') AS day
  FROM orders_rows
)
"""

# Trades as unlocked lots; not yet shipped ones have no actual figures.
_RAW_UNLOCK = f"""
SELECT {bare("suppkey")} AS `股票代码`, date_format(day, 'yyyy-MM-dd') AS `解禁时间`,
       concat('lot ', flag) AS `限售股类型`, string(qty * 1000) AS `解禁数量`,
       string(if(qty = 30, 0, done * 900)) AS `实际解禁数量`, string({yuan("value")}) AS `实际解禁市值`,
       string(cast(cast(qty AS decimal(10,4)) / 1000 AS decimal(10,6))) AS `占解禁前流通市值比例`,
       string({yuan("top")}) AS `解禁前一交易日收盘价`
FROM (
  SELECT suppkey, day, flag, sum(qty) AS qty, sum(if(status = 'F', qty, NULL)) AS done,
         sum(if(status = 'F', ep, NULL)) AS value, max(ep) AS top
  FROM trades GROUP BY suppkey, day, flag
)
"""

# Quarterly holder counts: the quantity traded.
_RAW_HOLDER_NUM = f"""
SELECT {bare("suppkey")} AS `股票代码`, date_format(d, 'yyyy-MM-dd') AS `股东户数统计截止日`,
       string(n) AS `股东户数-本次`, coalesce(string(prev), '--') AS `股东户数-上次`,
       string(n - prev) AS `股东户数-增减`,
       string({decimal4("double(n - prev) / double(prev) * 100")}) AS `股东户数-增减比例`,
       string({yuan("value")}) AS `户均持股市值`, '' AS `户均持股数量`, string(n * 100) AS `总股本`,
       date_format(date_add(d, 15), 'yyyyMMdd') AS `股东户数公告日期`
FROM (
  SELECT *, lag(n) OVER (PARTITION BY suppkey ORDER BY d) AS prev
  FROM (SELECT suppkey, {quarter_day("day")} AS d, sum(qty) AS n, sum(ep) AS value
        FROM trades GROUP BY suppkey, {quarter_day("day")})
)
"""

# Large trades as listings; reasons differ only past their 50th character.
_REASON = "concat('cumulative deviation over three consecutive days, class ', flag, ' band ', status)"

_RAW_TOP_LIST = f"""
SELECT {bare("suppkey")} AS `代码`, date_format(day, 'yyyy-MM-dd') AS `上榜日`,
       if(qty = 50, '  ', {_REASON}) AS `上榜原因`,
       string({yuan("gross", 12)}) AS `龙虎榜买入额`,
       string({yuan("net", 12)}) AS `龙虎榜卖出额`,
       string({yuan("gross - net", 12)}) AS `龙虎榜净买额`,
       struct(orderkey, linenumber, ep, gross, net, flag, status) AS _seq
FROM trades WHERE qty >= 30
"""

_SEATS = f"""
SELECT {symbol("suppkey")} AS stock_code, day AS trade_date,
       if(qty = 50, {text_literal(feeds.LISTED)}, {_REASON}) AS list_type,
       concat('seat ', string(partkey)) AS seat_name, flag AS seat_type,
       {yuan("gross")} AS buy_amount, {yuan("net")} AS sell_amount, {yuan("gross - net")} AS net_amount
FROM trades WHERE qty >= 30
"""

PARTS: dict[str, str] = {
    "trades": _TRADES,
    "bars": _BARS,
    "quarters": _QUARTERS,
    "positions": _POSITIONS,
    "levels": _LEVELS,
    "statements": _STATEMENTS,
    "capital": _CAPITAL,
    "dividends": _DIVIDENDS,
    "master": _MASTER,
    "industry": _INDUSTRY,
    "capital_flow": _CAPITAL_FLOW,
    "margin_legs": _MARGIN_LEGS,
    "northbound_rows": _NORTHBOUND_ROWS,
    "northbound_market": _NORTHBOUND_MARKET,
    "announcements": _ANNOUNCEMENTS,
    "update_log": _UPDATE_LOG,
    "raw_pledge": _RAW_PLEDGE,
    "raw_holder_change": _RAW_HOLDER_CHANGE,
    "raw_buyback": _RAW_BUYBACK,
    "raw_unlock": _RAW_UNLOCK,
    "raw_holder_num": _RAW_HOLDER_NUM,
    "raw_top_list": _RAW_TOP_LIST,
    "seats": _SEATS,
}


def query(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run SQL over the supplied tables (``<table>_rows``) and the views above."""
    scans = {f"{t}_rows": f"SELECT * FROM {_source(spark, sf_dir, t)}" for t in SOURCES}
    return spark.sql(compose(text, {**scans, **PARTS}))


def _source(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A view over one supplied table, made once per session: its files are listed and its schema is read once."""
    name = f"source_{table}_{zlib.crc32(sf_dir.encode()):08x}"
    if not spark.catalog.tableExists(name):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(name)
    return name


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return query(spark, sf_dir, f"SELECT * FROM {name}")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with derived columns and turnover, as stored."""
    bars = with_daily_basic(view(spark, sf_dir, "bars"))
    return fill_turnover(bars, view(spark, sf_dir, "capital"))


def pledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.pledge(view(spark, sf_dir, "raw_pledge"))


def holder_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed disclosures, one per key; of equal keys the greatest later fields count."""
    rows = feeds.holder_changes(view(spark, sf_dir, "raw_holder_change"))
    keys = TABLES["risk_holder_change"].keys
    return keep_last(rows, keys, "change_ratio", "hold_after_shares", "change_start_date")


def buyback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.buybacks(view(spark, sf_dir, "raw_buyback"))
    return keep_last(rows, TABLES["risk_buyback"].keys, "shares_lower")


def unlock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.unlocks(view(spark, sf_dir, "raw_unlock"), RISK_AS_OF)


def holder_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.holder_counts(view(spark, sf_dir, "raw_holder_num"))


def dragon_tiger(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = TABLES["dragon_tiger"].keys
    rows = keep_last(feeds.top_list(view(spark, sf_dir, "raw_top_list")), keys, "_seq")
    return surrogate_id(rows.drop("_seq"), "dragon_tiger")


def dragon_tiger_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listed trade as a seat of its own entry."""
    keys = ["stock_code", "trade_date", "list_type"]
    listed = dragon_tiger(spark, sf_dir).selectExpr("id AS dragon_tiger_id", *keys)
    return view(spark, sf_dir, "seats").join(listed, keys)


def intermediate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fundamentals(view(spark, sf_dir, "statements"), view(spark, sf_dir, "capital"))


def valuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valuation(
        view(spark, sf_dir, "bars"),
        intermediate(spark, sf_dir),
        view(spark, sf_dir, "capital"),
        view(spark, sf_dir, "dividends"),
        AS_OF,
    )


def _named(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: view(spark, sf_dir, name)


BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stock_daily": daily,
    "financial_statements": _named("statements"),
    "announcements": _named("announcements"),
    "update_log": _named("update_log"),
    "technical_indicators": lambda spark, sf_dir: technical(view(spark, sf_dir, "bars")),
    "valuation_indicators": valuations,
    "stock_capital": _named("capital"),
    "dividends": _named("dividends"),
    "financial_intermediate": intermediate,
    "northbound_flow": lambda spark, sf_dir: inflow_sums(view(spark, sf_dir, "northbound_rows")),
    "northbound_market_flow": _named("northbound_market"),
    "margin_trading": lambda spark, sf_dir: margin_changes(view(spark, sf_dir, "margin_legs")),
    "capital_flow": _named("capital_flow"),
    "risk_pledge": pledge,
    "risk_holder_change": holder_change,
    "risk_buyback": buyback,
    "risk_unlock": unlock,
    "risk_holder_num": holder_num,
    "dragon_tiger": dragon_tiger,
    "dragon_tiger_detail": dragon_tiger_detail,
    "stock_industry": _named("industry"),
    "stock_master": _named("master"),
}


class MarketTables(Mapping[str, DataFrame]):
    """The views by table name, each planned when first asked for and then reused."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._planned:
            self._planned[table] = BUILDERS[table](self.spark, self.sf_dir)
        return self._planned[table]

    def narrow(self, table: str, columns: Sequence[str]) -> DataFrame:
        """The named columns of a table, planned without what only other columns need."""
        if table == "technical_indicators":
            return technical(view(self.spark, self.sf_dir, "bars"), columns).select(*columns)
        return self[table].select(*columns)

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)
