"""The merge family over orders.

The stored table holds the orders that are done or in part done; the updates are the two most
urgent classes of all orders, with their price raised and their customer unknown at times. Both
overlap in part, so every merge meets matched keys, new keys and untouched rows.
"""

from __future__ import annotations

from checks.present import Check
from tickloom.operators import merge
from tickloom.operators.incremental import rolling_window
from tickloom.operators.latest import keep_last
from tickloom.sources import market_views as V

KEYS = ("o_orderkey",)

_TARGET = """
SELECT o_orderkey, if(o_orderpriority = '1-URGENT' AND o_orderstatus = 'F', NULL, o_custkey) AS o_custkey,
       o_orderstatus, cast(o_totalprice AS decimal(12,2)) AS o_totalprice, date(o_orderdate) AS o_orderdate
FROM orders_rows WHERE o_orderstatus != 'O'
"""
_UPDATES = """
SELECT o_orderkey, if(o_totalprice > 300000, NULL, o_custkey + 1) AS o_custkey,
       concat('u', o_orderstatus) AS o_orderstatus,
       if(o_totalprice < 100000, NULL, cast(o_totalprice AS decimal(12,2)) + 1) AS o_totalprice
FROM orders_rows WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
"""
_D_TARGET = """
SELECT o_orderkey, CASE WHEN NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') THEN o_custkey END AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders WHERE o_orderstatus <> 'O'
"""
_D_UPDATES = """
SELECT o_orderkey, CASE WHEN o_totalprice <= 300000 THEN o_custkey + 1 END AS o_custkey, 'u' || o_orderstatus AS o_orderstatus,
       CASE WHEN o_totalprice >= 100000 THEN CAST(o_totalprice AS DECIMAL(12,2)) + 1 END AS o_totalprice
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
"""


def target(spark, d):
    return V.query(spark, d, _TARGET)


def updates(spark, d):
    return V.query(spark, d, _UPDATES)


def _merged(fn):
    return lambda spark, d: fn(target(spark, d), updates(spark, d))



def _joined(how: str, cust: str, status: str, price: str) -> str:
    return f"""
    SELECT coalesce(t.o_orderkey, u.o_orderkey) AS o_orderkey, {cust} AS o_custkey, {status} AS o_orderstatus,
           {price} AS o_totalprice, t.o_orderdate
    FROM ({_D_TARGET}) t {how} JOIN ({_D_UPDATES}) u ON t.o_orderkey = u.o_orderkey"""


def _each(how: str, rule: str) -> str:
    return _joined(how, *(rule.format(c=c) for c in ("o_custkey", "o_orderstatus", "o_totalprice")))


_OVER = "CASE WHEN u.o_orderkey IS NOT NULL THEN u.{c} ELSE t.{c} END"
_KNOWN = "(u.o_custkey IS NOT NULL OR u.o_totalprice IS NOT NULL)"


def _feed_sources(spark, d):
    """Three statement feeds of falling quality, the best first."""
    st = V.view(spark, d, "statements")
    best = st.where("net_profit > 0").selectExpr(
        "stock_code", "report_date", "net_profit", "if(equity_parent > 0, equity_parent, NULL) AS equity_parent")
    middle = st.where("quarter(report_date) != 3").selectExpr(
        "stock_code", "report_date", "net_profit + 1 AS net_profit", "total_assets AS equity_parent", "capex")
    last = st.selectExpr("stock_code", "report_date", "net_profit + 2 AS net_profit", "total_revenue")
    return merge.merge_sources([best, middle, last], ("stock_code", "report_date"))


def _last_landed(spark, d):
    """Every line of an order lands as an update of that order; the last in line order counts."""
    rows = V.query(spark, d, """SELECT orderkey, linenumber, seq, partkey, ep / 100D AS ep FROM trades""")
    return keep_last(rows, ("orderkey",), "linenumber", "seq", "partkey")


def _master_upsert(spark, d):
    """Master rows updated without touching the day they were added."""
    stored = V.query(spark, d, "SELECT stock_code, stock_name, status, date'1999-01-01' AS added_date FROM master WHERE board != 'NATION_3'")
    fresh = V.query(spark, d, "SELECT stock_code, upper(stock_name) AS stock_name, '正常' AS status, date'2000-01-01' AS added_date FROM master WHERE is_etf = false")
    return merge.upsert(stored, fresh, ("stock_code",), ["stock_name", "status"])


def _guarded(spark, d):
    """Valuation updates of every calendar month end, kept only where a bar exists."""
    updates = V.query(spark, d, "SELECT stock_code, last_day(trade_date) AS trade_date, max(close) AS pb FROM bars GROUP BY stock_code, last_day(trade_date)")
    return merge.with_parent(updates, V.view(spark, d, "bars"), ("stock_code", "trade_date"))


def _rolling_upsert(spark, d):
    """The last 20 days of a list, merged again over what an earlier run stored."""
    rows = V.query(spark, d, "SELECT stock_code, trade_date, net_inflow FROM northbound_rows")
    stored = rows.where("trade_date < date'2001-10-25'").selectExpr("stock_code", "trade_date", "net_inflow - 1 AS net_inflow")
    return merge.upsert(stored, rolling_window(rows, "trade_date", "2001-11-04", 20), ("stock_code", "trade_date"))


_INTS, _FLOATS, _DATES = "o_orderkey o_custkey", "o_totalprice", "o_orderdate"


def _check(name, fn, sql):
    return Check(name, _merged(fn), sql, "o_orderstatus", _FLOATS, _DATES, _INTS)


CHECKS = [
    _check("merge_insert_if_absent", lambda t, u: merge.insert_if_absent(t, u, KEYS),
           _each("FULL", "CASE WHEN t.o_orderkey IS NOT NULL THEN t.{c} ELSE u.{c} END")),
    _check("merge_overwrite", lambda t, u: merge.upsert(t, u, KEYS), _each("FULL", _OVER)),
    _check("merge_overwrite_twice", lambda t, u: merge.upsert(merge.upsert(t, u, KEYS), u, KEYS), _each("FULL", _OVER)),
    _check("merge_columns", lambda t, u: merge.upsert(t, u, KEYS, ["o_totalprice"]),
           _joined("FULL", "CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_custkey ELSE u.o_custkey END",
                   "CASE WHEN t.o_orderkey IS NOT NULL THEN t.o_orderstatus ELSE u.o_orderstatus END",
                   _OVER.format(c="o_totalprice"))),
    _check("merge_protect", lambda t, u: merge.upsert(t, u, KEYS, rule=merge.protect), _each("FULL", "coalesce(u.{c}, t.{c})")),
    _check("merge_fill", lambda t, u: merge.update_from(t, u, KEYS, ["o_custkey", "o_totalprice"], merge.fill),
           _joined("LEFT", "coalesce(t.o_custkey, u.o_custkey)", "t.o_orderstatus", "coalesce(t.o_totalprice, u.o_totalprice)")),
    _check("merge_update_from", lambda t, u: merge.update_from(t, u, KEYS, ["o_custkey", "o_orderstatus", "o_totalprice"]),
           _each("LEFT", _OVER)),
    _check("merge_patch", lambda t, u: merge.update_from(t, u, KEYS, ["o_totalprice"], merge.protect),
           _joined("LEFT", "t.o_custkey", "t.o_orderstatus", "coalesce(u.o_totalprice, t.o_totalprice)")),
    _check("merge_patch_group", lambda t, u: merge.patch_group(t, u, KEYS, ["o_custkey", "o_totalprice"]),
           _joined("LEFT", f"CASE WHEN {_KNOWN} THEN u.o_custkey ELSE t.o_custkey END", "t.o_orderstatus",
                   f"CASE WHEN {_KNOWN} THEN u.o_totalprice ELSE t.o_totalprice END")),
    _check("merge_delete", lambda t, u: merge.delete_keys(t, u, KEYS),
           f"SELECT * FROM ({_D_TARGET}) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_D_UPDATES}))"),
    _check("merge_replace_by", lambda t, u: merge.replace_by(t, u, ["o_custkey"]), f"""
        SELECT * FROM ({_D_TARGET}) t WHERE NOT EXISTS (SELECT 1 FROM ({_D_UPDATES}) u WHERE u.o_custkey = t.o_custkey)
        UNION ALL SELECT *, NULL FROM ({_D_UPDATES})"""),
    Check("merge_sources", _feed_sources, """
        SELECT stock_code, report_date, CASE WHEN net_profit > 0 THEN net_profit WHEN quarter(report_date) <> 3 THEN net_profit + 1 ELSE net_profit + 2 END AS net_profit,
               CASE WHEN net_profit > 0 AND equity_parent > 0 THEN equity_parent WHEN quarter(report_date) <> 3 THEN total_assets END AS equity_parent,
               CASE WHEN quarter(report_date) <> 3 THEN capex END AS capex, total_revenue FROM statements""",
          "stock_code", "net_profit equity_parent capex total_revenue", "report_date"),
    Check("keep_last", _last_landed, """
        SELECT * FROM (SELECT orderkey, linenumber, partkey, ep,
            row_number() OVER (PARTITION BY orderkey ORDER BY linenumber DESC, ep DESC, partkey DESC) AS o FROM trades) WHERE o = 1""",
          "", "ep", "", "orderkey linenumber partkey"),
    Check("merge_master", _master_upsert, """
        SELECT coalesce(t.stock_code, u.stock_code) AS stock_code, coalesce(u.stock_name, t.stock_name) AS stock_name, '正常' AS status,
               coalesce(t.added_date, u.added_date) AS added_date
        FROM (SELECT stock_code, stock_name, DATE '1999-01-01' AS added_date FROM master WHERE board <> 'NATION_3') t
        FULL JOIN (SELECT stock_code, upper(stock_name) AS stock_name, DATE '2000-01-01' AS added_date FROM master WHERE NOT is_etf) u
          ON t.stock_code = u.stock_code""", "stock_code stock_name status", "", "added_date"),
    Check("merge_orphan_guard", _guarded, """
        SELECT m.* FROM (SELECT stock_code, last_day(trade_date) AS trade_date, max(close) AS pb FROM bars GROUP BY ALL) m
        JOIN bars b ON m.stock_code = b.stock_code AND m.trade_date = b.trade_date""", "stock_code", "pb", "trade_date"),
    Check("merge_rolling_window", _rolling_upsert, """
        SELECT stock_code, trade_date, CASE WHEN trade_date < DATE '2001-10-15' THEN net_inflow - 1 ELSE net_inflow END AS net_inflow
        FROM northbound_rows""", "stock_code", "net_inflow", "trade_date"),
]
