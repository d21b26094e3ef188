"""The read queries.

Each takes ``tables`` (table name -> DataFrame) and returns a lazy DataFrame; lists that would
grow with the market come back as rows, never as one collected value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalar import text_literal
from tickloom.operators.filters import checked_limit, in_list, range_query, split_codes
from tickloom.operators.latest import latest_date, latest_value, narrow
from tickloom.schema import COVERAGE_TABLES, TABLES
from tickloom.sources.tables import Store, or_null

Tables = Mapping[str, DataFrame]

# Texts of the answers.
STATUS_DEFAULT = "正常"
CLOSE_MISSING = "close_price 为空,请确认该股票是否已采集最新日线数据"
NO_BARS = "无日线数据,close_price 为空"
NO_NORTHBOUND = "该股票可能非沪深港通标的,无北向资金数据"
NO_FLOW = "该股票无主力资金数据(可能采集尚未覆盖, 或为非股票标的)"
REASONS = {
    "close_zero": "该股票可能停牌/退市,无收盘价数据",
    "close_none": "无日线数据",
    "roe_ttm": "净资产为负或数据缺失,ROE不可计算",
    "gross_margin_ttm": "营业成本数据缺失,毛利率不可计算",
    "current_ratio": "流动资产/负债数据缺失",
    "quick_ratio": "流动资产/负债数据缺失",
    "northbound": "非沪深港通标的,数据源不提供",
}


# --- symbols and latest prices ----------------------------------------------------------------


def stocks(tables: Tables, codes: str | None = None) -> DataFrame:
    daily = in_list(tables["stock_daily"], "stock_code", split_codes(codes))
    return daily.select("stock_code").distinct().orderBy("stock_code")


# (answer column, stored column, type if the table lacks it)
_PRICE_COLUMNS = (
    ("open_price", "open", "decimal(10,2)"),
    ("close_price", "close", "decimal(10,2)"),
    ("high_price", "high", "decimal(10,2)"),
    ("low_price", "low", "decimal(10,2)"),
    ("volume", "volume", "bigint"),
    ("turnover_amount", "amount", "decimal(18,2)"),
    ("pct_chg", "change_pct", "decimal(10,4)"),
    ("turnover_rate", "turnover", "decimal(10,6)"),
    ("prev_close", "prev_close", "decimal(10,2)"),
    ("outstanding_share", "outstanding_share", "decimal(20,0)"),
)


def _latest_bars(daily: DataFrame) -> DataFrame:
    """The latest bar of each symbol: one hash aggregate, no sort of the history."""
    named = daily.selectExpr(
        "stock_code",
        "trade_date AS price_date",
        *(f"{or_null(daily, stored, kind)} AS {name}" for name, stored, kind in _PRICE_COLUMNS),
    )
    names = [name for name, _, _ in _PRICE_COLUMNS]
    return latest_value(named, "stock_code", "price_date", "price_date", *names)


def basic_info(tables: Tables, codes: str | None = None) -> DataFrame:
    """Latest bar per symbol with master data and that day's valuation.

    Columns or whole tables that are not there yet come back NULL or with their default.
    """
    rows = _latest_bars(in_list(tables["stock_daily"], "stock_code", split_codes(codes)))
    if "stock_master" in tables:
        rows = rows.join(tables["stock_master"], "stock_code", "left")
    ratios = ("pe_ttm", "pb", "ps_ttm", "dividend_yield")
    if "valuation_indicators" in tables:
        values = tables["valuation_indicators"]
        values = values.selectExpr(
            "stock_code",
            "trade_date AS price_date",
            *(f"{or_null(values, c, 'decimal(10,4)')} AS {c}" for c in ratios),
        )
        rows = rows.join(values, ["stock_code", "price_date"], "left")
    texts = {"stock_name": "", "stock_name_cn": "", "market": "", "board": ""}

    def text(column: str, default: str) -> str:
        return f"coalesce({or_null(rows, column, 'string')}, {text_literal(default)}) AS {column}"

    return rows.selectExpr(
        "stock_code",
        *(text(c, default) for c, default in texts.items()),
        f"{or_null(rows, 'listing_date', 'date')} AS listing_date",
        text("status", STATUS_DEFAULT),
        f"coalesce({or_null(rows, 'is_etf', 'boolean')}, false) AS is_etf",
        "price_date",
        *(name for name, _, _ in _PRICE_COLUMNS),
        *(f"{or_null(rows, c, 'decimal(10,4)')} AS {c}" for c in ratios),
        f"if(close_price IS NULL, {text_literal(CLOSE_MISSING)}, NULL) AS _warning",
    ).orderBy("stock_code")


def latest(tables: Tables, symbol: str | None = None) -> DataFrame:
    daily = range_query(tables["stock_daily"], symbol, order_by=())
    return latest_date(daily, "stock_code", "trade_date", "latest_date").orderBy("stock_code")


# --- coverage ---------------------------------------------------------------------------------


def coverage_latest(tables: Tables, names: Sequence[str] = COVERAGE_TABLES) -> DataFrame:
    """(table, symbol): rows and latest date."""
    out = None
    for table in names:
        if table not in tables:
            continue
        date_col = TABLES[table].date_col
        part = narrow(tables, table, "stock_code", date_col).groupBy("stock_code").agg(
            F.count("*").alias("rows"), F.max(date_col).alias("latest_date")
        )
        part = part.selectExpr(
            f"'{table}' AS table_name",
            f"'{date_col}' AS date_column",
            "stock_code",
            "rows",
            "latest_date",
        )
        out = part if out is None else out.unionByName(part)
    return out


def _due(tables: Tables, names: Sequence[str]) -> DataFrame:
    """(table, symbol) pairs that should have rows; funds are exempt where they must be."""
    wanted = ", ".join(
        f"struct('{t}' AS table_name, {str(TABLES[t].equity_only).lower()} AS equity)"
        for t in names
        if t in tables
    )
    due = tables["stock_master"].selectExpr(
        "stock_code", "coalesce(is_etf, false) AS is_etf", f"explode(array({wanted})) AS t"
    )
    return due.where("NOT (is_etf AND t.equity)").selectExpr("t.table_name", "stock_code")


def coverage_missing(tables: Tables, names: Sequence[str] = COVERAGE_TABLES) -> DataFrame:
    """(table, symbol) pairs of the master list without any row."""
    keys = ["table_name", "stock_code"]
    return _due(tables, names).join(coverage_latest(tables, names).select(*keys), keys, "left_anti")


def coverage(tables: Tables, names: Sequence[str] = COVERAGE_TABLES) -> DataFrame:
    """Per table: symbols, rows, latest date and how many listed symbols are missing.

    What there is and what is due are stacked and counted together, so each table is read once.
    """
    have = coverage_latest(tables, names).drop("date_column").withColumn("due", F.lit(False))
    both = have.unionByName(_due(tables, names).withColumn("due", F.lit(True)), True)
    per = both.groupBy("table_name", "stock_code").agg(
        F.max("rows").alias("rows"),
        F.max("latest_date").alias("latest_date"),
        F.bool_or("due").alias("due"),
    )
    totals = per.groupBy("table_name").agg(
        F.expr("count_if(rows IS NOT NULL) AS stocks"),
        F.expr("coalesce(sum(rows), 0) AS rows"),
        F.max("latest_date").alias("latest_date"),
        F.expr("count_if(due AND rows IS NULL) AS missing_stocks"),
    )
    dates = ", ".join(f"'{t}', '{TABLES[t].date_col}'" for t in names)
    absent = ", ".join(f"'{t}'" for t in names if t not in tables)
    if absent:  # a table that is not there has no counts, which is not the same as none
        gone = tables["stock_master"].limit(1).selectExpr("count(*) AS n")
        gone = gone.selectExpr(f"explode(array({absent})) AS table_name")
        totals = totals.unionByName(gone, allowMissingColumns=True)
    return totals.selectExpr(
        "table_name",
        f"element_at(map({dates}), table_name) AS date_column",
        "stocks",
        "rows",
        "latest_date",
        "missing_stocks",
    )


# --- series by symbol -------------------------------------------------------------------------


def _between(tables: Tables, table: str, start: str | None, end: str | None) -> DataFrame:
    """A stored table prunes its month folders; any other mapping just gives the table."""
    return tables.between(table, start, end) if isinstance(tables, Store) else tables[table]


def _series(
    tables: Tables, table: str, symbol: str | None, start: str | None, end: str | None, limit: int | None
) -> DataFrame:
    """Newest first, all rows unless the caller asks for the first ``limit``; of one day in key order."""
    day = TABLES[table].date_col
    order = [F.desc(day), *(F.asc(c) for c in TABLES[table].keys if c != day)]
    return range_query(
        _between(tables, table, start, end), symbol, day, start, end, order_by=order, limit=checked_limit(limit)
    )


def daily(tables: Tables, symbol: str | None, start=None, end=None, limit: int | None = None) -> DataFrame:
    return _series(tables, "stock_daily", symbol, start, end, limit)


def technical_indicators(
    tables: Tables, symbol: str | None, start=None, end=None, limit: int | None = None
) -> DataFrame:
    return _series(tables, "technical_indicators", symbol, start, end, limit)


def valuation_indicators(
    tables: Tables, symbol: str | None, start=None, end=None, limit: int | None = None
) -> DataFrame:
    """Valuation rows with the same day's close, which only the bars store."""
    rows = _series(tables, "valuation_indicators", symbol, start, end, limit)
    bars = range_query(tables["stock_daily"], symbol, start=start, end=end, order_by=())
    keys = ["stock_code", "trade_date"]
    return rows.join(bars.select(*keys, "close"), keys, "left").orderBy(F.desc("trade_date"))


def northbound_market(
    tables: Tables, start=None, end=None, limit: int | None = None
) -> DataFrame:
    return _series(tables, "northbound_market_flow", None, start, end, limit)


def northbound(
    tables: Tables, symbol: str | None, start=None, end=None, limit: int | None = None
) -> DataFrame:
    return _series(tables, "northbound_flow", symbol, start, end, limit)


def margin(tables: Tables, symbol: str | None, start=None, end=None, limit: int | None = None) -> DataFrame:
    return _series(tables, "margin_trading", symbol, start, end, limit)


def capital_flow(
    tables: Tables, symbol: str | None, start=None, end=None, limit: int | None = None
) -> DataFrame:
    return _series(tables, "capital_flow", symbol, start, end, limit)


def empty_note(answer: DataFrame, symbol: str, note: str) -> DataFrame:
    """One row (symbol, count, note); the note is set only when the answer is empty."""
    return answer.selectExpr("count(*) AS count").selectExpr(
        f"{text_literal(symbol)} AS stock_code",
        "count",
        f"if(count = 0, {text_literal(note)}, NULL) AS note",
    )


def dragon_tiger(
    tables: Tables, symbol: str | None, start=None, end=None, limit: int | None = None
) -> DataFrame:
    return _series(tables, "dragon_tiger", symbol, start, end, limit)


def dragon_tiger_seats(tables: Tables, symbol: str | None) -> DataFrame:
    """List entries with their seats."""
    keys = TABLES["dragon_tiger"].keys
    entries = range_query(tables["dragon_tiger"], symbol, order_by=())
    entries = entries.select(F.col("id").alias("dragon_tiger_id"), *keys)
    seats = tables["dragon_tiger_detail"].drop("dragon_tiger_id")
    return seats.join(entries, list(keys))


def announcements(tables: Tables, symbol: str | None, limit: int | None = None) -> DataFrame:
    return _series(tables, "announcements", symbol, None, None, limit)


def financial(
    tables: Tables, symbol: str | None, start=None, end=None, report_type: str | None = None
) -> DataFrame:
    extra = [F.col("report_type") == report_type] if report_type else []
    return range_query(
        tables["financial_statements"], symbol, "report_date", start, end, extra=extra
    )


def financial_indicators(tables: Tables, symbol: str | None, start=None, end=None) -> DataFrame:
    return range_query(tables["financial_intermediate"], symbol, "report_date", start, end)


def dividends(tables: Tables, symbol: str | None) -> DataFrame:
    return range_query(tables["dividends"], symbol, "dividend_date")


def capital(tables: Tables, symbol: str | None) -> DataFrame:
    return range_query(tables["stock_capital"], symbol, "record_date")


# --- industry and master ----------------------------------------------------------------------


def industry_list(tables: Tables) -> DataFrame:
    return (
        tables["stock_industry"]
        .where(F.col("industry_name").isNotNull())
        .groupBy("industry_name")
        .agg(F.count("*").alias("stock_count"), F.max("update_date").alias("latest_update"))
        .orderBy(F.desc("stock_count"), "industry_name")
    )


def industry_stocks(tables: Tables, industry: str) -> DataFrame:
    rows = tables["stock_industry"].where(F.col("industry_name") == industry)
    return rows.select("stock_code", "industry_name", "source", "update_date").orderBy("stock_code")


def industry(tables: Tables, symbol: str) -> DataFrame:
    return range_query(tables["stock_industry"], symbol, order_by=())


def master(tables: Tables) -> DataFrame:
    return tables["stock_master"].orderBy("stock_code")


# --- one row per symbol across tables -----------------------------------------------------------


def stock_detail(tables: Tables, symbol: str | None = None) -> DataFrame:
    """Master row with four statistics and the latest bar; no row for an unknown symbol."""

    def of(table: str) -> DataFrame:
        return range_query(tables[table], symbol, order_by=())

    bars = of("stock_daily").groupBy("stock_code").agg(
        F.max("trade_date").alias("latest_daily"), F.count("*").alias("daily_count")
    )
    reports = latest_date(
        of("financial_statements"), "stock_code", "report_date", "latest_financial"
    )
    notices = of("announcements").groupBy("stock_code").agg(
        F.count("*").alias("announcement_count")
    )
    prices = _latest_bars(of("stock_daily")).drop("outstanding_share")
    rows = of("stock_master")
    for part in (bars, reports, notices, prices):
        rows = rows.join(part, "stock_code", "left")
    counts = ("daily_count", "announcement_count")
    return rows.selectExpr(
        *(f"coalesce({c}, 0) AS {c}" if c in counts else c for c in rows.columns),
        f"if(price_date IS NULL, {text_literal(NO_BARS)}, NULL) AS _warning",
    )


_PRICE = ("trade_date", "open", "close", "high", "low", "volume", "turnover", "outstanding_share")
_VALUES = (
    "trade_date", "pe_ttm", "pb", "ps_ttm", "dividend_yield", "roe", "pe_annual", "ps_annual",
    "roe_ttm", "roe_annual",
)
_FIGURES = (
    "report_date", "eps", "roe_ttm", "gross_margin_ttm", "net_margin_parent_ttm", "current_ratio",
    "quick_ratio", "roa_ttm", "revenue_yoy_ttm", "net_profit_yoy_ttm",
)


def summary(tables: Tables, symbol: str | None = None) -> DataFrame:
    """Latest price, valuation and fundamentals per symbol, and why a field is unavailable.

    Column prefixes name the source: price_, valuation_, financial_. ``unavailable_fields`` is an
    array of (field, reason).
    """

    def part(table: str, order: str, columns: Sequence[str], prefix: str) -> DataFrame:
        rows = range_query(tables[table], symbol, order_by=())
        ties = [k for k in TABLES[table].keys if k not in ("stock_code", order)]
        newest = latest_value(rows, "stock_code", order, *columns, ties=ties)
        return newest.selectExpr("stock_code", *(f"{c} AS {prefix}_{c}" for c in columns))

    price = part("stock_daily", "trade_date", _PRICE, "price")
    values = part("valuation_indicators", "trade_date", _VALUES, "valuation")
    figures = part("financial_intermediate", "report_date", _FIGURES, "financial")
    figures = figures.withColumnRenamed(
        "financial_net_margin_parent_ttm", "financial_net_margin_ttm"
    )
    north = range_query(tables["northbound_flow"], symbol, order_by=())
    north = north.groupBy("stock_code").agg(F.count("*").alias("north_rows"))
    rows = range_query(tables["stock_master"], symbol, order_by=()).select("stock_code")
    for p in (price, values, figures, north):
        rows = rows.join(p, "stock_code", "left")

    def reason(condition: str, field: str, text: str) -> str:
        entry = f"struct('{field}' AS field, {text_literal(REASONS[text])} AS reason)"
        return f"if({condition}, {entry}, NULL)"

    has_bar, has_figures = "price_trade_date IS NOT NULL", "financial_report_date IS NOT NULL"
    reasons = [
        reason(f"{has_bar} AND coalesce(price_close, 0) = 0", "close", "close_zero"),
        reason(f"NOT {has_bar}", "close", "close_none"),
        *(
            reason(f"{has_figures} AND financial_{f} IS NULL", f, f)
            for f in ("roe_ttm", "gross_margin_ttm", "current_ratio", "quick_ratio")
        ),
        reason("north_rows IS NULL", "northbound", "northbound"),
    ]
    return rows.selectExpr(
        *(c for c in rows.columns if c != "north_rows"),
        "if(valuation_trade_date IS NOT NULL AND price_close != 0, price_close, NULL) "
        "AS valuation_stock_price",
        "coalesce(north_rows, 0) AS northbound_count",
        "north_rows IS NOT NULL AS northbound_available",
        f"array_compact(array({', '.join(reasons)})) AS unavailable_fields",
    )
