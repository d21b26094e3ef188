"""Daily valuation of bars against the statements known on each day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.functions.scalar import ndiv, non_zero, num, positive, rounded
from tickloom.functions.series import Series
from tickloom.operators.asof import asof_newest
from tickloom.operators.latest import latest_value
from tickloom.schema import TABLES

#: Dividends count for this many days.
DIVIDEND_DAYS = 365
_OUTPUT = TABLES["valuation_indicators"].columns
_YEAR_END = "month(report_date) = 12 AND day(report_date) = 31"


def trailing_dividends(dividends: DataFrame, as_of: str) -> DataFrame:
    """Cash per share of the year before ``as_of``; later ex-dates count too."""
    recent = f"if(dividend_date >= date_sub(date'{as_of}', {DIVIDEND_DAYS}), cash_per_share, NULL)"
    total = dividends.selectExpr("stock_code", f"{recent} AS cash").groupBy("stock_code")
    return total.agg({"cash": "sum"}).selectExpr(
        "stock_code", "double(coalesce(`sum(cash)`, 0)) AS dividend_cash"
    )


def _with_annual(fundamentals: DataFrame, so_far: bool) -> DataFrame:
    """Statements with the figures of the symbol's newest 31 December statement.

    ``so_far`` looks only at the periods up to each statement.
    """
    listed = Series(order="report_date, report_type")
    newest = f"max(if({_YEAR_END}, struct(report_date, net_profit, total_revenue), NULL))"
    annual = listed.so_far(newest) if so_far else listed.whole(newest)
    return fundamentals.selectExpr("*", f"{annual} AS _annual").selectExpr(
        "*", "_annual.net_profit AS annual_profit", "_annual.total_revenue AS annual_revenue"
    )


def valuation(
    daily: DataFrame,
    fundamentals: DataFrame,
    capital: DataFrame,
    dividends: DataFrame,
    as_of: str,
    point_in_time: bool = False,
    null_announcement: str = "exclude",
) -> DataFrame:
    """Market-value ratios per bar.

    By default the latest share count, the newest annual statement and the dividends of the year
    before ``as_of`` apply to all of history. ``point_in_time`` uses what was known on each trade
    date instead. ``null_announcement='always'`` treats unannounced statements as always known.
    """
    payload = [
        "announcement_date", "net_profit_ttm", "total_revenue_ttm", "equity_parent",
        "roe_ttm", "roe_annual", "annual_profit", "annual_revenue",
    ]
    statements = _with_annual(fundamentals, so_far=point_in_time)
    known = "announcement_date"
    if null_announcement == "always":
        known = "coalesce(announcement_date, date'0001-01-01')"
    bars = daily.selectExpr("stock_code", "trade_date", f"{num('close')} AS close")
    rows = asof_newest(
        bars, statements, "stock_code", "trade_date", known, "report_date", payload, ["report_type"]
    )
    if point_in_time:
        rows = _capital_on_date(rows, capital)
        rows = _dividends_on_date(rows, dividends)
    else:
        shares = latest_value(capital, "stock_code", "record_date", "total_shares")
        cash = trailing_dividends(dividends, as_of)
        rows = rows.join(shares, "stock_code", "left").join(cash, "stock_code", "left")
    rows = rows.where("close IS NOT NULL AND total_shares != 0 AND report_date IS NOT NULL")
    rows = rows.selectExpr("*", f"close * {num('total_shares')} AS market_value")

    def multiple(base: str) -> str:
        return ndiv("market_value", non_zero(num(base)))

    cash_yield = ndiv(positive("dividend_cash"), positive("close"))
    return rows.selectExpr(
        "stock_code",
        "trade_date",
        f"{multiple('net_profit_ttm')} AS pe_ttm",
        f"{multiple('equity_parent')} AS pb",
        f"{multiple('total_revenue_ttm')} AS ps_ttm",
        f"{rounded(f'{cash_yield} * 100')} AS dividend_yield",
        "roe_ttm AS roe",
        f"{multiple('annual_profit')} AS pe_annual",
        f"{multiple('annual_revenue')} AS ps_annual",
        "roe_ttm",
        "roe_annual",
        "report_date AS used_report_date",
        "announcement_date AS used_announcement_date",
    ).where("coalesce(pe_ttm, pb, ps_ttm) IS NOT NULL")


def _capital_on_date(rows: DataFrame, capital: DataFrame) -> DataFrame:
    """Share count recorded by each trade date."""
    dated = capital.selectExpr("stock_code", "record_date AS shares_date", "total_shares")
    return asof_newest(
        rows, dated, "stock_code", "trade_date", "shares_date", "shares_date", ["total_shares"]
    ).drop("shares_date")


def _dividends_on_date(rows: DataFrame, dividends: DataFrame) -> DataFrame:
    """Cash paid in the 365 days up to each trade date, by a range window over one time line."""
    own = [c for c in rows.columns if c not in ("stock_code", "trade_date")]
    paid = dividends.selectExpr(
        "stock_code", "dividend_date AS trade_date", "cash_per_share AS paid"
    )
    asked = rows.selectExpr("stock_code", "trade_date", f"struct({', '.join(own)}) AS _row")
    line = paid.unionByName(asked, allowMissingColumns=True)
    year = Series(order="unix_date(trade_date)").over(
        "sum(paid)", "RANGE BETWEEN 365 PRECEDING AND CURRENT ROW"
    )
    found = line.selectExpr("*", f"double(coalesce({year}, 0)) AS dividend_cash")
    return found.where("_row IS NOT NULL").selectExpr(
        "stock_code", "trade_date", *(f"_row.{c} AS {c}" for c in own), "dividend_cash"
    )


def valuation_per_share(
    daily: DataFrame, fundamentals: DataFrame, dividends: DataFrame, as_of: str
) -> DataFrame:
    """The per-share form: ratios only of positive figures, all rounded, every priced bar kept.

    A statement counts from its announcement, never before its period end; without an announcement
    date it counts from the period end.
    """
    payload = [
        "announcement_date", "bvps", "eps", "eps_ttm", "total_revenue", "total_revenue_ttm",
        "total_shares", "roe_ttm", "roe_annual",
    ]
    bars = daily.selectExpr("stock_code", "trade_date", f"{num('close')} AS close")
    rows = asof_newest(
        bars.where("close != 0"), fundamentals, "stock_code", "trade_date",
        "greatest(announcement_date, report_date)", "report_date", payload, ["report_type"],
    )
    rows = rows.join(trailing_dividends(dividends, as_of), "stock_code", "left")

    def per_share(c: str) -> str:
        return rounded(ndiv(num(c), num(positive("total_shares"))))

    rows = rows.selectExpr(
        "*",
        f"{per_share('total_revenue_ttm')} AS sales_ttm",
        f"{per_share('total_revenue')} AS sales",
    )

    def multiple(base: str) -> str:
        return rounded(ndiv("close", positive(num(base))))

    return rows.selectExpr(
        "stock_code",
        "trade_date",
        f"{multiple('eps_ttm')} AS pe_ttm",
        f"{multiple('bvps')} AS pb",
        f"{multiple('sales_ttm')} AS ps_ttm",
        f"{rounded(f'{ndiv(positive('dividend_cash'), 'close')} * 100')} AS dividend_yield",
        "coalesce(roe_ttm, roe_annual) AS roe",
        f"{multiple('eps')} AS pe_annual",
        f"{multiple('sales')} AS ps_annual",
        "roe_ttm",
        "roe_annual",
        "report_date AS used_report_date",
        "announcement_date AS used_announcement_date",
    ).select(*_OUTPUT)
