"""Single-quarter, trailing-twelve-month and ratio indicators of financial statements.

Statements are year-to-date. Two ways of finding the earlier period:

* ``positional``: so many rows back in the symbol's statement list (the default);
* ``calendar``: the row of that fiscal quarter, so a missing quarter gives NULL instead of a
  neighbour's figures.

Both are windows over one symbol's statements (a few per year), never self-joins. Amounts stay
decimal through differences and sums; ratios are doubles rounded to four digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tickloom.functions.scalar import ndiv, non_zero, num, positive, quarter_type, ratio4, rounded
from tickloom.functions.series import Series
from tickloom.operators.latest import latest_value
from tickloom.schema import BALANCES, CUMULATIVE, TABLES

Text = Callable[[str], str]

_OUTPUT = TABLES["financial_intermediate"].columns
_LIST = Series(order="report_date, report_type")

# Figures compared with the year before, and with three years before.
_FLOWS = ("total_revenue", "net_profit")
_YEAR_AGO = (*_FLOWS, *(f"{c}_{k}" for k in ("q", "ttm") for c in _FLOWS))
_THREE_AGO = ("total_revenue", "net_profit", "net_profit_deducted")

# The operating cycle: balance, and the flow that turns it over.
_CYCLE = (
    ("inventory", "operating_cost"),
    ("accounts_receivable", "total_revenue"),
    ("accounts_payable", "operating_cost"),
)

_MEASURES = {"total_revenue": "revenue", "net_profit": "net_profit"}


def with_shares(statements: DataFrame, capital: DataFrame) -> DataFrame:
    shares = latest_value(capital, "stock_code", "record_date", "total_shares")
    return statements.join(shares, "stock_code", "left")


def _annual(x: str) -> str:
    return f"if(quarter_type = 'FY', {x}, NULL)"


# --- positional -------------------------------------------------------------------------------


def _positional_periods(st: DataFrame) -> DataFrame:
    """Single quarters, TTM and the figures 4 and 12 rows back."""
    st = st.selectExpr(
        "*",
        f"{_LIST.over('row_number()')} AS position",
        *(f"if(quarter_type = 'Q1', {c}, {_LIST.diff(c)}) AS {c}_q" for c in CUMULATIVE),
    )
    st = st.selectExpr("*", *(f"{_ttm(c, 'position >= 5')} AS {c}_ttm" for c in CUMULATIVE))
    return st.selectExpr(
        "*",
        *(f"{_LIST.lag(c, 4)} AS {c}_y1" for c in (*_YEAR_AGO, *BALANCES)),
        *(f"{_LIST.lag(c, 12)} AS {c}_y3" for c in _THREE_AGO),
    ).selectExpr("*", *(f"{c}_y1 AS {c}_prev" for c in BALANCES))


def _ttm(c: str, also: str) -> str:
    """The last four single quarters, all of them known."""
    known = f"{_LIST.last_rows(f'count({c}_q)', 4)} = 4 AND {also}"
    return f"if({known}, {_LIST.sum(f'{c}_q', 4)}, NULL)"


# --- calendar ---------------------------------------------------------------------------------


def _newest_in(columns: tuple[str, ...], key: str, frame: str) -> str:
    """The named columns of the newest row among the periods of a RANGE frame, as one struct."""
    newest = f"max_by(struct({', '.join(columns)}), struct(report_date, report_type))"
    return Series(key, "period").over(newest, f"RANGE BETWEEN {frame}")


def _quarters_back(columns: tuple[str, ...], n: int) -> str:
    return _newest_in(columns, "stock_code", f"{n} PRECEDING AND {n} PRECEDING")


def _unpacked(struct: str, columns: tuple[str, ...], suffix: str) -> list[str]:
    return [f"{struct}.{c} AS {c}_{suffix}" for c in columns]


def _calendar_periods(st: DataFrame) -> DataFrame:
    """The same figures looked up by fiscal quarter."""
    st = st.selectExpr("*", "year(report_date) * 4 + quarter(report_date) AS period")
    st = st.selectExpr("*", f"{_quarters_back(CUMULATIVE, 1)} AS before")
    st = st.selectExpr(
        "*",
        *(f"if(quarter_type = 'Q1', {c}, {c} - before.{c}) AS {c}_q" for c in CUMULATIVE),
    )
    st = st.selectExpr("*", *(f"{_ttm(c, 'true')} AS {c}_ttm" for c in CUMULATIVE))
    year_ago = (*_YEAR_AGO, *BALANCES)
    earlier = "UNBOUNDED PRECEDING AND 4 PRECEDING"
    st = st.selectExpr(
        "*",
        f"{_quarters_back(year_ago, 4)} AS y1",
        f"{_quarters_back(_THREE_AGO, 12)} AS y3",
        f"{_newest_in(BALANCES, 'stock_code, quarter_type', earlier)} AS prev",
    )
    return st.selectExpr(
        "*",
        *_unpacked("y1", year_ago, "y1"),
        *_unpacked("y3", _THREE_AGO, "y3"),
        *_unpacked("prev", BALANCES, "prev"),
    )


# --- ratios -----------------------------------------------------------------------------------


def _mean(now: str, before: str) -> str:
    return f"({num(now)} + {num(before)}) / 2"


def _growth(now: str, before: str) -> str:
    return rounded(f"{ndiv(f'{num(now)} - {num(before)}', num(before))} * 100")


def _cagr(now: str, before: str) -> str:
    grown = ndiv(positive(num(now)), positive(num(before)))
    return rounded(f"(power({grown}, 1D / 3D) - 1) * 100")


def _profitability(suffix: str, of: Text, base: Text) -> list[str]:
    """Return and margin ratios; ``of`` picks annual or TTM figures, ``base`` guards divisors."""
    avg = "_ttm" if suffix == "ttm" else ""
    profit, revenue = of("net_profit"), of("total_revenue")
    pairs = {
        "roe": (profit, f"avg_equity_parent{avg}"),
        "roa": (profit, f"avg_total_assets{avg}"),
        "gross_margin": (f"{num(revenue)} - {num(of('operating_cost'))}", revenue),
        "net_margin_parent": (profit, revenue),
        "net_margin_deducted": (of("net_profit_deducted"), revenue),
    }
    return [f"{ratio4(a, base(b), 100)} AS {n}_{suffix}" for n, (a, b) in pairs.items()]


def _turnovers(suffix: str, of: Text, base: Text) -> list[str]:
    avg = "_ttm" if suffix == "ttm" else ""
    return [
        f"{ratio4(of(flow), base(f'avg_{item}{avg}'))} AS {item}_turnover_{suffix}"
        for item, flow in _CYCLE
    ]


def _days(suffix: str, base: Text) -> list[str]:
    """Days come from the rounded turnover."""
    return [
        f"{rounded(ndiv('365D', base(f'{item}_turnover_{suffix}')))} AS {item}_days_{suffix}"
        for item, _ in _CYCLE
    ]


def _dupont(calendar: bool, base: Text) -> list[str]:
    asset_turnover = ratio4("total_revenue", base("avg_total_assets"))
    if calendar:
        # Multipliers compare averages; the annual triple exists wherever its inputs do.
        annual = {
            "net_margin": ratio4("net_profit", base("total_revenue"), 100),
            "asset_turnover": asset_turnover,
            "equity_multiplier": ratio4("avg_total_assets", base("avg_equity_parent")),
        }
        multiplier = ratio4("avg_total_assets_ttm", base("avg_equity_parent_ttm"))
    else:
        multiplier = ratio4("total_assets", "own")
        annual = {
            "net_margin": "net_margin_parent_annual",
            "asset_turnover": _annual(asset_turnover),
            "equity_multiplier": _annual(multiplier),
        }
    ttm = {
        "net_margin": "net_margin_parent_ttm",
        "asset_turnover": ratio4("total_revenue_ttm", base("avg_total_assets_ttm")),
        "equity_multiplier": multiplier,
    }
    both = {"annual": annual, "ttm": ttm}
    return [f"{x} AS dupont_{n}_{s}" for s, parts in both.items() for n, x in parts.items()]


def fundamentals(
    statements: DataFrame, capital: DataFrame, method: str = "positional"
) -> DataFrame:
    """One row of indicators per statement row."""
    if method not in ("positional", "calendar"):
        raise ValueError(f"unknown method {method!r}")
    calendar = method == "calendar"
    # Calendar mode wants divisors above zero, positional mode any but zero.
    base = positive if calendar else non_zero

    def plain(c: str) -> str:
        return c

    def ttm(c: str) -> str:
        return f"{c}_ttm"

    st = with_shares(statements, capital)
    st = st.selectExpr("*", f"{quarter_type('report_date')} AS quarter_type")
    st = _calendar_periods(st) if calendar else _positional_periods(st)
    st = st.selectExpr(
        "*",
        *(f"{_annual(_mean(b, f'{b}_y1'))} AS avg_{b}" for b in BALANCES),
        *(f"{_mean(b, f'{b}_prev')} AS avg_{b}_ttm" for b in BALANCES),
        "total_assets - total_liabilities AS equity",
        "operating_cash_flow_ttm - capex_ttm AS fcf_ttm",
    )
    st = st.selectExpr(
        "*",
        f"coalesce({positive('equity_parent')}, {positive('equity')}) AS own",
        *_profitability("annual", _annual, base),
        *_profitability("ttm", ttm, base),
        *_turnovers("annual", plain if calendar else _annual, base),
        *_turnovers("ttm", ttm, base),
    )
    nothing = "double(NULL)"
    quick = "current_assets - coalesce(inventory, 0)"
    st = st.selectExpr(
        "*",
        f"{ratio4('own', positive('total_shares'))} AS bvps",
        f"{ratio4('total_revenue', positive('total_shares'))} AS revenue_per_share",
        *(f"{_annual(_growth(c, f'{c}_y1'))} AS {n}_yoy_annual" for c, n in _MEASURES.items()),
        *(f"{_growth(f'{c}_q', f'{c}_q_y1')} AS {n}_yoy_qoq" for c, n in _MEASURES.items()),
        *(f"{_growth(f'{c}_ttm', f'{c}_ttm_y1')} AS {n}_yoy_ttm" for c, n in _MEASURES.items()),
        *(
            f"{_annual(_cagr(c, f'{c}_y3'))} AS {_MEASURES.get(c, c)}_cagr_3y"
            for c in _THREE_AGO
        ),
        *_dupont(calendar, base),
        *_days("annual", base),
        *_days("ttm", base),
        f"{ratio4('operating_cash_flow_ttm', 'net_profit_ttm')} AS cash_profit_coverage_ttm",
        f"{ratio4('fcf_ttm', 'net_profit_ttm')} AS fcf_profit_coverage_ttm",
        f"{ratio4('operating_cash_flow_ttm', 'interest_expense_ttm')} "
        "AS cash_interest_coverage_ttm",
        # The calendar method has no liquidity ratios.
        f"{nothing if calendar else ratio4('current_assets', 'current_liabilities')} "
        "AS current_ratio",
        f"{nothing if calendar else ratio4(quick, 'current_liabilities')} AS quick_ratio",
    )
    cash = "inventory_days_{0} + accounts_receivable_days_{0} - accounts_payable_days_{0}"
    return st.selectExpr(
        "*", *(f"{rounded(f'({cash.format(s)})')} AS cash_cycle_{s}" for s in ("annual", "ttm"))
    ).select(*_OUTPUT)


def cumulative_to_quarterly(reports: DataFrame, *measures: str) -> DataFrame:
    """Year-to-date to single quarter; without an earlier report that year the value stays whole."""
    year = Series("stock_code, year(report_date)", "report_date")
    return reports.selectExpr(
        "*",
        *(
            f"if(month(report_date) = 3, {c}, coalesce({year.diff(c)}, {c})) AS {c}_q"
            for c in measures
        ),
    )
