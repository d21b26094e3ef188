"""Fundamentals and valuation as DuckDB SQL, with plain self-joins for the calendar method."""

from __future__ import annotations

from checks.duck_views import PARTS, part

CUMULATIVE = (
    "net_profit", "total_revenue", "operating_cost", "net_profit_deducted",
    "operating_cash_flow", "capex", "interest_expense", "eps",
)
BALANCES = (
    "equity_parent", "total_assets", "inventory", "accounts_receivable", "accounts_payable",
)
P = "OVER (PARTITION BY stock_code ORDER BY report_date, report_type)"
P4 = P[:-1] + " ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
FY = "qt = 'FY'"


def f(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(a: str, b: str, guard: str) -> str:
    return f"CASE WHEN {b} {guard} 0 THEN {a} / {b} END"


def r4(x: str) -> str:
    return f"round({x}, 4)"


part("dated", """
SELECT s.*, c.total_shares, CASE quarter(report_date) WHEN 1 THEN 'Q1' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q3' ELSE 'FY' END AS qt,
       year(report_date) * 4 + quarter(report_date) AS period
FROM statements s LEFT JOIN shares c ON s.stock_code = c.stock_code
""")

part("pos_q", f"""
SELECT *, row_number() {P} AS place,
       {", ".join(f"CASE WHEN qt = 'Q1' THEN {c} ELSE {c} - lag({c}) {P} END AS {c}_q" for c in CUMULATIVE)}
FROM dated
""")
part("pos_ttm", f"""
SELECT *, {", ".join(f"CASE WHEN place >= 5 AND count({c}_q) {P4} = 4 THEN sum({c}_q) {P4} END AS {c}_ttm" for c in CUMULATIVE)}
FROM pos_q
""")
_AGO = ("total_revenue", "net_profit", "total_revenue_q", "net_profit_q", "total_revenue_ttm", "net_profit_ttm")
part("pos_all", f"""
SELECT *, {", ".join(f"lag({c}, 4) {P} AS {c}_y1" for c in (*_AGO, *BALANCES))},
       {", ".join(f"lag({c}, 12) {P} AS {c}_y3" for c in ("total_revenue", "net_profit", "net_profit_deducted"))},
       {", ".join(f"lag({c}, 4) {P} AS {c}_prev" for c in BALANCES)}
FROM pos_ttm
""")

part("cal_q", f"""
SELECT a.*, {", ".join(f"CASE WHEN a.qt = 'Q1' THEN a.{c} ELSE a.{c} - b.{c} END AS {c}_q" for c in CUMULATIVE)}
FROM dated a LEFT JOIN dated b ON a.stock_code = b.stock_code AND b.period = a.period - 1
""")
part("cal_ttm", f"""
SELECT *, {", ".join(f"CASE WHEN count({c}_q) {P4} = 4 THEN sum({c}_q) {P4} END AS {c}_ttm" for c in CUMULATIVE)}
FROM cal_q
""")
part("cal_all", f"""
SELECT a.*, {", ".join(f"b.{c} AS {c}_y1" for c in (*_AGO, *BALANCES))},
       {", ".join(f"t.{c} AS {c}_y3" for c in ("total_revenue", "net_profit", "net_profit_deducted"))},
       {", ".join(f"p.{c} AS {c}_prev" for c in BALANCES)}
FROM cal_ttm a
LEFT JOIN cal_ttm b ON a.stock_code = b.stock_code AND b.period = a.period - 4
LEFT JOIN cal_ttm t ON a.stock_code = t.stock_code AND t.period = a.period - 12
LEFT JOIN (SELECT x.stock_code, x.period, max(y.period) AS before FROM cal_ttm x JOIN cal_ttm y
           ON x.stock_code = y.stock_code AND x.qt = y.qt AND y.period <= x.period - 4
           GROUP BY x.stock_code, x.period) n ON a.stock_code = n.stock_code AND a.period = n.period
LEFT JOIN cal_ttm p ON a.stock_code = p.stock_code AND p.period = n.before
""")


def _ratios(source: str, calendar: bool) -> str:
    g = ">" if calendar else "<>"

    def ratio(a: str, b: str, times: str = "") -> str:
        return r4(div(f(a), f(b), g) + times)

    def fy(x: str) -> str:
        return f"CASE WHEN {FY} THEN {x} END"

    cols: dict[str, str] = {}
    for s, sfx, avg in (("annual", "", ""), ("ttm", "_ttm", "_ttm")):
        wrap = fy if s == "annual" else (lambda x: x)
        pairs = {
            "roe": (f"net_profit{sfx}", f"avg_equity_parent{avg}"),
            "roa": (f"net_profit{sfx}", f"avg_total_assets{avg}"),
            "gross_margin": (f"(total_revenue{sfx} - operating_cost{sfx})", f"total_revenue{sfx}"),
            "net_margin_parent": (f"net_profit{sfx}", f"total_revenue{sfx}"),
            "net_margin_deducted": (f"net_profit_deducted{sfx}", f"total_revenue{sfx}"),
        }
        for n, (a, b) in pairs.items():
            cols[f"{n}_{s}"] = wrap(r4(f"({div(f(a), f(b), g)}) * 100"))
        for item, flow in (
            ("inventory", "operating_cost"),
            ("accounts_receivable", "total_revenue"),
            ("accounts_payable", "operating_cost"),
        ):
            cols[f"{item}_turnover_{s}"] = wrap(ratio(f"{flow}{sfx}", f"avg_{item}{avg}"))
    growth = {"total_revenue": "revenue", "net_profit": "net_profit"}
    for c, n in growth.items():
        for k, name, wrap in (("", "annual", fy), ("_q", "qoq", str), ("_ttm", "ttm", str)):
            now, old = f(f"{c}{k}"), f(f"{c}{k}_y1")
            cols[f"{n}_yoy_{name}"] = wrap(
                r4(f"(CASE WHEN {old} <> 0 THEN ({now} - {old}) / {old} END) * 100")
            )
    for c, n in {**growth, "net_profit_deducted": "net_profit_deducted"}.items():
        grown = f"CASE WHEN {c} > 0 AND {c}_y3 > 0 THEN {f(c)} / {f(f'{c}_y3')} END"
        cols[f"{n}_cagr_3y"] = fy(r4(f"(power({grown}, 1e0 / 3e0) - 1) * 100"))
    cols["bvps"] = r4(div(f("own"), f("total_shares"), ">"))
    cols["revenue_per_share"] = r4(div(f("total_revenue"), f("total_shares"), ">"))
    ocf = f("operating_cash_flow_ttm")
    cols["cash_profit_coverage_ttm"] = r4(div(ocf, f("net_profit_ttm"), "<>"))
    cols["fcf_profit_coverage_ttm"] = r4(div(f("fcf_ttm"), f("net_profit_ttm"), "<>"))
    cols["cash_interest_coverage_ttm"] = r4(div(ocf, f("interest_expense_ttm"), "<>"))
    if calendar:
        cols["current_ratio"] = cols["quick_ratio"] = "CAST(NULL AS DOUBLE)"
        cols["dupont_net_margin_annual"] = r4(
            f"({div(f('net_profit'), f('total_revenue'), g)}) * 100"
        )
        cols["dupont_asset_turnover_annual"] = ratio("total_revenue", "avg_total_assets")
        cols["dupont_equity_multiplier_annual"] = ratio("avg_total_assets", "avg_equity_parent")
        cols["dupont_equity_multiplier_ttm"] = ratio(
            "avg_total_assets_ttm", "avg_equity_parent_ttm"
        )
    else:
        debts = f("current_liabilities")
        cols["current_ratio"] = r4(div(f("current_assets"), debts, "<>"))
        cols["quick_ratio"] = r4(
            div(f("(current_assets - coalesce(inventory, 0))"), debts, "<>")
        )
        cols["dupont_net_margin_annual"] = cols["net_margin_parent_annual"]
        cols["dupont_asset_turnover_annual"] = fy(ratio("total_revenue", "avg_total_assets"))
        cols["dupont_equity_multiplier_annual"] = fy(ratio("total_assets", "own"))
        cols["dupont_equity_multiplier_ttm"] = ratio("total_assets", "own")
    cols["dupont_net_margin_ttm"] = cols["net_margin_parent_ttm"]
    cols["dupont_asset_turnover_ttm"] = ratio("total_revenue_ttm", "avg_total_assets_ttm")
    days = [
        f"{r4(div('365', f'{i}_turnover_{s}', g))} AS {i}_days_{s}"
        for s in ("annual", "ttm")
        for i in ("inventory", "accounts_receivable", "accounts_payable")
    ]
    cash = "inventory_days_{0} + accounts_receivable_days_{0} - accounts_payable_days_{0}"
    cycle = [f"{r4(cash.format(s))} AS cash_cycle_{s}" for s in ("annual", "ttm")]
    averages = [
        *(f"{fy(f'({f(b)} + {f(f'{b}_y1')}) / 2')} AS avg_{b}" for b in BALANCES),
        *(f"({f(b)} + {f(f'{b}_prev')}) / 2 AS avg_{b}_ttm" for b in BALANCES),
    ]
    return f"""
SELECT *, {", ".join(cycle)} FROM (
SELECT *, {", ".join(days)} FROM (
SELECT *, {", ".join(f"{x} AS {n}" for n, x in cols.items())} FROM (
SELECT *, {", ".join(averages)}, total_assets - total_liabilities AS equity,
       operating_cash_flow_ttm - capex_ttm AS fcf_ttm,
       CASE WHEN equity_parent > 0 THEN equity_parent
            WHEN total_assets - total_liabilities > 0 THEN total_assets - total_liabilities END AS own
FROM {source})))
"""


part("intermediate", _ratios("pos_all", calendar=False))
part("intermediate_calendar", _ratios("cal_all", calendar=True))


# --- valuation -----------------------------------------------------------------------------------

part("annual_figures", """
SELECT stock_code, arg_max(net_profit, report_date) AS annual_profit, arg_max(total_revenue, report_date) AS annual_revenue
FROM intermediate WHERE month(report_date) = 12 AND day(report_date) = 31 GROUP BY stock_code
""")
part("cash_paid", """
SELECT stock_code, CAST(sum(cash_per_share) AS DOUBLE) AS cash FROM dividends
WHERE dividend_date >= DATE '2001-06-30' - 365 GROUP BY stock_code
""")


def asof(known: str, source: str = "intermediate") -> str:
    """Each bar with the newest period known on its day, by range join and rank."""
    return f"""
SELECT * FROM (
  SELECT b.stock_code, b.trade_date, CAST(b.close AS DOUBLE) AS close, i.* EXCLUDE (stock_code),
         row_number() OVER (PARTITION BY b.stock_code, b.trade_date ORDER BY i.report_date DESC NULLS LAST, i.report_type DESC) AS pick
  FROM bars b LEFT JOIN {source} i ON i.stock_code = b.stock_code AND {known} <= b.trade_date
) WHERE pick = 1
"""


part("asof_rows", asof("i.announcement_date"))
part("asof_always", asof("coalesce(i.announcement_date, DATE '0001-01-01')"))
part("asof_per_share", asof("greatest(coalesce(i.announcement_date, i.report_date), i.report_date)"))


def _multiples(rows: str, shares: str, profit: str, revenue: str, cash: str) -> str:
    cap = f"close * {f(shares)}"

    def m(x: str) -> str:
        return f"{cap} / nullif({f(x)}, 0)"

    return f"""
SELECT * FROM (
  SELECT r.stock_code, r.trade_date, {m("r.net_profit_ttm")} AS pe_ttm, {m("r.equity_parent")} AS pb,
         {m("r.total_revenue_ttm")} AS ps_ttm,
         CASE WHEN {cash} > 0 AND close > 0 THEN round({cash} / close * 100, 4) END AS dividend_yield,
         r.roe_ttm AS roe, {m(profit)} AS pe_annual, {m(revenue)} AS ps_annual, r.roe_ttm, r.roe_annual,
         r.report_date AS used_report_date, r.announcement_date AS used_announcement_date
  FROM {rows} WHERE r.report_date IS NOT NULL AND {shares} <> 0
) WHERE coalesce(pe_ttm, pb, ps_ttm) IS NOT NULL
"""


def _latest_joins(rows: str) -> str:
    return (
        f"{rows} r LEFT JOIN shares c ON r.stock_code = c.stock_code "
        "LEFT JOIN annual_figures a ON r.stock_code = a.stock_code "
        "LEFT JOIN cash_paid d ON r.stock_code = d.stock_code"
    )


_LATEST = ("c.total_shares", "a.annual_profit", "a.annual_revenue", "d.cash")
part("valuation", _multiples(_latest_joins("asof_rows"), *_LATEST))
part("valuation_always", _multiples(_latest_joins("asof_always"), *_LATEST))

part("annual_so_far", """
SELECT stock_code, report_date, annual.net_profit AS annual_profit, annual.total_revenue AS annual_revenue FROM (
  SELECT *, max(CASE WHEN month(report_date) = 12 THEN {'report_date': report_date, 'net_profit': net_profit, 'total_revenue': total_revenue} END)
         OVER (PARTITION BY stock_code ORDER BY report_date) AS annual FROM statements)
""")
part("pit_rows", """
SELECT r.*, p.annual_profit, p.annual_revenue, c.total_shares AS shares_then,
       (SELECT CAST(sum(d.cash_per_share) AS DOUBLE) FROM dividends d
        WHERE d.stock_code = r.stock_code AND d.dividend_date BETWEEN r.trade_date - 365 AND r.trade_date) AS cash_then
FROM asof_rows r LEFT JOIN annual_so_far p ON r.stock_code = p.stock_code AND r.report_date = p.report_date
ASOF LEFT JOIN capital c ON r.stock_code = c.stock_code AND r.trade_date >= c.record_date
""")
part("valuation_pit", _multiples(
    "pit_rows r", "r.shares_then", "r.annual_profit", "r.annual_revenue", "r.cash_then"))


def _per(base: str) -> str:
    return f"CASE WHEN {base} > 0 THEN round(close / {f(base)}, 4) END"


part("valuation_per_share", f"""
SELECT stock_code, trade_date, {_per("eps_ttm")} AS pe_ttm, {_per("bvps")} AS pb, {_per("sales_ttm")} AS ps_ttm,
       CASE WHEN cash > 0 THEN round(cash / close * 100, 4) END AS dividend_yield,
       coalesce(roe_ttm, roe_annual) AS roe, {_per("eps")} AS pe_annual, {_per("sales")} AS ps_annual,
       roe_ttm, roe_annual, report_date AS used_report_date, announcement_date AS used_announcement_date
FROM (SELECT r.*, d.cash, round({f("total_revenue_ttm")} / nullif(total_shares, 0), 4) AS sales_ttm,
             round({f("total_revenue")} / nullif(total_shares, 0), 4) AS sales
      FROM asof_per_share r LEFT JOIN cash_paid d ON r.stock_code = d.stock_code WHERE close <> 0)
""")

__all__ = ["PARTS"]
