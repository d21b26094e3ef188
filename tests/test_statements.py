"""Fundamentals and valuation on hand-made statements."""

import datetime as dt
from decimal import Decimal

import pytest

from tickloom.operators.fundamentals import cumulative_to_quarterly, fundamentals
from tickloom.operators.valuation import valuation, valuation_per_share
from tickloom.schema import TABLES

SPEC = TABLES["financial_statements"]
ENDS = {1: (3, 31), 2: (6, 30), 3: (9, 30), 4: (12, 31)}


def _row(symbol, year, quarter, **values):
    base = {c: None for c in SPEC.columns}
    base.update(
        stock_code=symbol,
        report_date=dt.date(year, *ENDS[quarter]),
        report_type="consolidated",
        announcement_date=dt.date(year, *ENDS[quarter]) + dt.timedelta(days=30),
    )
    base.update({k: Decimal(str(v)) if isinstance(v, (int, float)) else v for k, v in values.items()})
    return tuple(base[c] for c in SPEC.columns)


def _history(symbol, quarters, skip=()):
    rows = []
    for i in range(quarters):
        year, quarter = 2018 + i // 4, i % 4 + 1
        if i in skip:
            continue
        per = 100 + 10 * i
        ytd = sum(100 + 10 * j for j in range(i - quarter + 1, i + 1))
        rows.append(
            _row(
                symbol, year, quarter, net_profit=ytd, total_revenue=ytd * 4, operating_cost=ytd * 2,
                total_assets=5000 + per, total_liabilities=2000, equity_parent=3000 + per,
                inventory=400 + i, accounts_receivable=300 + i, accounts_payable=200 + i, eps=ytd / 100,
                operating_cash_flow=ytd, capex=ytd / 2, interest_expense=ytd / 10,
                net_profit_deducted=ytd - 1, current_assets=900, current_liabilities=300,
            )
        )
    return rows


def _statements(spark, rows):
    return spark.createDataFrame(rows, SPEC.struct)


def _capital(spark, symbol="s", shares=1000):
    return spark.createDataFrame(
        [(symbol, dt.date(2018, 1, 1), Decimal(1)), (symbol, dt.date(2022, 1, 1), Decimal(shares))],
        TABLES["stock_capital"].struct,
    )


def _run(spark, rows, method="positional"):
    out = fundamentals(_statements(spark, rows), _capital(spark), method)
    return {(r.report_date, r.report_type): r for r in out.collect()}


def _at(out, year, quarter, kind="consolidated"):
    return out[(dt.date(year, *ENDS[quarter]), kind)]


def test_full_history(spark):
    out = _run(spark, _history("s", 14))
    assert _at(out, 2018, 2).net_profit_q == 110
    assert _at(out, 2018, 4).net_profit_ttm is None  # needs a fifth row
    assert _at(out, 2019, 1).net_profit_ttm == 110 + 120 + 130 + 140
    fy = _at(out, 2021, 2)
    assert fy.net_profit_cagr_3y is None
    fy19 = _at(out, 2019, 4)
    assert fy19.roe_annual == pytest.approx(round(620 / ((3170 + 3130) / 2) * 100, 4))
    assert fy19.revenue_yoy_annual == pytest.approx(round((2480 - 1840) / 1840 * 100, 4))
    assert fy19.dupont_equity_multiplier_annual == pytest.approx(round(5170 / 3170, 4))
    assert fy19.inventory_days_annual == pytest.approx(round(365 / fy19.inventory_turnover_annual, 4))
    assert fy19.bvps == pytest.approx(3.17)
    assert fy19.current_ratio == 3.0
    assert _at(out, 2020, 1).net_profit_yoy_ttm is not None
    assert _at(out, 2019, 4).net_profit_yoy_ttm is None


def test_methods_differ_when_a_quarter_is_missing(spark):
    rows = _history("s", 14, skip={6})  # 2019 Q3
    positional, calendar = _run(spark, rows), _run(spark, rows, "calendar")
    assert _at(positional, 2019, 4).net_profit_q == 160 + 170  # against Q2, the row before
    assert _at(calendar, 2019, 4).net_profit_q is None
    assert _at(calendar, 2020, 3).revenue_yoy_qoq is None
    assert _at(positional, 2020, 3).revenue_yoy_qoq is not None
    assert _at(calendar, 2018, 4).net_profit_ttm == 460  # four rows are enough
    # The nearest earlier third quarter stands in for the missing one.
    assert float(_at(calendar, 2020, 3).avg_inventory_ttm) == (410 + 402) / 2


def test_two_report_types_on_one_date(spark):
    rows = _history("s", 6) + [_row("s", 2018, 4, report_type="parent", net_profit=1, total_revenue=2)]
    first, second = _run(spark, rows), _run(spark, rows[::-1])
    assert {k: v.net_profit_q for k, v in first.items()} == {k: v.net_profit_q for k, v in second.items()}


def test_losses_and_zero_divisors_give_null(spark):
    rows = [
        _row("s", 2018, 4, net_profit=-5, total_revenue=0, total_assets=10, total_liabilities=20,
             equity_parent=-3, current_assets=1, current_liabilities=0),
    ]
    row = next(iter(_run(spark, rows).values()))
    assert row.net_margin_parent_annual is None and row.bvps is None and row.current_ratio is None
    assert row.equity == -10


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        fundamentals(_statements(spark, []), _capital(spark), "nearest")


def test_cumulative_to_quarterly_without_an_earlier_report(spark):
    rows = [("s", dt.date(2020, 6, 30), 5.0), ("s", dt.date(2020, 9, 30), 9.0), ("s", dt.date(2021, 3, 31), 2.0)]
    df = spark.createDataFrame(rows, "stock_code string, report_date date, eps double")
    out = [r.eps_q for r in cumulative_to_quarterly(df, "eps").orderBy("report_date").collect()]
    assert out == [5.0, 4.0, 2.0]


# --- valuation ---------------------------------------------------------------------------------

FIGURES = TABLES["financial_intermediate"]


def _figures(spark, rows):
    full = []
    for values in rows:
        base = {c: None for c in FIGURES.columns}
        base.update(stock_code="s", report_type="consolidated", **values)
        full.append(tuple(base[c] for c in FIGURES.columns))
    return spark.createDataFrame(full, FIGURES.struct)


def _valued(spark, days, figures, dividends=(), **options):
    daily = spark.createDataFrame([("s", d, 10.0) for d in days], "stock_code string, trade_date date, close double")
    paid = spark.createDataFrame(
        [("s", d, Decimal(str(x)), None) for d, x in dividends], TABLES["dividends"].struct
    )
    out = valuation(daily, _figures(spark, figures), _capital(spark), paid, "2021-12-31", **options)
    return {r.trade_date: r for r in out.collect()}


D = dt.date
Q2 = dict(report_date=D(2020, 6, 30), announcement_date=D(2020, 8, 1), equity_parent=Decimal(1000), net_profit_ttm=Decimal(-50))
Q3 = dict(report_date=D(2020, 9, 30), announcement_date=D(2020, 10, 20), equity_parent=Decimal(2000))
LATE_Q1 = dict(report_date=D(2020, 3, 31), announcement_date=D(2020, 12, 1), equity_parent=Decimal(500))
UNANNOUNCED = dict(report_date=D(2021, 3, 31), announcement_date=None, equity_parent=Decimal(4000))
ANNUAL = dict(report_date=D(2020, 12, 31), announcement_date=D(2021, 4, 1), equity_parent=Decimal(2500), net_profit=Decimal(100))


def test_newest_known_period_wins(spark):
    days = [D(2020, 7, 31), D(2020, 8, 1), D(2020, 10, 19), D(2020, 10, 20), D(2020, 12, 2)]
    out = _valued(spark, days, [Q2, Q3, LATE_Q1, UNANNOUNCED])
    assert D(2020, 7, 31) not in out  # nothing announced yet
    assert out[D(2020, 8, 1)].used_report_date == D(2020, 6, 30)  # usable on the day itself
    assert out[D(2020, 10, 19)].pe_ttm == 10 * 1000 / -50  # losses are kept
    assert out[D(2020, 10, 20)].pb == 5.0
    assert out[D(2020, 12, 2)].used_report_date == D(2020, 9, 30)  # a late restatement does not win


def test_unannounced_statements(spark):
    out = _valued(spark, [D(2020, 1, 1)], [UNANNOUNCED], null_announcement="always")
    assert out[D(2020, 1, 1)].pb == 2.5
    assert _valued(spark, [D(2022, 1, 1)], [UNANNOUNCED]) == {}


def test_dividend_window(spark):
    paid = [(D(2020, 12, 31), 0.1), (D(2020, 12, 30), 5.0), (D(2022, 5, 1), 0.2)]
    out = _valued(spark, [D(2020, 9, 1)], [Q2], paid)
    assert out[D(2020, 9, 1)].dividend_yield == pytest.approx(3.0)
    assert _valued(spark, [D(2020, 9, 1)], [Q2])[D(2020, 9, 1)].dividend_yield is None


def test_look_ahead_and_point_in_time(spark):
    days = [D(2020, 9, 1), D(2021, 5, 1)]
    out = _valued(spark, days, [Q2, ANNUAL])
    assert out[days[0]].pe_annual == 100.0  # the newest annual statement serves all history
    pit = _valued(spark, days, [Q2, ANNUAL], [(D(2021, 4, 30), 0.5)], point_in_time=True)
    assert pit[days[0]].pe_annual is None and pit[days[0]].dividend_yield is None
    assert pit[days[0]].pb == 10 * 1 / 1000  # one share recorded by then
    assert pit[days[1]].dividend_yield == pytest.approx(5.0)


def test_per_share_form(spark):
    daily = spark.createDataFrame(
        [("s", D(2020, 7, 1), 10.0), ("s", D(2020, 9, 1), 10.0), ("s", D(2020, 9, 2), 0.0)],
        "stock_code string, trade_date date, close double",
    )
    figures = _figures(spark, [
        {**Q2, "bvps": Decimal("2"), "eps_ttm": Decimal("-1"), "eps": Decimal("0.5"), "roe_annual": Decimal("7"),
         "total_revenue_ttm": Decimal("4000"), "total_shares": Decimal(1000)},
        {**LATE_Q1, "announcement_date": None, "bvps": Decimal("4")},
    ])
    paid = spark.createDataFrame([], TABLES["dividends"].struct)
    out = {r.trade_date: r for r in valuation_per_share(daily, figures, paid, "2021-12-31").collect()}
    assert out[D(2020, 7, 1)].pb == 2.5  # unannounced: known from its period end
    row = out[D(2020, 9, 1)]
    assert (row.pe_ttm, row.pb, row.ps_ttm, row.pe_annual, row.roe) == (None, 5.0, 2.5, 20.0, Decimal("7"))
    assert D(2020, 9, 2) not in out


def test_ratios_on_a_tie_round_as_the_sql_does(spark):
    """0.29 of 20000 is 0.00145 %, whose double lies below the tie; 1.13 and 1.69 of it likewise."""
    import duckdb

    from tickloom.sources import feeds

    cents = range(1, 4000, 2)
    key = "concat('s', id) AS stock_code", "'20200331' AS `报告日`", "'t' AS `类型`"
    ids = spark.range(1, 4000, 2)
    income = ids.selectExpr(*key, "string(id / 100) AS `净利润`")
    balance = ids.selectExpr(*key, "'20001' AS `资产总计`", "'1' AS `负债合计`")
    rows = feeds.statements_sina(income, balance, ids.selectExpr(*key)).collect()
    got = {r.stock_code: r.roe for r in rows}
    sql = "SELECT 's' || n, round(CAST(n AS DOUBLE) / 100 / 20000 * 100, 4) FROM range(1, 4000, 2) t(n)"
    assert len(got) == len(cents) and got == dict(duckdb.execute(sql).fetchall())
