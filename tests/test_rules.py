"""Quality rules, feeds, queries and work lists on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalar
from tickloom.operators import incremental as inc
from tickloom.operators import quality as Q
from tickloom.operators.filters import checked_limit, excluding, in_list, range_query, split_codes
from tickloom.plans import queries, risk
from tickloom.sources import feeds, raw_text
from tickloom.sources.market_views import MarketTables
from tickloom.sources.sqltext import compose

D = dt.date


def _one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").selectExpr(f"{expr} AS y").first().y


@pytest.mark.parametrize(
    "text,day",
    [
        ("2020-01-05", D(2020, 1, 5)), ("2020/1/5", D(2020, 1, 5)), (" 20200105 ", D(2020, 1, 5)),
        ("--", None), ("", None), ("nan", None), ("NaT", None), ("2020", None), ("2020-13-01", None),
        ("2020-01/05", None), ("2020-01", None), (None, None),
    ],
)
def test_parse_date(spark, text, day):
    assert _one(spark, scalar.parse_date("x"), text) == day


@pytest.mark.parametrize(
    "text,value",
    [("1.5", 1.5), (" -2 ", -2.0), ("--", None), ("", None), ("nan", None), ("1,5", None), (None, None), ("1e3", 1000.0)],
)
def test_parse_num(spark, text, value):
    assert _one(spark, scalar.parse_num("x"), text) == value


def test_codes(spark):
    assert _one(spark, scalar.to_symbol("x"), "600519") == "sh600519"
    assert _one(spark, scalar.to_symbol("x"), " 000858") == "sz000858"
    assert _one(spark, scalar.to_dotted("x"), "sh600519") == "sh.600519"
    assert _one(spark, scalar.from_dotted("x"), "sh.6005.19") == "sh6005.19"
    assert _one(spark, scalar.to_market_id("x"), "sz000858") == "0.000858"
    assert _one(spark, scalar.to_market_id("x"), "sh600519") == "1.600519"
    assert [_one(spark, scalar.is_fund("x"), c) for c in ("sh513700", "sz159915", "sh600519")] == [True, True, False]
    assert _one(spark, scalar.quarter_end("int(x)", "1"), "2020") == D(2020, 3, 31)
    assert _one(spark, scalar.num("x"), float("nan"), "double") is None
    assert _one(spark, scalar.ratio4("x", "0"), 1.0, "double") is None


def _flow_row(symbol, day, amounts, ratios):
    return (symbol, day, *map(float, amounts), *map(float, ratios))


FLOW = (
    "stock_code string, trade_date date, main_net_amount double, xlarge_net_amount double, large_net_amount double, "
    "medium_net_amount double, small_net_amount double, main_net_ratio double, xlarge_net_ratio double, large_net_ratio double"
)


def test_flow_checks_pass_and_fail(spark):
    good = _flow_row("a", D(2020, 1, 1), (30, 10, 20, -10, -20), (3, 1, 2))
    bad = _flow_row("a", D(2020, 1, 2), (99, 10, 20, 50, 50), (9, 1, 2))
    flow = spark.createDataFrame([good, bad], FLOW)
    out = {r["check"]: (r.violations, r.sample_size, r.passed) for r in Q.flow_identities(flow).collect()}
    assert out == {n: (1, 2, False) for n in ("main_amount", "main_ratio", "conservation", "conservation_on_load")}
    assert all(r.passed for r in Q.flow_identities(spark.createDataFrame([good], FLOW)).collect())
    bars = spark.createDataFrame([("a", D(2020, 1, 1), 1000.0), ("a", D(2020, 1, 2), 1000.0)], "stock_code string, trade_date date, amount double")
    assert [r.bad for r in Q.flow_against_bars(flow, bars).orderBy("trade_date").collect()] == [False, True]
    known = bars.where("trade_date = date'2020-01-02'")
    assert Q.flow_against_bars_report(flow, bars, known).first().passed
    assert Q.orphans(flow, known).count() == 1
    assert not Q.duplicate_report(flow.unionAll(flow), ["stock_code", "trade_date"], "key").first().passed
    assert excluding(flow, known, ["stock_code", "trade_date"]).count() == 1


def test_a_day_with_few_symbols_is_no_trading_day(spark):
    days = [D(2020, 1, 1) + dt.timedelta(i) for i in range(10)]
    rows = [(f"s{i}", d) for i in range(10) for j, d in enumerate(days) if not (i == 3 and j in (0, 4, 5, 9)) and not (j == 7 and i > 4)]
    rows.append(("odd", D(2021, 1, 1)))
    daily = spark.createDataFrame(rows, "stock_code string, trade_date date")
    assert Q.trading_calendar(daily).count() == 9
    gaps = {(r.stock_code, r.trade_date) for r in Q.calendar_gaps(daily).collect()}
    expected = {("s3", days[j]) for j in (0, 4, 5, 9)} | {("odd", d) for j, d in enumerate(days) if j != 7}
    assert gaps == expected
    plan = Q.calendar_gaps(daily)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan
    assert Q.calendar_gaps(daily, min_symbols=50).count() == 0


def test_price_jumps_and_long_gaps(spark):
    rows = [("a", D(2020, 1, 1), 100.0), ("a", D(2020, 1, 2), 131.0), ("a", D(2020, 1, 10), 131 * 1.29), ("a", D(2020, 1, 11), 0.0), ("a", D(2020, 1, 12), 5.0)]
    daily = spark.createDataFrame(rows, "stock_code string, trade_date date, close double")
    out = [r.accepted for r in Q.price_jumps(daily).orderBy("trade_date").collect()]
    assert out == [True, False, True, False, True]
    assert [r.gap_days for r in Q.long_gaps(daily).collect()] == [8]


def test_turnover_units(spark):
    day = D(2020, 1, 1)
    rows, ref = [], []
    for i in range(25):
        d = day + dt.timedelta(i)
        rows += [("pct", d, 2.0), ("frac", d, 0.02), ("none", d, None), ("odd", d, 9.0)]
        ref += [(s, d, 2.0) for s in ("pct", "frac", "none", "odd", "few")]
    rows += [("few", day + dt.timedelta(i), 2.0) for i in range(5)]
    schema = "stock_code string, trade_date date, turnover double"
    stored, reference = spark.createDataFrame(rows, schema), spark.createDataFrame(ref, schema)
    units = {r.stock_code: r.unit for r in Q.turnover_units(stored, reference).collect()}
    assert units == {"pct": "percent", "frac": "fraction", "none": "vacant", "odd": "unknown", "few": "unknown"}
    kinds = Q.reconcile_turnover(stored, reference).groupBy("stock_code", "kind").count().collect()
    assert {(r.stock_code, r.kind, r["count"]) for r in kinds} == {("pct", "same", 25), ("frac", "fix_unit", 25), ("none", "fill", 25)}


def test_flow_text(spark):
    good = "2020-01-02," + ",".join(str(i) for i in range(1, 13)) + ",x,y"
    lines = [good, "2020-01-03,1,2", good.replace("2020-01-02", "bad"), good.replace(",5,", ",-,")]
    payload = '{"data":{"klines":["' + '","'.join(lines) + '"]}}'
    raw = spark.createDataFrame([("a", payload), ("b", '{"data":null}'), ("c", "oops")], "stock_code string, payload string")
    parsed = raw_text.parse_flow(raw_text.flow_lines(raw)).collect()
    assert len(parsed) == 1 and parsed[0].xlarge_net_amount == 5.0 and parsed[0].change_pct == 12.0
    reasons = sorted(r.reason for r in raw_text.rejected_flow(raw_text.flow_lines(raw)).collect())
    assert reasons == ["too_few_fields", "unparsable", "unparsable"]


def test_quote_text(spark):
    fields = [str(i) for i in range(88)]
    full, no_ratio = "~".join(fields), list(fields)
    no_ratio[39], no_ratio[46] = "", "-"
    only_pb = list(fields)
    only_pb[39] = "n/a"
    rows = [("full", full), ("short", "~".join(fields[:49])), ("none", "~".join(no_ratio)), ("pb", "~".join(only_pb))]
    out = {r.stock_code: r for r in raw_text.parse_quotes(spark.createDataFrame(rows, "stock_code string, record string")).collect()}
    assert set(out) == {"full", "pb"}
    assert (out["full"].close, out["full"].pe_ttm, out["full"].total_mv) == (3.0, 39.0, 45.0)
    assert out["pb"].pe_ttm is None
    ok = Q.quote_identities(raw_text.parse_quotes(spark.createDataFrame(rows[:1], "stock_code string, record string"))).first()
    assert (ok.ok_pb_range, ok.ok_cap_order, ok.ok_change_pct, ok.ok_close_in_range) == (True, True, False, False)


@pytest.mark.parametrize("as_of,found", [("2020-05-16", D(2020, 5, 8)), ("2020-05-15", D(2020, 5, 8)), ("2020-06-05", D(2020, 5, 8)), ("2020-06-12", None)])
def test_newest_pledge_snapshot(spark, as_of, found):
    """Fridays only; on a Friday the search begins a week earlier and reaches four weeks back."""
    snaps = spark.createDataFrame([(D(2020, 5, 8), "1"), (D(2020, 5, 14), "2"), (D(2020, 5, 1), "3")], "snapshot_date date, x string")
    rows = feeds.newest_pledge_snapshot(snaps, as_of).collect()
    assert ([r.snapshot_date for r in rows] or [None])[0] == found


def test_reload_window(spark):
    calendar = spark.createDataFrame([(D(2020, 1, 1) + dt.timedelta(i),) for i in range(100)], "trade_date date")
    log = spark.createDataFrame([("new", "margin", D(2020, 4, 8)), ("old", "margin", D(2019, 1, 1)), ("x", "daily", D(2020, 4, 8))], "stock_code string, data_type string, last_update_date date")
    symbols = spark.createDataFrame([("new",), ("old",), ("none",)], "stock_code string")
    out = {r.stock_code: r.begin_date for r in inc.margin_start(symbols, log, calendar, "2020-04-09", "2016-01-01").collect()}
    assert out == {"new": D(2020, 4, 5), "old": D(2020, 2, 9), "none": D(2020, 2, 9)}


def test_watermark_ahead_of_data(spark):
    log = spark.createDataFrame([(s, "margin", D(2020, 1, 5)) for s in "abc"], "stock_code string, data_type string, last_update_date date")
    data = spark.createDataFrame([("a", D(2020, 1, 5)), ("b", D(2020, 1, 4))], "stock_code string, trade_date date")
    assert {r.stock_code for r in inc.watermark_ahead(log, data, "margin").collect()} == {"b", "c"}


def test_filters(spark):
    assert split_codes(" a, ,b,") == ["a", "b"] and split_codes(None) == []
    for limit in (0, -1):
        with pytest.raises(ValueError):
            checked_limit(limit)
    rows = spark.createDataFrame([("a", D(2020, 1, i)) for i in range(1, 6)], "stock_code string, trade_date date")
    out = range_query(rows, "a", start="2020-01-02", end="2020-01-04", limit=2).collect()
    assert [r.trade_date.day for r in out] == [4, 3]
    assert range_query(rows, "a", extra=[F.col("trade_date") != D(2020, 1, 1)]).count() == 4
    assert in_list(rows, "stock_code", ["b"]).count() == 0
    assert in_list(rows, "stock_code", rows.limit(1)).count() == 5


def test_unknown_symbol_and_notes(spark, sf_dir):
    tables = MarketTables(spark, sf_dir)
    assert queries.stock_detail(tables, "sh999999").count() == 0
    empty = queries.capital_flow(tables, "sh999999")
    assert queries.empty_note(empty, "sh999999", queries.NO_FLOW).first().note == queries.NO_FLOW
    some = queries.northbound(tables, "sh600000")
    assert queries.empty_note(some, "sh600000", queries.NO_NORTHBOUND).first().note is None
    with pytest.raises(ValueError):
        queries.daily(tables, "sh600000", limit=0)
    one = queries.basic_info(tables, "sh600000, sz000003,").collect()
    assert [r.stock_code for r in one] == ["sh600000", "sz000003"]


def test_filters_reach_the_scan(spark, tmp_path):
    from tickloom.sources import tables as T

    rows = spark.createDataFrame([("a", D(2020, 1, 1), 1.0)], "stock_code string, trade_date date, net_inflow double")
    T.append(rows, str(tmp_path), "northbound_flow")
    plan = queries.northbound(T.Store(spark, str(tmp_path)), "a", "2020-01-01", "2020-01-31")
    explain = spark.sparkContext._jvm.PythonSQLUtils.explainString
    text = explain(plan._jdf.queryExecution(), "formatted")
    assert "EqualTo(stock_code,a)" in text and "GreaterThanOrEqual(trade_date" in text
    assert "TakeOrderedAndProject" not in text  # all rows, unless a limit is asked for
    assert "month=2020-01" in str(plan.inputFiles())
    top = queries.northbound(T.Store(spark, str(tmp_path)), "a", limit=5)
    assert "TakeOrderedAndProject" in explain(top._jdf.queryExecution(), "formatted")


RISK = {
    "risk_pledge": ("stock_code string, trade_date date, pledge_ratio double", [("low", D(2020, 1, 3), 5.0), ("mid", D(2020, 1, 3), 20.0), ("high", D(2020, 1, 3), 20.01), ("high", D(2019, 1, 3), 1.0)]),
    "risk_holder_change": ("stock_code string, announcement_date date, change_type string", [("low", D(2019, 12, 2), "减持"), ("low", D(2019, 12, 1), "减持"), ("low", D(2025, 1, 1), "减持"), ("low", D(2020, 1, 1), "增持")]),
    "risk_buyback": ("stock_code string, progress string, done_amount double", [("low", "实施中", None), ("low", "董事会预案", 5.0), ("low", "完成实施", 9.0)]),
    "risk_unlock": ("stock_code string, free_date date, actual_free_shares bigint, free_shares bigint", [("low", D(2020, 3, 1), 0, 7), ("low", D(2020, 5, 30), 3, 8), ("low", D(2020, 5, 31), 100, 100), ("low", D(2020, 2, 29), 100, 100)]),
    "risk_holder_num": ("stock_code string, stat_date date, holder_num bigint, change_ratio double", [("low", D(2019, m, 1), m, 0.1) for m in range(1, 7)]),
    "stock_master": ("stock_code string", [("low",), ("mid",), ("high",), ("none",)]),
}


def test_risk_summary_bounds(spark):
    tables = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in RISK.items()}
    out = {r.stock_code: r for r in risk.risk_summary(tables, "2020-03-01").collect()}
    assert [out[s].risk_level for s in ("low", "mid", "high", "none")] == [risk.LEVEL_LOW, risk.LEVEL_MIDDLE, risk.LEVEL_HIGH, risk.LEVEL_NONE]
    low = out["low"]
    assert low.reduce_count_recent_90d == 2 and (low.ongoing_buyback_count, low.ongoing_buyback_amount) == (2, 5.0)
    assert (low.unlock_upcoming_90d_count, low.unlock_upcoming_90d_shares) == (2, 10)
    assert [e.stat_date.month for e in low.holder_num_trend] == [6, 5, 4, 3] and low.holder_num_latest == 6
    assert out["none"].note == risk.NO_EVENTS and low.note is None
    assert set(risk.risk_events({**tables, "risk_holder_change": tables["risk_holder_change"].withColumn("holder_name", F.lit("h")), "risk_buyback": tables["risk_buyback"].withColumn("announcement_date", F.lit(None))}, "low")) == set(risk.EVENT_TABLES)


def test_value_rules_catch_bad_rows(spark):
    tables = {
        "risk_pledge": spark.createDataFrame([(101.0,), (50.0,)], "pledge_ratio double"),
        "risk_holder_change": spark.createDataFrame([(0,)], "change_shares bigint"),
        "risk_buyback": spark.createDataFrame([(1.0, 1, 5.0, 4.0)], "done_amount double, done_shares bigint, amount_lower double, amount_upper double"),
        "risk_unlock": spark.createDataFrame([(1, 0.0)], "free_shares bigint, ratio_to_float double"),
        "risk_holder_num": spark.createDataFrame([(0,)], "holder_num bigint"),
    }
    assert [r.violations for r in Q.risk_rules(tables).collect()] == [1] * 5


def test_compose_orders_parts():
    parts = {"a": "SELECT 1 AS x", "b": "SELECT * FROM a", "c": "SELECT * FROM b"}
    text = compose("SELECT * FROM c", parts)
    assert text.index("a AS") < text.index("b AS") < text.index("c AS")
    assert compose("SELECT 1", parts) == "SELECT 1"


def test_hot_symbol(spark):
    """One symbol holds a third of all trades: bars stay bounded by days, gaps and totals are whole."""
    ticks = spark.range(30000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('s', id % 50)) AS stock_code", "date_add(date'2020-01-01', cast(id % 40 AS int)) AS trade_date", "id")
    bars = ticks.groupBy("stock_code", "trade_date").agg(F.max_by("id", "id").cast("double").alias("close"), F.count("*").alias("n"))
    assert bars.groupBy("stock_code").count().agg(F.max("count")).first()[0] <= 40
    assert bars.agg(F.sum("n")).first()[0] == 30000
    assert Q.price_jumps(bars).count() == bars.count()
    symbols = bars.select("stock_code").distinct().count()
    assert Q.calendar_gaps(bars).count() == symbols * Q.trading_calendar(bars).count() - bars.join(Q.trading_calendar(bars), "trade_date", "left_semi").count()


def test_latest_of_two_report_types_on_one_date(spark):
    from tickloom.operators.latest import latest_value

    rows = [("a", D(2020, 1, 1), "x", 1), ("a", D(2020, 1, 1), "y", 2), ("a", D(2019, 1, 1), "z", 3)]
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, "stock_code string, d date, kind string, v int")
        row = latest_value(df, "stock_code", "d", "d", "v", ties=["kind"]).first()
        assert (row.d, row.v) == (D(2020, 1, 1), 2)
