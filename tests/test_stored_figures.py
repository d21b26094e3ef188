"""Stored sketches, row groups that are skipped, payloads that drift, lists that repeat themselves."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tickloom.operators import sketches as S
from tickloom.session import shared_folder
from tickloom.sources import raw_text
from tickloom.sources import tables as T
from tickloom.streaming.upserts import distinct_list_stream

D = dt.date


@pytest.fixture
def root(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _values(spark, n, symbols, seed=0):
    return spark.range(n).selectExpr(
        f"concat('s', pmod(hash(id, {seed}), {symbols})) AS stock_code", "date_add(date'2020-01-01', int(id % 400)) AS trade_date",
        f"if(id % 7 = 0, NULL, pow(rand({seed}), 3) * 100) AS pe_ttm",
    )


def test_sketches_keep_their_bounds(spark, root):
    rows = _values(spark, 300_000, 5000).persist()
    S.store_sketches(spark, rows, root, "v", "trade_date", ["pe_ttm"])
    out = S.stored_profile(spark, root, "v", ["pe_ttm"]).first()
    assert (out.rows, out.first_date, out.last_date) == (300_000, D(2020, 1, 1), D(2021, 2, 3))
    assert out.pe_ttm_known == rows.where("pe_ttm IS NOT NULL").count()
    assert abs(out.symbols - rows.select("stock_code").distinct().count()) <= S.SYMBOL_ERROR * 5000
    for point, value in zip((0.25, 0.5, 0.75), out.pe_ttm_quantiles, strict=True):
        assert abs(rows.where(F.col("pe_ttm") <= value).count() / out.pe_ttm_known - point) <= S.RANK_ERROR


def test_only_touched_months_are_sketched_again(spark, root):
    rows = _values(spark, 4000, 30).persist()
    S.store_sketches(spark, rows, root, "v", "trade_date", ["pe_ttm"])
    march = rows.where("date_format(trade_date, 'yyyy-MM') = '2020-03'").limit(5)
    S.store_sketches(spark, march, root, "v", "trade_date", ["pe_ttm"])
    kept = rows.where("date_format(trade_date, 'yyyy-MM') <> '2020-03'").count()
    assert S.stored_profile(spark, root, "v", ["pe_ttm"]).first().rows == kept + 5
    assert S.stored_profile(spark, root, "v", ["pe_ttm"], "2020-03", "2020-03").first().rows == 5
    none = S.merged(S.month_sketches(rows.withColumn("pe_ttm", F.lit(None).cast("double")), "trade_date", ["pe_ttm"]), ["pe_ttm"]).first()
    assert none.pe_ttm_quantiles is None and none.rows == 4000
    assert S.merged(S.month_sketches(rows.where("false"), "trade_date", ["pe_ttm"]), ["pe_ttm"]).first().rows is None


def _rows_read(df):
    """Rows that the scans of an executed frame gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_one_symbol_reads_few_row_groups(spark, root, monkeypatch):
    monkeypatch.setitem(T.SKIPPING, "parquet.block.size", str(256 << 10))
    rows = spark.range(200_000).selectExpr(
        "concat('sh', lpad(string(id % 4000 * 2), 6, '0')) AS stock_code", "date_add(date'2020-01-01', int(id div 4000) % 30) AS trade_date",
        "rand(1) * 1e6 AS net_inflow", "rand(2) * 1e6 AS holding_value",
    )
    T.export({"northbound_flow": rows.where("day(trade_date) < 31")}, root, ["northbound_flow"])
    stored = T.scan(spark, root, "northbound_flow")
    total = stored.count()
    there = stored.where("stock_code = 'sh004000'").select("net_inflow", "stock_code")
    assert 0 < _rows_read(there) < total / 4
    assert _rows_read(stored.where("stock_code = 'sh004001'").select("net_inflow", "stock_code")) == 0  # between its neighbours: the filter knows


FIELDS = list(raw_text.FLOW_FIELDS.values())


def test_payloads_of_two_shapes(spark):
    numbers = [float(i) for i in range(len(FIELDS))]
    named = ", ".join(f'"{n}": {v}' for n, v in zip(FIELDS, numbers, strict=True))
    line = ",".join(["2020-01-02", *map(str, numbers)])
    payloads = [
        ("a", f'{{"data": {{"klines": ["{line}", "2020-01-03,1"]}}}}'),
        ("b", f'{{"data": {{"klines": [{{"trade_date": "20200102", {named}, "rating": {{"now": "x"}}}}, 7]}}, "more": 1}}'),
        ("c", "<html>"), ("d", '{"data": null}'), ("e", None), ("f", '{"data": {"klines": []}}'), ("g", '{"data": {"klines": "no list"}}'),
    ]
    rows = raw_text.flow_variants(spark.createDataFrame(payloads, "stock_code string, payload string"))
    rows = rows.selectExpr("*", f"{raw_text.record_field('rating.now')} AS rating").collect()
    good = {r.stock_code: r for r in rows if r.reject_reason is None}
    assert set(good) == {"a", "b"} and [good["b"][n] for n in FIELDS] == [good["a"][n] for n in FIELDS] == numbers
    assert good["a"].trade_date == good["b"].trade_date == D(2020, 1, 2) and (good["a"].rating, good["b"].rating) == (None, "x")
    bad = sorted((r.stock_code, r.reject_reason, r.payload) for r in rows if r.reject_reason is not None)
    assert bad == [("a", "unreadable record", None), ("b", "unreadable record", None), ("c", "no JSON", "<html>"), ("d", "no records", payloads[3][1]),
                   ("e", "no JSON", None), ("f", "no records", payloads[5][1]), ("g", "no records", payloads[6][1])]


def _taken(df, call):
    """How often the plan evaluates a call, filters that have moved down included."""
    return df._jdf.queryExecution().optimizedPlan().toString().count(call)


def test_texts_of_a_record_are_taken_once(spark):
    """However many columns are read from them, and whatever is filtered by."""
    payloads = spark.range(1).selectExpr("string(id) AS stock_code", "concat('{', id) AS payload")
    rows = raw_text.flow_variants(payloads)
    for part in (rows, rows.where("reject_reason IS NOT NULL"), rows.where("reject_reason IS NULL")):
        assert _taken(part, "split(") <= 1 and _taken(part, "schema_of_variant") + _taken(part, "schemaOfVariant") <= 1
    lines = raw_text.flow_lines(payloads)
    assert _taken(raw_text.parse_flow(lines), "split(") <= 2 and _taken(raw_text.rejected_flow(lines), "split(") <= 2


def test_a_list_that_repeats_itself(spark, root, tmp_path):
    schema = "stock_code string, announcement_date date, title string, published timestamp"

    def row(day, title="t"):
        return ("a", D(2020, 1, 1) + dt.timedelta(days=day), title, dt.datetime(2020, 1, 1) + dt.timedelta(days=day))

    batches = [[row(0), row(0), row(40)], [row(40), row(41), row(90), (None, *row(90)[1:])], [row(41), row(2), row(2), row(0), row(80)], [row(2), row(91)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        distinct_list_stream(stream, root, "announcements", f"{tmp_path}/check", "published", "20 days")
    stored = [r.announcement_date.isoformat() for r in T.scan(spark, f"{root}/tables", "announcements").collect()]
    late = [r.announcement_date.isoformat() for r in spark.read.parquet(f"{root}/late/announcements").collect()]
    assert sorted(stored) == ["2020-01-01", "2020-02-10", "2020-02-11", "2020-03-21", "2020-03-31", "2020-04-01"]
    assert set(late) == {"2020-01-03"}
