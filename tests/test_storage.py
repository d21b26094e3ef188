"""Schemas, storage, merges, streaming and the pipeline."""

import datetime as dt
import glob
import os
import time
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tickloom.operators import merge
from tickloom.operators.incremental import write_watermarks
from tickloom.operators.latest import keep_last
from tickloom.plans.pipeline import DERIVED, load_and_derive, recompute
from tickloom.schema import TABLES
from tickloom.session import shared_folder
from tickloom.sources import tables as T
from tickloom.sources.market_views import MarketTables, view
from tickloom.streaming.upserts import upsert_stream

D = dt.date


@pytest.fixture
def root(spark):
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _flow(spark, rows):
    return spark.createDataFrame(rows, "stock_code string, trade_date date, net_inflow double")


def test_declared_tables():
    assert len(TABLES) == 23
    assert len(TABLES["technical_indicators"].values) == 37
    assert TABLES["risk_holder_change"].by_month and not TABLES["stock_master"].by_month
    for spec in TABLES.values():
        assert len(set(spec.columns)) == len(spec.columns)
        assert set(spec.keys) <= set(spec.columns)


def test_column_dictionary(spark):
    rows = T.column_dictionary(spark)
    assert rows.count() == sum(len(s.fields) for s in TABLES.values())
    unit = rows.where("table_name = 'stock_daily' AND column_name = 'amount'").first().unit
    assert unit == "yuan"
    assert ("stock_daily", "open", "decimal(10,2)") in T.list_columns(
        T.conform(_flow(spark, []), "stock_daily"), "stock_daily"
    )


def test_conform_fills_and_rounds_and_refuses_what_does_not_fit(spark):
    schema = "stock_code string, trade_date date, open double, close double"
    df = spark.createDataFrame([("s", D(2020, 1, 1), None, 12.3456)], schema)
    row = T.conform(df, "stock_daily").first()
    assert row.open is None and float(row.close) == 12.35 and row.volume is None
    assert T.conform(df, "stock_daily").columns == TABLES["stock_daily"].columns
    bad = spark.createDataFrame([("s", D(2020, 1, 1), 1.005e9, 1.0), (None, D(2020, 1, 1), 1.0, 1.0), ("t", D(2020, 1, 1), 1.0, 1.0)], schema)
    with pytest.raises(Exception, match="does not fit"):
        T.conform(bad, "stock_daily").collect()
    assert {r.reject_reason for r in T.rejects(bad, "stock_daily").collect()} == {"overflow open", "no stock_code"}
    assert [r.stock_code for r in T.fitting(bad, "stock_daily").collect()] == ["t"]


def test_landing_counts_in_the_pass_that_writes(spark, root):
    schema = "stock_code string, trade_date date, open double, close double, note string"
    rows = [("s", D(2020, 1, 1), None, 12.3456, "n"), ("s", D(2020, 1, 2), 1.005e9, 1.0, "m"), (None, D(2020, 1, 1), 1.0, 1.0, None)]
    landing = T.land(spark.createDataFrame(rows, schema), "stock_daily", f"{root}/landing")
    assert (landing.rows, landing.rejected, landing.nulls["open"], landing.nulls["close"], landing.nulls["volume"]) == (3, 2, 1, 0, 1)
    assert landing.good.columns == TABLES["stock_daily"].columns and float(landing.good.first().close) == 12.35
    found = {(r.stock_code, r.note, r.reject_reason) for r in landing.rejects.collect()}
    assert found == {("s", "m", "overflow open"), (None, None, "no stock_code")}
    own = spark.createDataFrame([("s", D(2020, 1, 1), 1.0, "unreadable")], "stock_code string, trade_date date, open double, reject_reason string")
    assert [r.reject_reason for r in T.land(own, "stock_daily", f"{root}/own").rejects.collect()] == ["unreadable"]
    empty = T.land(own.where("false"), "stock_daily", f"{root}/empty")
    assert (empty.rows, empty.rejected, empty.good.count()) == (0, 0, 0)


def test_a_wide_merge_is_planned_quickly(spark, sf_dir, root, monkeypatch):
    """The optimizer must not reason about the rank of all columns behind every renaming of one."""
    rows = view(spark, sf_dir, "statements")
    landing = T.land(rows, "financial_statements", f"{root}/landing")
    planned = []

    def write(merged, *place):
        began = time.monotonic()
        merged._jdf.queryExecution().executedPlan().toString()
        planned.append(time.monotonic() - began)
        return real(merged, *place)

    real = T._write
    monkeypatch.setattr(T, "_write", write)
    for _ in range(2):
        T.merge_landed(spark, landing.good, f"{root}/t", "financial_statements", rows.columns)
    assert len(planned) == 2 and max(planned) < 5
    assert T.scan(spark, f"{root}/t", "financial_statements").count() == rows.count()


def test_surrogate_ids_are_stable(spark):
    rows = spark.createDataFrame([("s", D(2020, 1, 1), "t")], "stock_code string, announcement_date date, title string")
    ids = {T.surrogate_id(rows, "announcements").first().id for _ in range(2)}
    assert len(ids) == 1


def test_old_files_are_read_with_null_columns(spark, root):
    df = spark.createDataFrame([("s", D(2020, 1, 31))], "stock_code string, record_date date")
    df.withColumn("month", F.lit("2020-01")).write.partitionBy("month").parquet(f"{root}/stock_capital")
    row = T.scan(spark, root, "stock_capital").first()
    assert (row.stock_code, row.total_shares) == ("s", None)


def _stored(spark, root):
    rows = T.scan(spark, root, "northbound_flow").collect()
    out = {(r.stock_code, r.trade_date): float(r.net_inflow) for r in rows}
    assert len(out) == len(rows)
    return out


def test_month_merge_is_idempotent_and_leaves_other_months(spark, root):
    first = _flow(spark, [("a", D(2020, 1, 5), 1.0), ("a", D(2020, 2, 5), 2.0), ("b", D(2020, 2, 6), 3.0)])
    T.merge_rows(spark, first.unionByName(first), root, "northbound_flow")
    jan = T.scan(spark, root, "northbound_flow", end="2020-01-31").inputFiles()
    update = _flow(spark, [("a", D(2020, 2, 5), 20.0), ("a", D(2020, 2, 5), 20.0), ("c", D(2020, 3, 1), 4.0)])
    for _ in range(2):
        T.merge_rows(spark, update, root, "northbound_flow")
    assert _stored(spark, root) == {("a", D(2020, 1, 5)): 1.0, ("a", D(2020, 2, 5)): 20.0, ("b", D(2020, 2, 6)): 3.0, ("c", D(2020, 3, 1)): 4.0}
    assert T.scan(spark, root, "northbound_flow", end="2020-01-31").inputFiles() == jan
    pruned = T.scan(spark, root, "northbound_flow", start="2020-02-01", end="2020-02-28")
    assert pruned.count() == 2
    assert "month=2020-02" in str(pruned.inputFiles()) and "month=2020-01" not in str(pruned.inputFiles())
    assert T.vacuum(spark, root, "northbound_flow")
    assert len(_stored(spark, root)) == 4
    with pytest.raises(Exception, match="NULL key"):
        T.merge_rows(spark, _flow(spark, [(None, D(2020, 1, 5), 1.0)]), root, "northbound_flow")


def test_tables_without_months_are_merged_too(spark, root):
    schema = "stock_code string, stock_name string"
    T.merge_rows(spark, spark.createDataFrame([("a", "A"), ("b", "B")], schema), root, "stock_master")
    T.merge_rows(spark, spark.createDataFrame([("b", "BB"), ("c", "C")], schema), root, "stock_master")
    assert {r.stock_code: r.stock_name for r in T.scan(spark, root, "stock_master").collect()} == {"a": "A", "b": "BB", "c": "C"}


def test_a_death_before_publishing_loses_nothing(spark, root, monkeypatch):
    T.merge_rows(spark, _flow(spark, [("a", D(2020, 1, 5), 1.0)]), root, "northbound_flow")
    update = _flow(spark, [("a", D(2020, 1, 5), 2.0), ("b", D(2020, 1, 6), 3.0)])

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(T, "_publish", die)
    with pytest.raises(RuntimeError, match="killed"):
        T.merge_rows(spark, update, root, "northbound_flow")
    monkeypatch.undo()
    assert _stored(spark, root) == {("a", D(2020, 1, 5)): 1.0}
    T._create_text(spark, f"{root}/northbound_flow/_manifests/2", "2020-01\t_data/half")  # died while publishing
    assert _stored(spark, root) == {("a", D(2020, 1, 5)): 1.0}
    T.merge_rows(spark, update, root, "northbound_flow")
    assert _stored(spark, root) == {("a", D(2020, 1, 5)): 2.0, ("b", D(2020, 1, 6)): 3.0}
    with pytest.raises(RuntimeError, match="another writer"):
        T._publish(spark, root, "northbound_flow", 3, {})


def test_append_and_export(spark, root):
    df = _flow(spark, [("a", D(2020, 1, 5), 1.0)])
    T.append(df, root, "northbound_flow")
    T.append(df, root, "northbound_flow")
    assert T.scan(spark, root, "northbound_flow").count() == 2
    T.export({"northbound_flow": df}, root, ["northbound_flow"])
    store = T.Store(spark, root)
    assert store["northbound_flow"].count() == 1
    assert list(store) == ["northbound_flow"] and "stock_daily" not in store and len(store) == 1
    assert "nothing" not in T.Store(spark, f"{root}/nowhere")
    with pytest.raises(KeyError):
        T.Store(spark, root)["nothing"]


def test_versions_become_visible_only_when_committed(spark, root):
    one, two = _flow(spark, [("a", D(2020, 1, 1), 1.0)]), _flow(spark, [("a", D(2020, 1, 1), 2.0)])
    with pytest.raises(FileNotFoundError):
        T.read_version(spark, root, "flow")
    assert T.commit_version(spark, {"flow": one}, root) == 1
    two.write.parquet(f"{root}/v2-dead/flow")  # a job that died before its commit
    assert T.read_version(spark, root, "flow").first().net_inflow == 1.0
    assert T.commit_version(spark, {"flow": two}, root) == 2
    assert T.read_version(spark, root, "flow").first().net_inflow == 2.0
    assert T.read_version(spark, root, "flow", 1).first().net_inflow == 1.0


KEYS = ("k",)


def _pair(spark):
    schema = "k int, a int, b string"
    target = spark.createDataFrame([(1, 1, "x"), (2, None, "y"), (3, 3, None)], schema)
    updates = spark.createDataFrame([(2, 20, None), (3, None, "z"), (4, 40, "w")], schema)
    return target, updates


MERGES = {
    "insert": (merge.insert_if_absent, {1: (1, "x"), 2: (None, "y"), 3: (3, None), 4: (40, "w")}),
    "overwrite": (merge.upsert, {1: (1, "x"), 2: (20, None), 3: (None, "z"), 4: (40, "w")}),
    "protect": (lambda t, u, k: merge.upsert(t, u, k, rule=merge.protect), {1: (1, "x"), 2: (20, "y"), 3: (3, "z"), 4: (40, "w")}),
    "columns": (lambda t, u, k: merge.upsert(t, u, k, ["a"]), {1: (1, "x"), 2: (20, "y"), 3: (None, None), 4: (40, "w")}),
    "fill": (lambda t, u, k: merge.update_from(t, u, k, ["a", "b"], merge.fill), {1: (1, "x"), 2: (20, "y"), 3: (3, "z")}),
    "group": (lambda t, u, k: merge.patch_group(t, u, k, ["a", "b"]), {1: (1, "x"), 2: (20, None), 3: (None, "z")}),
    "delete": (lambda t, u, k: merge.delete_keys(t, u, k), {1: (1, "x")}),
    "replace": (lambda t, u, k: merge.replace_by(t, u, k), {1: (1, "x"), 2: (20, None), 3: (None, "z"), 4: (40, "w")}),
}


@pytest.mark.parametrize("name", list(MERGES))
def test_merges_twice(spark, name):
    fn, expected = MERGES[name]
    target, updates = _pair(spark)
    once = fn(target, updates, KEYS)
    assert {r.k: (r.a, r.b) for r in once.collect()} == expected
    assert {r.k: (r.a, r.b) for r in fn(once, updates, KEYS).collect()} == expected


def test_merge_never_needs_a_full_outer_join(spark):
    target, updates = _pair(spark)
    plan = merge.upsert(target, updates, KEYS)._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


def test_sources_by_priority(spark):
    one = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    two = spark.createDataFrame([(1, 7, 1), (3, None, 2)], "k int, v int, w int")
    three = spark.createDataFrame([(3, 9), (1, 8)], "k int, v int")
    out = {r.k: (r.v, r.w) for r in merge.merge_sources([one, two, three], KEYS).collect()}
    assert out == {1: (7, 1), 2: (5, None), 3: (9, 2)}


def test_stream_of_repeated_and_late_rows(spark, root):
    schema = "stock_code string, trade_date date, net_inflow double, seq int"
    src = f"{root}/in"
    batches = [
        [("a", D(2020, 1, 1), 1.0, 1), ("a", D(2020, 1, 1), 2.0, 2), ("b", D(2020, 1, 1), 5.0, 3)],
        [("a", D(2019, 12, 1), 9.0, 4), ("a", D(2020, 1, 1), 3.0, 5)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        query = upsert_stream(stream, f"{root}/t", "northbound_flow", f"{root}/check", ["net_inflow"], order=("seq",))
        query.awaitTermination()
    out = {(r.stock_code, r.trade_date): float(r.net_inflow) for r in T.scan(spark, f"{root}/t", "northbound_flow").collect()}
    assert out == {("a", D(2020, 1, 1)): 3.0, ("b", D(2020, 1, 1)): 5.0, ("a", D(2019, 12, 1)): 9.0}


def test_whole_update_twice(spark, sf_dir, root):
    landed = {
        "stock_daily": view(spark, sf_dir, "bars"),
        "financial_statements": view(spark, sf_dir, "statements"),
        "stock_capital": view(spark, sf_dir, "capital"),
        "dividends": view(spark, sf_dir, "dividends"),
        "northbound_flow": view(spark, sf_dir, "northbound_rows"),
    }
    assert load_and_derive(spark, landed, "2001-06-30", root) == 1
    counts = {n: T.read_version(spark, f"{root}/derived", n).count() for n in DERIVED}
    assert load_and_derive(spark, landed, "2001-06-30", root) == 2
    assert {n: T.read_version(spark, f"{root}/derived", n).count() for n in DERIVED} == counts
    assert counts["stock_daily"] == landed["stock_daily"].count()
    log = T.read_version(spark, f"{root}/update_log", "update_log")
    marks = {r.stock_code: r.last_update_date for r in log.where("data_type = 'stock_daily'").collect()}
    last = landed["stock_daily"].groupBy("stock_code").agg(F.max("trade_date").alias("d")).collect()
    assert marks == {r.stock_code: r.d for r in last}


def test_recompute_from_views(spark, sf_dir, root):
    assert recompute(spark, MarketTables(spark, sf_dir), "2001-06-30", root) == 1
    stored = T.read_version(spark, root, "technical_indicators")
    assert [f.dataType.simpleString() for f in stored.schema.fields][2] == "decimal(10,2)"


def test_watermark_moves_only_with_data(spark):
    log = spark.createDataFrame([("a", "daily", D(2020, 1, 1))], "stock_code string, data_type string, last_update_date date")
    marks = spark.createDataFrame([("a", "daily", D(2020, 1, 3)), ("b", "daily", D(2020, 1, 2))], log.schema)
    out = {r.stock_code: r.last_update_date for r in write_watermarks(log, marks).collect()}
    assert out == {"a": D(2020, 1, 3), "b": D(2020, 1, 2)}


def test_keep_last_of_a_hot_key(spark):
    """A third of all rows share one key; groups are cut down before the shuffle."""
    rows = spark.range(30000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS seq", "string(id) AS v")
    out = keep_last(rows, ["k"], "seq")
    assert out.count() == 20001
    assert out.where("k = 0").first().v == "29997"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ticks_from_a_folder_of_parts(spark, sf_dir, tmp_path):
    from checks.streams import ticks

    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")

    def rows(folder):
        name = f"ticks_{uuid.uuid4().hex}"
        ticks(spark, str(folder)).writeStream.format("memory").queryName(name).trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.table(name).collect()))

    assert rows(tmp_path) == rows(sf_dir)


@pytest.fixture
def asked(monkeypatch):
    """The market's tables, by name, each time they are asked for."""
    names, own = [], MarketTables.__getitem__
    monkeypatch.setattr(MarketTables, "__getitem__", lambda self, table: names.append(table) or own(self, table))
    return names


def test_a_full_run_derives_the_bars_once(spark, sf_dir, root, asked):
    recompute(spark, MarketTables(spark, sf_dir), "2001-06-30", root)
    assert asked.count("stock_daily") == 1


def test_replaced_bars_come_from_the_stored_ones(spark, sf_dir, asked):
    from checks.updates import _bucketed_counts

    assert _bucketed_counts(spark, sf_dir).count() > 0
    assert asked == ["stock_daily"]


def test_new_months_and_watermarks_need_no_wide_join(spark, root, monkeypatch):
    """A backfill of months that are not stored is merged with nothing, and watermarks read the stored rows as they are."""
    from tickloom.plans import pipeline

    def rows(*days):
        return spark.createDataFrame([("sh600001", dt.date.fromisoformat(d), 1.0) for d in days], "stock_code string, trade_date date, net_inflow double")

    read, marks = [], pipeline.stored_watermarks
    monkeypatch.setattr(pipeline, "stored_watermarks", lambda data, *names: read.append(data) or marks(data, *names))
    pipeline.load(spark, {"northbound_flow": rows("2024-05-02", "2024-05-03")}, root)
    with monkeypatch.context() as m:
        upsert = merge.upsert
        m.setattr(merge, "upsert", lambda old, *rest: pytest.fail("nothing stored to merge with") if "net_inflow" in old.columns else upsert(old, *rest))
        pipeline.load(spark, {"northbound_flow": rows("2024-03-01")}, root)
    pipeline.load(spark, {"northbound_flow": rows("2024-05-03", "2024-05-06")}, root)
    assert all("Join" not in f._jdf.queryExecution().optimizedPlan().toString() for f in read)
    stored = T.scan(spark, f"{root}/tables", "northbound_flow").orderBy("trade_date").collect()
    assert [str(r.trade_date) for r in stored] == ["2024-03-01", "2024-05-02", "2024-05-03", "2024-05-06"]
    log = T.read_version(spark, f"{root}/update_log", "update_log").collect()
    assert [str(r.last_update_date) for r in log] == ["2024-05-06"]


def test_decimals_of_doubles_are_those_of_the_cast(spark):
    """The cheap way gives what ``try_cast`` gives, ties, signs, limits and values that do not fit included."""
    from tickloom.functions.scalar import to_decimal

    values = [0.0, -0.0, 0.00005, -0.00005, 1.00005, 2.00015, 0.12345, 1234.56785, 99999.99995, 999999.99994999, 999999.99995, 999999.9999500001]
    values += [1e6, 9.99999999e8, 1e10, 1e11 / 3, 1e300, 5e-324, float("nan"), float("inf"), -float("inf"), None, 1 / 3, 2 / 3, 0.1 + 0.2]
    values += [s * (i + 0.5 + d) / 1e4 for i in (0, 7, 12345, 99999999) for d in (0, 1e-9, -1e-9, 2e-3, -2e-3) for s in (1, -1)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").unionByName(spark.range(20000).selectExpr("(rand(7) - 0.5) * pow(10, id % 13) AS x"))
    for digits, scale in ((10, 4), (10, 2), (18, 2), (18, 4), (20, 6), (5, 4)):
        cast = f"try_cast(x AS decimal({digits},{scale}))"
        assert rows.where(f"NOT ({to_decimal('x', digits, scale)} <=> {cast})").collect() == []
    assert T._strict("x", "decimal(10,4)", "decimal(10,4)") == "x"
    assert "rint" in T._strict("x", "decimal(10,4)", "double")


def test_rows_without_repeated_keys_are_stored_as_they_landed(spark, root, monkeypatch):
    """Only repeated keys are ranked and written a second time."""
    from tickloom.plans.pipeline import load

    def rows(*values):
        return spark.createDataFrame([(s, D(2024, 5, d), float(v)) for s, d, v in values], "stock_code string, trade_date date, net_inflow double")

    ranked, own = [], T.keep_last
    monkeypatch.setattr(T, "keep_last", lambda *args: ranked.append(1) or own(*args))
    load(spark, {"northbound_flow": rows(("a", 1, 1), ("b", 1, 2))}, root)
    load(spark, {"northbound_flow": rows(("a", 1, 3), ("a", 2, 4))}, root)
    assert not ranked
    load(spark, {"northbound_flow": rows(("b", 1, 6), ("b", 1, 7), ("c", 1, 1))}, root)
    assert ranked == [1]
    stored = {(r.stock_code, r.trade_date.day): float(r.net_inflow) for r in T.scan(spark, f"{root}/tables", "northbound_flow").collect()}
    assert stored == {("a", 1): 3.0, ("a", 2): 4.0, ("b", 1): 7.0, ("c", 1): 1.0}


def test_a_full_run_over_stored_tables_writes_each_row_once(spark, sf_dir, root, monkeypatch):
    """Indicators are not staged: the states are taken from the table that the version stores, where no reader sees them."""
    from tickloom.operators.technical import fold_states, technical_with_states
    from tickloom.plans import pipeline

    names = {"stock_daily": "bars", "financial_statements": "statements", "stock_capital": "capital", "dividends": "dividends", "northbound_flow": "northbound_rows"}
    few = "stock_code < 'sh6' OR right(stock_code, 1) = '1'"
    pipeline.load(spark, {t: view(spark, sf_dir, v).where(few) for t, v in names.items()}, root)
    store = T.Store(spark, f"{root}/tables")

    class Refuse:
        def __enter__(self):
            return lambda df: pytest.fail("written a second time")

        def __exit__(self, *failure):
            return None

    monkeypatch.setattr(pipeline, "staging", lambda *args: Refuse())
    recompute(spark, store, "2001-06-30", f"{root}/derived")
    stored = T.read_version(spark, f"{root}/derived", "technical_indicators")
    assert stored.columns == list(T.TABLES["technical_indicators"].columns)
    assert T.Store(spark, f"{root}/tables", [f"{root}/derived"])["technical_indicators"].columns == stored.columns
    series = technical_with_states(store["stock_daily"])
    for found, wanted in ((stored, T.conform(series, "technical_indicators")), (T.read_version(spark, f"{root}/derived", pipeline.STATES), fold_states(series))):
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.select(found.columns).collect()))


def test_wide_tables_are_cast_the_long_way(spark, sf_dir, monkeypatch):
    """The code that makes decimals of more doubles by whole units would not fit a method."""
    short, own = [], T.to_decimal
    monkeypatch.setattr(T, "to_decimal", lambda *args: short.append(args[0]) or own(*args))
    tables = MarketTables(spark, sf_dir)
    T.conform(tables["financial_intermediate"], "financial_intermediate")
    assert not short
    T.conform(tables["technical_indicators"], "technical_indicators")
    assert 0 < len(short) <= T.UNITS_COLUMNS


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _gone(spark, before):
    until = time.time() + 20  # executors remove them a moment later
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    return not _shuffle_files(spark) - before


def _codecs(folder):
    files = glob.glob(f"{folder.removeprefix('file:')}/**/*.parquet", recursive=True)
    assert files
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}


def test_what_is_stored_is_packed_and_leaves_no_shuffle(spark, root):
    before = _shuffle_files(spark)
    rows = _flow(spark, [(f"s{i}", D(2020, 1 + i % 3, 1), float(i)) for i in range(50)]).repartition(3)
    T.export({"northbound_flow": rows}, f"{root}/t", ["northbound_flow"])
    T.commit_version(spark, {"flow": rows}, f"{root}/v")
    T.land(rows, "northbound_flow", f"{root}/landed")
    assert [_codecs(f"{root}/{x}") for x in ("t", "v", "landed")] == [{"ZSTD"}] * 3
    assert _gone(spark, before)
    assert T.read_version(spark, f"{root}/v", "flow").exceptAll(rows).isEmpty()


def test_a_version_may_have_tables_of_an_earlier_one(spark, root):
    one, two = _flow(spark, [("a", D(2020, 1, 1), 1.0)]), _flow(spark, [("a", D(2020, 1, 1), 2.0)])
    T.commit_version(spark, {"flow": one, "other": two}, root)
    T.commit_version(spark, {"flow": two}, root, (1, ["other"]))
    T.commit_version(spark, {"flow": one}, root, (2, ["other"]))
    assert T.table_folder(spark, root, 3, "other") == T.table_folder(spark, root, 1, "other")
    assert T.has_table(spark, root, "other", 3) and not T.has_table(spark, root, "another", 3)
    assert T.read_version(spark, root, "other").first().net_inflow == 2.0
    assert [T.read_version(spark, root, "flow", v).first().net_inflow for v in (1, 2, 3)] == [1.0, 2.0, 1.0]


class Few(MarketTables):
    """The market of some symbols."""

    def __getitem__(self, table):
        return super().__getitem__(table).where("right(stock_code, 1) IN ('1', '2')")


def test_another_day_derives_valuations_only(spark, sf_dir, root, monkeypatch):
    """Dividends that enter or leave the year change nothing but valuations: the other tables stay where they are."""
    from tickloom.plans import pipeline

    tables = Few(spark, sf_dir)
    recompute(spark, tables, "2000-03-31", root)
    with monkeypatch.context() as m:
        for name in ("technical_since", "technical_with_states"):
            m.setattr(pipeline, name, lambda *args: pytest.fail("indicators do not depend on the day"))
        assert recompute(spark, tables, "2001-06-30", root, tables["stock_master"].where("false").select("stock_code")) == 2
    recompute(spark, tables, "2001-06-30", f"{root}-whole")
    for name in (*DERIVED, pipeline.STATES):
        same = T.table_folder(spark, root, 2, name) == T.table_folder(spark, root, 1, name)
        assert same == (name != "valuation_indicators"), name
    one, two = T.read_version(spark, root, "valuation_indicators"), T.read_version(spark, f"{root}-whole", "valuation_indicators")
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and not one.isEmpty()
    assert not T.read_version(spark, root, "valuation_indicators", 1).exceptAll(one).isEmpty()


def test_whole_series_of_some_symbols_are_derived_as_in_a_full_run(spark, sf_dir, root, asked, monkeypatch):
    """No state is read for them, the bars are derived once, and what others read is that of a full run."""
    from tickloom.plans import pipeline

    monkeypatch.setattr(pipeline, "technical_since", lambda *args: pytest.fail("there is no state to go on from"))
    tables = Few(spark, sf_dir)
    recompute(spark, tables, "2001-06-30", root)
    asked.clear()
    half = tables["stock_master"].where("right(stock_code, 1) = '1'").select("stock_code")
    assert recompute(spark, tables, "2001-06-30", root, half) == 2 and asked.count("stock_daily") == 1
    for name in (*DERIVED, pipeline.STATES):
        one, two = (T.read_version(spark, root, name, v) for v in (1, 2))
        assert one.columns == two.columns and one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty(), name
        assert T.table_folder(spark, root, 2, name) != T.table_folder(spark, root, 1, name)


def test_a_landing_folder_goes_when_its_rows_are_merged(spark, sf_dir, root, monkeypatch):
    from tickloom.plans import pipeline

    seen = []

    def derive(spark, tables, as_of, folder, symbols, first_days):
        landed = f"{root}/landing".removeprefix("file:")
        seen.append((os.listdir(f"{landed}/{os.listdir(landed)[0]}"), sorted(symbols.collect()), sorted(first_days.collect())))
        return 1

    monkeypatch.setattr(pipeline, "recompute", derive)
    bars = spark.createDataFrame([("a", D(2020, 1, d), 1.0) for d in (2, 1)] + [("b", D(2020, 2, 1), 2.0)], "stock_code string, trade_date date, close double")
    load_and_derive(spark, {"stock_daily": bars, "northbound_flow": _flow(spark, [("c", D(2020, 1, 1), 1.0)])}, "2020-06-30", root)
    assert seen == [([], [("a",), ("b",), ("c",)], [("a", D(2020, 1, 1)), ("b", D(2020, 2, 1))])]
    assert T.scan(spark, f"{root}/tables", "stock_daily").count() == 3


def test_filled_in_bars_are_derived_once(spark, sf_dir):
    from checks.indicators import _backfilled

    assert not [f for f in _backfilled(spark, sf_dir).inputFiles() if f.endswith("lineitem.parquet")]


def test_a_family_is_shuffled_once_for_both_sides(spark, sf_dir):
    from checks.registry import all_checks

    found = all_checks()["recompute_valuation_indicators"].query(spark, sf_dir)
    assert {r.column_name for r in found.collect() if not r.passed} == {"pe_ttm"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan[: plan.index("Initial Plan")] and any("lineitem" in f for f in found.inputFiles())
