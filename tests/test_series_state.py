"""Series that go on: from a stored state, over blocks, and in a stream."""

import datetime as dt
import decimal
import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.functions.folds import STATE_COLUMNS, ExpMean, Recursion
from tickloom.operators import technical as tech
from tickloom.operators.quality import completeness
from tickloom.operators.scan import Stretch, exp_means
from tickloom.operators.technical import technical_scanned
from tickloom.plans import queries as Q
from tickloom.plans.pipeline import STATES, load_and_derive
from tickloom.session import shared_folder
from tickloom.sources import tables as T
from tickloom.sources.market_views import MarketTables, view
from tickloom.streaming.series import keyed_state, recursive_stream

D = dt.date
KEY = ["stock_code", "trade_date"]


def _sorted(df):
    return df.toPandas().sort_values(KEY).reset_index(drop=True)


def _holes(rng, n, share):
    xs = rng.normal(10, 1, n)
    xs[rng.random(n) < share] = math.nan
    return xs


@pytest.mark.parametrize("share", [0.0, 0.4, 0.97, 1.0])
def test_stretches_compose_to_the_fold(share):
    rng = np.random.default_rng(1)
    for _ in range(20):
        xs = _holes(rng, 60, share)
        cuts = np.sort(rng.integers(0, 61, 4))
        whole = Stretch()
        for part in np.split(xs, cuts):
            whole = whole.then(Stretch.of(part, 0.2), 0.2)
        fold = ExpMean(0.2)
        last = fold.means(xs)[-1]
        assert whole.mean == pytest.approx(last, rel=1e-12, nan_ok=True)
        assert math.isnan(last) or whole.aged == fold.aged


def test_a_series_goes_on_from_any_row():
    rng = np.random.default_rng(2)
    close, high, low, rsv = _holes(rng, 80, 0.2), rng.normal(12, 1, 80), rng.normal(8, 1, 80), _holes(rng, 80, 0.1)
    whole = Recursion().run(close, high, low, rsv)
    for cut in (1, 7, 40, 79):
        head = Recursion().run(close[:cut], high[:cut], low[:cut], rsv[:cut])
        rest = Recursion({c: float(head[c][-1]) for c in STATE_COLUMNS}).run(close[cut:], high[cut:], low[cut:], rsv[cut:])
        for c in STATE_COLUMNS:
            np.testing.assert_array_equal(rest[c], whole[c][cut:])


def test_one_long_series_over_many_tasks(spark):
    """A single symbol of a million rows: blocks are filled side by side, and equal the fold."""
    n = 1_000_000
    rows = spark.range(n, numPartitions=8).selectExpr(
        "'s' AS stock_code", "id AS at", "if(hash(id, 1) % 50 = 0, NULL, 100 + sin(id / 900D) + hash(id) % 1000 / 1000D) AS x"
    )
    out = exp_means(rows, "stock_code", "at", "at div 20000", {"fast": ("x", 2 / 13), "slow": ("x", 2 / 27)})
    tasks = out.select(F.spark_partition_id().alias("p"), "at", "fast", "slow").toPandas().sort_values("at")
    xs = rows.toPandas().sort_values("at").x.to_numpy(float)
    assert len(tasks) == n and tasks.p.nunique() > 1
    for name, alpha in (("fast", 2 / 13), ("slow", 2 / 27)):
        np.testing.assert_allclose(tasks[name], ExpMean(alpha).means(xs), rtol=1e-11)


def test_blocks_without_values(spark):
    rows = [("a", 0, None), ("a", 1, None), ("a", 10, 1.0), ("a", 11, None), ("a", 20, None), ("a", 31, 4.0), ("b", 5, None)]
    out = exp_means(spark.createDataFrame(rows, "k string, at long, x double"), "k", "at", "at div 10", {"m": ("x", 0.5)})
    got = {(r.k, r.at): r.m for r in out.collect()}
    fold = ExpMean(0.5).means(np.array([math.nan if r[2] is None else r[2] for r in rows[:6]]))
    assert [got["a", r[1]] for r in rows[:6]] == [None if math.isnan(m) else m for m in fold] and got["b", 5] is None
    none = exp_means(spark.createDataFrame([], "k string, at long, x double"), "k", "at", "at div 10", {"m": ("x", 0.5)})
    assert none.count() == 0


def test_a_backfilled_day_recomputes_only_what_follows(spark, sf_dir):
    """Two updates, the second with a missing week and new symbols' bars, equal one update with all of them."""
    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    bars = view(spark, sf_dir, "bars")
    late = "(trade_date BETWEEN '1995-03-03' AND '1995-03-10' AND pmod(crc32(cast(stock_code AS binary)), 3) = 0 OR stock_code = (SELECT max(stock_code) FROM b))"
    bars.createOrReplaceTempView("b")
    rest = {
        "financial_statements": view(spark, sf_dir, "statements"), "stock_capital": view(spark, sf_dir, "capital"),
        "dividends": view(spark, sf_dir, "dividends"), "northbound_flow": view(spark, sf_dir, "northbound_rows"),
    }
    load_and_derive(spark, {"stock_daily": bars.where(f"NOT {late}"), **rest}, "2001-06-30", root)
    load_and_derive(spark, {"stock_daily": bars.where(late)}, "2001-06-30", root)
    expected = tech.technical_with_states(bars)
    stored = _sorted(T.read_version(spark, f"{root}/derived", "technical_indicators"))
    pd.testing.assert_frame_equal(stored, _sorted(T.conform(expected, "technical_indicators")))
    states = _sorted(T.read_version(spark, f"{root}/derived", STATES))
    pd.testing.assert_frame_equal(states, _sorted(tech.fold_states(expected)))


def test_only_the_look_back_is_read(spark, sf_dir):
    """A change in the last month reads bars from 61 rows before the snapshot on."""
    bars = view(spark, sf_dir, "bars").persist()
    states = tech.fold_states(tech.technical_with_states(bars)).persist()
    last = bars.groupBy("stock_code").agg(F.max("trade_date").alias("first_day"))
    before = states.join(last, "stock_code").where("trade_date < first_day").groupBy("stock_code")
    read_from = before.agg(F.max_by("window_from", "trade_date").alias("read_from"))
    marked = bars.join(read_from, "stock_code", "left").selectExpr("*", "coalesce(trade_date >= read_from, true) AS needed").drop("read_from")
    assert marked.where("needed").count() < marked.count() / 2
    blank = marked.selectExpr("stock_code", "trade_date", *(f"if(needed, {c}, 0) AS {c}" for c in ("open", "high", "low", "close", "volume", "amount")))
    out = _sorted(tech.technical_since(blank, last, states))
    whole = _sorted(tech.technical_with_states(bars).join(last, "stock_code").where("trade_date >= first_day").drop("first_day"))
    pd.testing.assert_frame_equal(out, whole)


def test_bars_that_come_late_or_twice(spark, tmp_path):
    schema = "stock_code string, trade_date date, high double, low double, close double"
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    bar = {d: ("a", d, 11.0 + i, 9.0 - i, 10.0 + i) for i, d in enumerate(days)}
    batches = [
        [bar[days[0]], ("b", days[0], 1.0, None, None)],
        [bar[days[3]], ("a", days[1], 1.0, 1.0, 1.0), bar[days[1]], bar[days[2]]],
        [bar[days[5]], bar[days[2]], bar[days[4]]],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        with keyed_state(spark):
            sink = recursive_stream(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out")
            sink.option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert [(r.stock_code, r.trade_date, r.ema12) for r in out.where("late").collect()] == [("a", days[2], None)]
    got = out.where("NOT late").toPandas().sort_values("trade_date")
    assert got.trade_date.tolist() == days  # b has one bar only
    full = [(s, d, c, h, lo, c, 1.0, 1.0) for s, d, h, lo, c in (bar[d] for d in days)]
    frame = spark.createDataFrame(full, "stock_code string, trade_date date, open double, high double, low double, close double, volume double, amount double")
    fold = tech.technical(frame).toPandas().sort_values("trade_date")
    for c in ("ema12", "ema26", "macd_dif", "macd_dea", "macd_hist", "kdj_k", "kdj_d", "kdj_j", "sar"):
        np.testing.assert_allclose(got[c], fold[c], rtol=1e-12)


def test_state_of_a_table(spark, sf_dir):
    """The fold's batches may end anywhere: the states of a table do not depend on them."""
    rows = tech._indicators(view(spark, sf_dir, "bars").where("stock_code < 'sh7'")).select(*KEY, "close", "high", "low", "rsv")
    one = rows.toPandas().sort_values(KEY)
    symbol = one[one.stock_code == one.stock_code.iloc[0]]
    table = pa.Table.from_pandas(symbol, preserve_index=False)
    from tickloom.functions.folds import recursive_indicators

    sizes = [pd.concat([pd.DataFrame(x) for x in recursive_indicators(iter(table.to_batches(max_chunksize=s)))], ignore_index=True) for s in (7, 10_000)]
    pd.testing.assert_frame_equal(*sizes)


def test_indicators_that_are_not_asked_for_are_not_planned(spark, sf_dir):
    """The optimizer does not look into the fold: columns are left out before it, and the fold where none needs it."""
    bars = view(spark, sf_dir, "bars")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    one = tech.technical(bars, ["kdj_j"])
    assert one.columns == [*KEY, "kdj_j"] and "stddev" not in plan(one) and "collect_list" not in plan(one)
    pd.testing.assert_frame_equal(_sorted(one), _sorted(tech.technical(bars).select(*KEY, "kdj_j")))
    tables = MarketTables(spark, sf_dir)
    for counted in (Q.coverage_latest(tables), completeness(tables)):
        assert "FlatMapGroups" not in plan(counted)
    assert tables.narrow("technical_indicators", KEY).count() == tables["technical_indicators"].count()


def test_a_stored_value_is_cast_once(spark):
    """Making decimals of doubles is most of what storing wide rows costs."""
    assert T._strict("x", "decimal(10,2)").count("try_cast") == 1
    rows = spark.sql("SELECT 's' AS stock_code, explode(array(2.345D, NULL)) AS ma5")
    assert [r.ma5 for r in T.conform(rows, "technical_indicators").collect()] == [decimal.Decimal("2.35"), None]
    with pytest.raises(Exception, match="ma5: 1.0E30 does not fit"):
        T.conform(spark.sql("SELECT 's' AS stock_code, 1e30 AS ma5"), "technical_indicators").collect()


def test_old_rows_are_not_shuffled_to_meet_a_short_list(spark, sf_dir):
    """The symbols of a run are written, so that the copied rows of a version meet them without an exchange."""
    from checks.indicators import _backfilled
    from checks.updates import _differing

    plan = _backfilled(spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    kept = plan[: plan.index("FlatMapGroups")]  # the rows that stay, before those that are recomputed
    assert "BroadcastHashJoin" in kept and "SortMergeJoin" not in kept
    one, two = (spark.createDataFrame(rows, "a int, b string") for rows in ([(1, "x"), (1, "x"), (2, None)], [(1, "x"), (2, None), (3, "y")]))
    assert _differing(one, two).first().differing == one.exceptAll(two).count() + two.exceptAll(one).count() == 2
    assert _differing(one, one).first().differing == 0 and _differing(one.limit(0), one.limit(0)).first().differing == 0


def test_scanned_rows_are_made_once(spark, sf_dir):
    """Both passes of both rounds read the same shuffled rows, and no group of rows has a call of its own."""
    out = technical_scanned(view(spark, sf_dir, "bars"))
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "FlatMapGroups" not in plan


def test_blocks_that_batches_cut(spark):
    rows = [(k, i, None if (i * 7 + ord(k)) % 5 in (0, 1) else float((i * 37 + ord(k)) % 11)) for k in "abc" for i in range(40)]
    frame = spark.createDataFrame(rows, "k string, at long, x double")
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {(r.k, r.at): r.m for r in exp_means(frame, "k", "at", "at div 8", {"m": ("x", 0.3)}).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    for k in "abc":
        xs = np.array([math.nan if x is None else x for s, _, x in rows if s == k])
        ours = np.array([math.nan if got[k, i] is None else got[k, i] for i in range(40)])
        np.testing.assert_allclose(ours, ExpMean(0.3).means(xs), rtol=1e-9)
