"""Tables stored by symbol: plans without shuffles, and replacements that touch their buckets only."""

import uuid

import pytest

from tickloom.operators.technical import technical
from tickloom.operators.valuation import valuation
from tickloom.session import shared_folder
from tickloom.sources import buckets as B
from tickloom.sources.market_views import AS_OF, MarketTables
from tickloom.sources.tables import conform

PARTS = ("stock_daily", "financial_intermediate", "stock_capital", "dividends")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    root, tables = f"{shared_folder(spark)}/{uuid.uuid4().hex}", MarketTables(spark, sf_dir)
    for name in PARTS:
        B.store_bucketed(tables[name], root, name, 4)
    return root, tables


def test_series_and_valuations_need_no_shuffle(spark, stored):
    root, tables = stored
    held = {n: B.bucketed(spark, root, n).drop("bucket") for n in PARTS}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # joins of large tables
    try:
        values = valuation(*(held[n] for n in PARTS), AS_OF)
        assert "Exchange" not in _plan(values) and "Exchange" not in _plan(technical(held["stock_daily"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    expected = valuation(*(tables[n] for n in PARTS), AS_OF)
    assert values.exceptAll(expected).count() == 0 and expected.exceptAll(values).count() == 0


def test_replacing_symbols_touches_their_buckets(spark, stored):
    root, tables = stored
    bars = tables["stock_daily"]
    chosen = sorted(r.stock_code for r in bars.select("stock_code").distinct().collect())[:2]
    fresh = bars.where(f"stock_code IN ('{chosen[0]}', '{chosen[1]}') AND day(trade_date) > 15").withColumn("close", bars.close + 1)
    before = {f.rsplit("/", 2)[1]: f for f in B.bucketed(spark, root, "stock_daily").inputFiles()}
    expected = bars.where(f"stock_code NOT IN ('{chosen[0]}', '{chosen[1]}')").unionByName(fresh)
    touched = B.replace_symbols(fresh, root, "stock_daily")
    now = B.bucketed(spark, root, "stock_daily")
    after = {f.rsplit("/", 2)[1]: f for f in now.inputFiles()}
    assert {k for k in after if after[k] != before[k]} == {f"bucket={b}" for b in touched} and len(touched) < 4
    expected = conform(expected, "stock_daily")
    assert now.count() == expected.count() and now.drop("bucket").exceptAll(expected).count() == 0
    assert B.replace_symbols(fresh.where("false"), root, "stock_daily") == []
    with pytest.raises(Exception, match="NULL stock_code"):
        B.replace_symbols(fresh.selectExpr("CAST(NULL AS STRING) AS stock_code", "trade_date", "close"), root, "stock_daily")


def test_a_death_before_the_marker_changes_nothing(spark, sf_dir, monkeypatch):
    root, bars = f"{shared_folder(spark)}/{uuid.uuid4().hex}", MarketTables(spark, sf_dir)["stock_capital"]
    with pytest.raises(FileNotFoundError):
        B.bucketed(spark, root, "stock_capital")
    B.store_bucketed(bars, root, "stock_capital", 3)

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(B, "_publish", die)
    with pytest.raises(RuntimeError, match="killed"):
        B.replace_symbols(bars.limit(1), root, "stock_capital")
    assert B.bucketed(spark, root, "stock_capital").count() == bars.count()


def test_no_rows(spark, sf_dir):
    root, empty = f"{shared_folder(spark)}/{uuid.uuid4().hex}", MarketTables(spark, sf_dir)["stock_capital"].where("false")
    B.store_bucketed(empty, root, "stock_capital", 3)
    assert B.bucketed(spark, root, "stock_capital").count() == 0


def test_buckets_are_packed_and_leave_no_shuffle(spark, sf_dir):
    from test_storage import _codecs, _gone, _shuffle_files

    before, root = _shuffle_files(spark), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    B.store_bucketed(MarketTables(spark, sf_dir)["stock_capital"], root, "stock_capital", 3)
    assert _codecs(root) == {"ZSTD"} and _gone(spark, before)
