"""What a step leaves on disk once it has ended."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tickloom import session
from tickloom.llm import components, similar
from tickloom.llm.common import forget, written


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_what_a_write_shuffled_goes_with_it(spark):
    before = _shuffle_files(spark)
    rows = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    stored = written(rows, "shuffled")
    until = time.time() + 20  # executors remove them a moment later
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert sorted(r["count"] for r in stored.collect()) == sorted(r["count"] for r in rows.collect())


@pytest.mark.parametrize("own", [None, "true", "false"])
def test_the_callers_setting_comes_back(spark, own):
    name = session._CLEANUP
    spark.conf.unset(name) if own is None else spark.conf.set(name, own)
    try:
        with pytest.raises(ValueError), session.shuffles_removed(spark):
            raise ValueError
        assert spark.conf.get(name, None) == own
    finally:
        spark.conf.unset(name)


def _labels(spark, since):
    return sorted(n[:-33] for n in set(os.listdir(session.shared_folder(spark).removeprefix("file:"))) - since)


def test_only_what_the_result_reads_is_kept(spark):
    since = set(os.listdir(session.shared_folder(spark).removeprefix("file:")))
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{text} end{i}") for i in range(5)] + [(9, "something else entirely")], "doc_id long, text string")
    groups = similar.similar_groups(docs)
    assert _labels(spark, since) == ["edges", "similar-entries", "similar-heads"]
    assert sorted((r.doc_id, r.component_id) for r in groups.collect()) == [*((i, 0) for i in range(5)), (9, 9)]


def test_rounds_replace_each_other(spark):
    since = set(os.listdir(session.shared_folder(spark).removeprefix("file:")))
    chain = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    got = components.connected_components(chain)
    assert _labels(spark, since) == ["edges"]
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(41)}


def test_nothing_to_forget(spark):
    empty = written(spark.range(0), "empty")
    forget(empty)
    assert empty.schema.names == ["id"]
