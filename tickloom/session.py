"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str, cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tuned(spark)


def tuned(spark: SparkSession) -> SparkSession:
    """Runtime settings for wide projections; safe to apply to a session that is already running.

    HotSpot never compiles a method of more than 8000 bytecodes, and a projection of dozens of
    formulas fused into one generated method exceeds that. Above the limit Spark then generates
    split, compilable methods per operator instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What the writes inside have shuffled goes as each of them ends.

    Else it lies on the executors' disks until the driver's next garbage collection, and the steps of a long job add up.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    Only an unconfigured local session gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
    return context.getCheckpointDir()
