"""Tables stored by symbol: bucketed, so that joins and windows by symbol need no shuffle.

A bucket's files lie in a folder of their own, which is a partition of a catalog table that is also
clustered by symbol into the same buckets; Spark then reads symbols together from the start, and a
replaced bucket is a partition at another place. Tables with equal bucket counts join without exchange.
Writes go to new folders, and one marker created last lists the folder of each bucket.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import merge
from tickloom.schema import TABLES
from tickloom.session import shuffles_removed
from tickloom.sources.tables import PACKED, _create_text, _exists, _numbers, _read_text, conform

SYMBOL = "stock_code"
#: A bucket is written by one task and read by one task; a multiple of the cores that read.
BUCKETS = 16


def bucket_of(buckets: int) -> str:
    """Spark's own rule for a bucketed column."""
    return f"pmod(hash({SYMBOL}), {buckets})"


def _marker(spark: SparkSession, root: str, table: str) -> tuple[int, int, dict[int, str]]:
    """Number of the newest complete marker, bucket count, and the folder of each bucket."""
    for number in _numbers(spark, f"{root}/{table}/_buckets"):
        count, *lines = _read_text(spark, f"{root}/{table}/_buckets/{number}").split("\n")
        if lines and lines[-1] == "end":
            return number, int(count), {int(b): f for b, f in (line.split("\t") for line in lines[:-1])}
    return 0, 0, {}


def _write(rows: DataFrame, folder: str, keys: list[str], buckets: int) -> None:
    scratch = f"tickloom_{uuid.uuid4().hex}"
    placed = rows.withColumn("bucket", F.expr(bucket_of(buckets))).repartition(buckets, SYMBOL)
    writer = placed.write.partitionBy("bucket").bucketBy(buckets, SYMBOL).sortBy(*keys).options(**PACKED)
    with shuffles_removed(rows.sparkSession):
        writer.format("parquet").option("path", folder).saveAsTable(scratch)
    rows.sparkSession.sql(f"DROP TABLE {scratch}")  # the files stay


def _publish(spark: SparkSession, root: str, table: str, number: int, buckets: int, folders: Mapping[int, str]) -> None:
    lines = [str(buckets), *(f"{b}\t{f}" for b, f in sorted(folders.items())), "end"]
    _create_text(spark, f"{root}/{table}/_buckets/{number}", "\n".join(lines))


def _placed(spark: SparkSession, rows: DataFrame, root: str, table: str, buckets: int) -> dict[int, str]:
    """Rows in a new folder for each bucket that has any."""
    folder = f"{root}/{table}/_data/{uuid.uuid4().hex}"
    _write(rows, folder, list(TABLES[table].keys), buckets)
    return {b: f"{folder}/bucket={b}" for b in range(buckets) if _exists(spark, f"{folder}/bucket={b}")}


def store_bucketed(rows: DataFrame, root: str, table: str, buckets: int = BUCKETS) -> None:
    """The whole table anew."""
    spark = rows.sparkSession
    number, _, _ = _marker(spark, root, table)
    folders = _placed(spark, conform(rows, table), root, table, buckets)
    _publish(spark, root, table, number + 1, buckets, folders)


def bucketed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table as last stored, known to the session's catalog under a name of this marker."""
    number, buckets, folders = _marker(spark, root, table)
    if not number:
        raise FileNotFoundError(f"no bucketed table {table} under {root}")
    spec = TABLES[table]
    name = f"tickloom_{table}_{zlib.crc32(root.encode()):08x}_{number}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.spark_type}" for f in spec.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}, bucket INT) USING parquet PARTITIONED BY (bucket) CLUSTERED BY ({SYMBOL}) "
            f"SORTED BY ({', '.join(spec.keys)}) INTO {buckets} BUCKETS LOCATION '{root}/{table}/_none'"
        )
        if folders:
            places = " ".join(f"PARTITION (bucket={b}) LOCATION '{f}'" for b, f in sorted(folders.items()))
            spark.sql(f"ALTER TABLE {name} ADD {places}")
    return spark.table(name)


def replace_symbols(fresh: DataFrame, root: str, table: str) -> list[int]:
    """Every row of the symbols in ``fresh`` gives way to theirs; the other buckets' files stay as they are.

    Returns the buckets that were written. A symbol without a key cannot be placed and fails the job.
    """
    spark = fresh.sparkSession
    number, buckets, folders = _marker(spark, root, table)
    rows = conform(fresh, table).withColumn(SYMBOL, F.expr(f"CASE WHEN {SYMBOL} IS NOT NULL THEN {SYMBOL} ELSE raise_error('NULL {SYMBOL}') END"))
    touched = sorted(r.b for r in rows.selectExpr(f"{bucket_of(buckets)} AS b").distinct().collect())
    if not touched:
        return []
    stored = bucketed(spark, root, table).where(F.col("bucket").isin(touched)).drop("bucket")
    added = _placed(spark, merge.replace_by(stored, rows, [SYMBOL]), root, table, buckets)
    _publish(spark, root, table, number + 1, buckets, {**folders, **added})
    return touched
