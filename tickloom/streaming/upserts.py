"""Streams into keyed tables.

Late and repeated rows are the normal case here: a day's bar changes until the day is over, and
lists are published late. Each micro-batch is merged by key into the months it touches, so
replaying a batch after a failure changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators import merge
from tickloom.schema import TABLES
from tickloom.sources.tables import merge_rows, scan


def upsert_stream(
    stream: DataFrame,
    root: str,
    table: str,
    checkpoint: str,
    columns: Sequence[str] | None = None,
    rule: merge.Rule = merge.overwrite,
    order: Sequence[str] = (),
    mode: str = "append",
) -> StreamingQuery:
    """Run all available input through keyed merges into a stored table.

    ``order`` ranks rows that repeat a key within one batch; the last one counts.
    """

    def merge_one(batch: DataFrame, _: int) -> None:
        merge_rows(batch.sparkSession, batch, root, table, columns, rule, order)

    writer = stream.writeStream.outputMode(mode).foreachBatch(merge_one)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_list_stream(stream: DataFrame, root: str, table: str, checkpoint: str, event_time: str, delay: str) -> None:
    """A list that is published again and again, into a table that keeps the first row of each key.

    Repeated rows are dropped by a state of the keys of the last ``delay``, before any table is read; what passes is
    added where its key is new. Rows older than the watermark are not seen by that state. A second
    query over the same input, run after the first, writes those whose key is in no table to ``{root}/late/{table}``,
    in a folder of their batch, so that none is lost and a replayed batch writes the same again.
    """
    keys = list(TABLES[table].keys)
    known = stream.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    first = known.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
    upsert_stream(first, f"{root}/tables", table, f"{checkpoint}/list", rule=merge.fill).awaitTermination()
    day = TABLES[table].date_col

    def keep_late(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        span = batch.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
        if span.first is None:
            return
        stored = scan(spark, f"{root}/tables", table, str(span.first), str(span.last)).select(*keys)
        late = batch.join(stored, keys, "left_anti").dropDuplicates(keys)
        late.write.mode("overwrite").parquet(f"{root}/late/{table}/batch={number}")

    writer = known.writeStream.foreachBatch(keep_late).option("checkpointLocation", f"{checkpoint}/late")
    writer.trigger(availableNow=True).start().awaitTermination()


def daily_bars(ticks: DataFrame, delay: str) -> DataFrame:
    """Ticks (stock_code, ts, seq, price, volume) to daily bars.

    The state per symbol and day is a fixed handful of numbers, and the watermark lets days close:
    ticks later than ``delay`` are not in these bars. :func:`bars_from_stored_ticks` keeps them.
    """
    late = ticks.withWatermark("ts", delay)
    bars = late.groupBy("stock_code", F.window("ts", "1 day").alias("day")).agg(*_bar())
    day = "date_from_unix_date(cast(unix_seconds(day.start) div 86400 AS int)) AS trade_date"
    return bars.selectExpr("stock_code", day, *_VALUES)


_VALUES = ("open", "high", "low", "close", "volume", "amount")


def _bar() -> list[Column]:
    return [
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("price").alias("amount"),
    ]


def bars_from_stored_ticks(ticks: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Daily bars that no tick is too late for.

    Every micro-batch's ticks are stored by batch and day, and the bars of the days it touches are
    computed again from all stored ticks of those days. A replayed batch overwrites its own folder.
    """
    run = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex

    def store_and_merge(batch: DataFrame, number: int) -> None:
        day = "date_from_unix_date(cast(unix_seconds(ts) div 86400 AS int)) AS trade_date"
        rows = batch.selectExpr("*", day)
        here = f"{root}/ticks/batch={run}-{number}"
        rows.write.mode("overwrite").partitionBy("trade_date").parquet(here)
        own = batch.sparkSession.read.schema(rows.schema).parquet(here)
        touched = own.select("stock_code", "trade_date").distinct()
        stored = batch.sparkSession.read.schema(rows.schema).parquet(f"{root}/ticks")
        bars = stored.join(touched, ["stock_code", "trade_date"], "left_semi")
        bars = bars.groupBy("stock_code", "trade_date").agg(*_bar())
        merge_rows(batch.sparkSession, bars, f"{root}/tables", "stock_daily")

    writer = ticks.writeStream.foreachBatch(store_and_merge)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
