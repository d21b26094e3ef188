"""Balanced label propagation: documents with equal texts gather in few shards of equal size.

Every shard takes its share of the rows, so counts are at most one apart. Linked documents (equal texts)
start spread evenly. In each round a group looks for the shard with room in which most of its members
are, and members from shards where fewer are move there as far as the shard's quota allows; rounds end
when nothing moves. Members of a group are each other's neighbours and so alike, which is why a round
works on counts by group and shard: at most as many rows as the group has shards, also for a group
that holds a third of all rows. Documents without links fill what is left.

Ranks never order many rows in one task: rows carry a bucket, rows are counted by bucket, and running
sums over buckets give each bucket its offset. Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import written

#: Rows of a bucket, about, and the least number of buckets.
BUCKET_ROWS = 20_000
BUCKETS = 256
MAX_ROUNDS = 64


def _ranked(df: DataFrame, within: list[str], order: list[str], rank: str, weight: str | None = None) -> DataFrame:
    """``df`` with the exclusive running sum of ``weight`` (1 if None) among rows that agree in ``within``.

    Rows are ordered by ``bucket`` and then by ``order``, which must be distinct inside a bucket.
    """
    value = F.col(weight) if weight else F.lit(1)
    by_bucket = df.groupBy(*within, "bucket").agg(F.sum(value).cast("long").alias("_sum"))
    before = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    if not within:  # one row per bucket
        before = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast("long")).drop("_sum")
    inside = Window.partitionBy(*within, "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("long"))
    return own.join(offsets, [*within, "bucket"]).withColumn(rank, F.col("_offset") + F.col("_own")).drop("_offset", "_own")


def _steps(bounds: list[int], rank: str) -> str:
    """The number of the first bound that is above the rank, as SQL."""
    return "CASE " + " ".join(f"WHEN {rank} < {b} THEN {s}" for s, b in enumerate(bounds)) + " END"


def propagated(counts: DataFrame, capacity: list[int], max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Label propagation over ``grp, bucket, shard, n`` (members of a group in a shard) under ``capacity``.

    A shard takes members up to its free places at the round's start, groups in order of bucket and key.
    """
    shards = len(capacity)
    state = written(counts, "shard-counts")
    for _ in range(max_rounds):
        free = {r[0]: capacity[r[0]] - r[1] for r in state.groupBy("shard").agg(F.sum("n")).collect()}
        free_places = F.element_at(F.array(*[F.lit(free.get(s, capacity[s])) for s in range(shards)]), F.col("shard") + 1)
        # only shards with room are targets; ties are broken by a hash of group and shard
        order = F.struct(F.col("n"), F.xxhash64("grp", "shard").alias("tie"), F.col("shard"), F.col("free"))
        seen = state.withColumn("free", free_places.cast("long")).withColumn("order", order)
        seen = seen.withColumn("best", F.max(F.when(F.col("free") > 0, F.col("order"))).over(Window.partitionBy("grp")))
        movers = seen.where("best IS NOT NULL AND order < best").select("grp", "bucket", "shard", "n", "best")
        inside = Window.partitionBy("grp").orderBy("n", "shard").rowsBetween(Window.unboundedPreceding, -1)
        movers = movers.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0))).selectExpr(
            "grp", "bucket", "shard", "n", "ahead", "best.shard AS target", "best.free AS free"
        )
        asked = movers.groupBy("grp", "bucket", "target").agg(F.sum("n").alias("asked"))
        queue = _ranked(asked, ["target"], ["grp"], "before", "asked").select("grp", "before")
        moves = (
            movers.join(queue, "grp")
            .withColumn("moved", F.expr("least(n, greatest(0, free - before - ahead))"))
            .where("moved > 0")
        )
        moves = written(moves.select("grp", "bucket", "shard", "target", "moved"), "shard-moves")
        if moves.isEmpty():
            break
        gone = moves.selectExpr("grp", "bucket", "shard", "-moved AS n")
        come = moves.selectExpr("grp", "bucket", "target AS shard", "moved AS n")
        state = state.select("grp", "bucket", "shard", "n").unionByName(gone).unionByName(come)
        state = written(state.groupBy("grp", "bucket", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shard-counts")
    return state


def sharded(docs: DataFrame, shards: int = 16, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``.

    Law ``rows``: counts of shards differ by at most one, slots of a shard run from 0 without gaps. A null
    text is like an empty one (size 1); all such rows are one group. Null and repeated doc_ids are rows
    like others. An empty table gives no rows; other columns are not read.
    """
    total = docs.count()
    buckets = max(BUCKETS, -(-total // BUCKET_ROWS))
    text = "coalesce(CAST(text AS STRING), '')"
    rows = docs.selectExpr(
        "CAST(doc_id AS LONG) AS doc_id",
        f"CAST(octet_length({text}) AS LONG) + 1 AS size",
        f"crc32(CAST({text} AS BINARY)) AS text_crc32",
        f"unhex(md5({text})) AS grp",
    ).withColumn("bucket", F.expr(f"CAST(pmod(xxhash64(doc_id, grp), {buckets}) AS INT)"))
    rows = written(rows.withColumn("row", F.row_number().over(Window.partitionBy("bucket").orderBy("doc_id", "grp"))), "shard-rows")
    capacity = [total // shards + (s < total % shards) for s in range(shards)]

    groups = rows.groupBy("grp").agg(F.count("*").alias("members")).where("members > 1")
    linked = rows.join(groups, "grp", "left_semi").select("grp", "bucket", "row")
    linked = _ranked(linked, [], ["row"], "place")
    linked = written(_ranked(linked, ["grp"], ["row"], "member"), "shard-linked")
    spread = linked.groupBy("grp", F.expr(f"CAST(place % {shards} AS INT)").alias("shard")).agg(F.count("*").alias("n"))
    # larger groups come first: their buckets are lower
    by_size = f"CAST((62 - floor(log2(members))) * {buckets} + pmod(xxhash64(grp), {buckets}) AS INT)"
    spread = spread.join(groups, "grp").withColumn("bucket", F.expr(by_size))
    state = propagated(spread.select("grp", "bucket", "shard", "n"), capacity, max_rounds)

    running = Window.partitionBy("grp").orderBy("shard")
    bounds = state.withColumn("below", F.sum("n").over(running)).groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("below", "shard"))).alias("bounds"))
    placed = linked.join(bounds, "grp").select("bucket", "row", F.expr("filter(bounds, b -> member < b.below)[0].shard").alias("own"))
    taken = {r[0]: r[1] for r in state.groupBy("shard").agg(F.sum("n")).collect()}
    left, ends = 0, []
    for s in range(shards):
        left += capacity[s] - taken.get(s, 0)
        ends.append(left)

    everything = rows.drop("grp").join(placed, ["bucket", "row"], "left")
    lone = _ranked(everything.where("own IS NULL").drop("own"), [], ["row"], "place")
    lone = lone.withColumn("shard", F.expr(_steps(ends, "place"))).drop("place")
    whole = everything.where("own IS NOT NULL").withColumnRenamed("own", "shard").unionByName(lone)
    slots = _ranked(whole.withColumn("shard", F.col("shard").cast("int")), ["shard"], ["row"], "slot")
    return slots.selectExpr("doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot", "CAST(NULL AS INT) AS grown_shard")
