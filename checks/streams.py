"""The streaming forms, run to the end of their input."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.duck_views import symbol as duck_symbol
from checks.present import Check
from tickloom.session import shared_folder
from tickloom.sources.market_views import symbol, view
from tickloom.sources.tables import is_file, scan
from tickloom.streaming.series import keyed_state, recursive_stream
from tickloom.streaming.upserts import bars_from_stored_ticks, daily_bars, distinct_list_stream, upsert_stream

_EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
_DELAY_HOURS = 30


def ticks(spark, d):
    """Events as ticks of their user's instrument."""
    events = spark.readStream.schema(_EVENTS)
    if is_file(spark, f"{d}/events.parquet"):  # a stream reads folders; a single file is picked from its own
        events = events.option("pathGlobFilter", "events.parquet").parquet(d)
    else:
        events = events.parquet(f"{d}/events.parquet")
    return events.selectExpr(
        f"{symbol('user_id')} AS stock_code", "ts", "event_id AS seq",
        "cast(value AS decimal(10,2)) AS price",
        "cast(get_json_object(props, '$.k') AS bigint) AS volume",
    )


def _closed_bars(spark, d):
    """Append mode: a bar is written once, when the watermark has passed its day."""
    root = f"{shared_folder(spark)}/closed-bars-{uuid.uuid4().hex}"
    bars = daily_bars(ticks(spark, d), f"{_DELAY_HOURS} hours")
    upsert_stream(bars, f"{root}/tables", "stock_daily", f"{root}/checkpoint").awaitTermination()
    return scan(spark, f"{root}/tables", "stock_daily")


def _running_bars(spark, d):
    """Update mode: today's bar is stored at once and overwritten as its day goes on."""
    root = f"{shared_folder(spark)}/running-bars-{uuid.uuid4().hex}"
    bars = daily_bars(ticks(spark, d), f"{_DELAY_HOURS} hours")
    query = upsert_stream(bars, f"{root}/tables", "stock_daily", f"{root}/checkpoint", mode="update")
    query.awaitTermination()
    return scan(spark, f"{root}/tables", "stock_daily")


def _late_bars(spark, d):
    """A third of every day's ticks comes in a second stream, after all days have been stored."""
    root = f"{shared_folder(spark)}/late-bars-{uuid.uuid4().hex}"
    for number, part in enumerate(("seq % 3 != 1", "seq % 3 = 1")):
        late = bars_from_stored_ticks(ticks(spark, d).where(part), root, f"{root}/checkpoint{number}")
        late.awaitTermination()
    return scan(spark, f"{root}/tables", "stock_daily")


def _recursive(spark, d):
    """Bars in three micro-batches, each after a restart; the stream's state goes on from its checkpoint."""
    root = f"{shared_folder(spark)}/recursive-{uuid.uuid4().hex}"
    bars = view(spark, d, "bars").select("stock_code", "trade_date", "high", "low", "close")
    parts = ("trade_date < '1993-06-01'", "trade_date BETWEEN '1993-06-01' AND '1996-02-29'", "trade_date > '1996-02-29'")
    for part in parts:
        bars.where(part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(bars.schema).parquet(f"{root}/in")
        with keyed_state(spark):
            sink = recursive_stream(stream).writeStream.format("parquet").option("path", f"{root}/out")
            query = sink.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.parquet(f"{root}/out").where("NOT late")


#: Announcements before this day of which every third comes after all others.
_TURN = "1996-06-30"
_HELD = f"announcement_date < DATE '{_TURN}' AND day(announcement_date) % 3 = 1"


def _list_once(spark, d):
    """A list published three times: the old part, all but some old rows with a part repeated, and everything again."""
    root = f"{shared_folder(spark)}/list-{uuid.uuid4().hex}"
    rows = view(spark, d, "announcements").selectExpr("*", "timestamp(announcement_date) AS published")
    old = f"announcement_date <= DATE '{_TURN}' AND NOT ({_HELD})"
    for part in (old, f"announcement_date > date_sub(DATE '{_TURN}', 20) AND NOT ({_HELD})", "true"):
        rows.where(part).unionByName(rows.where(part)).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        distinct_list_stream(stream, root, "announcements", f"{root}/checkpoint", "published", "30 days")
    columns = ["stock_code", "announcement_date", "title"]
    stored = scan(spark, f"{root}/tables", "announcements").select(*columns, F.lit(False).alias("late"))
    late = spark.read.parquet(f"{root}/late/announcements").select(*columns, F.lit(True).alias("late"))
    return stored.unionByName(late)


def _duck(where: str) -> str:
    return f"""
    SELECT {duck_symbol("user_id")} AS stock_code, CAST(ts AS DATE) AS trade_date, first(price ORDER BY event_id) AS open,
           max(price) AS high, min(price) AS low, last(price ORDER BY event_id) AS close, sum(k) AS volume, sum(price) AS amount
    FROM (SELECT *, CAST(value AS DECIMAL(10,2)) AS price, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
    {where} GROUP BY user_id, CAST(ts AS DATE)"""


_CLOSED = f"WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL {_DELAY_HOURS} HOUR"
_FLOATS = "open high low close amount"

CHECKS = [
    Check("stream_closed_bars", _closed_bars, _duck(_CLOSED), "stock_code", _FLOATS, "trade_date", "volume"),
    Check("stream_late_bars", _late_bars, _duck(""), "stock_code", _FLOATS, "trade_date", "volume"),
    Check("stream_list_once", _list_once, f"""
        SELECT DISTINCT stock_code, announcement_date, title, {_HELD} AND announcement_date
               < (SELECT max(announcement_date) FROM announcements) - 30 AS late FROM announcements""",
          "stock_code title late", "", "announcement_date"),
    Check("stream_recursive", _recursive, "SELECT * FROM technical_fold", "stock_code",
          "ema12 ema26 macd_dif macd_dea macd_hist kdj_k kdj_d kdj_j sar", "trade_date"),
    Check("stream_running_bars", _running_bars, _duck(""), "stock_code", _FLOATS, "trade_date", "volume"),
]
