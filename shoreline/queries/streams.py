"""Queries that run a stream over everything available and read back what it wrote."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shoreline.operators.offsets import not_landed, starting_positions
from shoreline.queries.inputs import BATCHES, FEED_SQL, arrivals, feed, plain_feed, table
from shoreline.queries.registry import query
from shoreline.session import path_exists, scratch_path
from shoreline.streaming.jobs import (
    current_counts,
    keep_counts,
    land_raw,
    land_windowed_rows,
    land_windows,
    land_without_replays,
    route_and_append,
    routed,
)
from shoreline.streaming.commits import read_committed
from shoreline.streaming.progress import ProgressLedger, observed_ranges, observing_ranges, read_progress
from shoreline.streaming.sinks import start, write_batch

SECONDS = "yyyy-MM-dd HH:mm:ss"
ROUTED_FIELDS = {
    "account": "originatingEvent.accountNumber",
    "card": "originatingEvent.cardPr",
    "amount": "originatingEvent.internalAmount.value",
}


def staged_table(df: DataFrame, label: str) -> DataFrame:
    """What a stream joins with, as it was before the stream wrote to the same place."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _finish(spark: SparkSession, writer: DataStreamWriter) -> None:
    start(writer, scratch_path(spark, "checkpoint")).awaitTermination()


@query(f"""
WITH {FEED_SQL}
SELECT topic, route, event_id, CASE WHEN NOT broken THEN 'ACCT-' || user_id END AS account,
       CAST(NULL AS VARCHAR) AS card, CASE WHEN NOT broken THEN amount END AS amount
FROM routed
""")
def stream_route_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "routed")
    records = feed(arrivals(spark, sf_dir, "events", "event_id"))
    _finish(spark, route_and_append(routed(records, ROUTED_FIELDS), path))
    return read_committed(spark, path).select(
        "topic", "route", F.col("offset").alias("event_id"), "account", "card", "amount"
    )


LEDGER_SQL = f"""
WITH {FEED_SQL}
SELECT topic, part AS partition, min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
FROM feed GROUP BY topic, part, event_id * {BATCHES} // (SELECT max(event_id) + 1 FROM events)
"""


@query(LEDGER_SQL)
def stream_offset_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ledger = scratch_path(spark, "routed"), scratch_path(spark, "ledger")
    records = feed(arrivals(spark, sf_dir, "events", "event_id"))
    _finish(spark, route_and_append(routed(records, ROUTED_FIELDS), path, ledger_path=ledger))
    return read_committed(spark, ledger, commits_of=path).select("topic", "partition", "from_offset", "until_offset")


@query(LEDGER_SQL)
def stream_progress_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ledger as the stream's own progress tells it, without another look at the records."""
    path, told, name = scratch_path(spark, "landed"), scratch_path(spark, "progress"), f"progress-{uuid.uuid4().hex}"
    known = [tuple(r) for r in plain_feed(table(spark, sf_dir, "events")).select("topic", "partition").distinct().collect()]
    records = observing_ranges(plain_feed(arrivals(spark, sf_dir, "events", "event_id")), known)
    ledger = ProgressLedger(spark, told, {name})
    spark.streams.addListener(ledger)
    try:
        query = start(land_raw(records, path), scratch_path(spark, "checkpoint"), name=name)
        query.awaitTermination()
        last = f"{told}/{query.id}-{query.lastProgress['batchId']}.json"
        for _ in range(600):  # listeners hear a little later than the query ends
            if path_exists(spark, last):
                break
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(ledger)
    return observed_ranges(read_progress(spark, told)).select("topic", "partition", "from_offset", "until_offset")


@query(f"""
WITH {FEED_SQL}
SELECT topic, '{{"topic":"' || topic || '","partition":' || part || ',"offset":' || f.event_id
       || ',"timestamp":"' || strftime(f.ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '","key":"' || f.user_id
       || '","value":"' || replace(e.props, '"', '\\"') || '"}}' AS line
FROM feed f JOIN events e USING (event_id)
""")
def stream_raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    _finish(spark, land_raw(plain_feed(arrivals(spark, sf_dir, "events", "event_id")), path))
    return read_committed(spark, path, file_format="text").select("topic", F.col("value").alias("line"))


@query(f"WITH {FEED_SQL} SELECT topic, CAST(event_id AS VARCHAR) AS event_id FROM feed")
def stream_interval_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches at intervals until all that is there has landed."""
    path = scratch_path(spark, "interval")
    records = plain_feed(arrivals(spark, sf_dir, "events", "event_id"))
    landing = start(land_raw(records, path), scratch_path(spark, "checkpoint"), every_seconds=1)
    try:
        landing.processAllAvailable()
    finally:
        landing.stop()
    return read_committed(spark, path, file_format="text").select("topic", F.get_json_object("value", "$.offset").alias("event_id"))


WINDOWS_SQL = f"""
WITH {FEED_SQL},
placed AS (
  SELECT topic, event_id, time_bucket(INTERVAL '1 minute', ts) AS window_start FROM feed
  UNION ALL
  SELECT topic, event_id, time_bucket(INTERVAL '1 minute', ts) - INTERVAL '1 minute' FROM feed
)
"""


@query(WINDOWS_SQL + """
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_start + INTERVAL '2 minutes', '%Y-%m-%d %H:%M:%S') AS window_end,
       topic, count(*) AS records
FROM placed GROUP BY ALL
""")
def stream_sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch brings records of all times; none of them is too late."""
    path = scratch_path(spark, "windows")
    records = plain_feed(arrivals(spark, sf_dir, "events", "event_id", mixed=True))
    _finish(spark, keep_counts(records, path))
    return current_counts(read_committed(spark, path)).select(
        F.date_format("window_start", SECONDS).alias("window_start"),
        F.date_format("window_end", SECONDS).alias("window_end"),
        "topic",
        "records",
    )


@query(f"""
WITH {FEED_SQL},
placed AS (
  SELECT topic, time_bucket(INTERVAL '1 hour', ts) - i * INTERVAL '1 hour' AS window_start
  FROM feed, unnest(range(0, 10)) AS t(i)
)
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_start + INTERVAL '10 hours', '%Y-%m-%d %H:%M:%S') AS window_end,
       topic, count(*) AS records
FROM placed GROUP BY ALL
""")
def stream_fine_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows ten times as long as their slide; a record is still counted once, in its pane."""
    path, length, slide = scratch_path(spark, "panes"), "10 hours", "1 hour"
    records = plain_feed(arrivals(spark, sf_dir, "events", "event_id", mixed=True))
    _finish(spark, keep_counts(records, path, length=length, slide=slide))
    return current_counts(read_committed(spark, path), length, slide).select(
        F.date_format("window_start", SECONDS).alias("window_start"),
        F.date_format("window_end", SECONDS).alias("window_end"),
        "topic",
        "records",
    )


@query(WINDOWS_SQL + """
SELECT p.topic, strftime(p.window_start, '%Y-%m-%d %H:%M:%S') AS window_start, e.props AS value
FROM placed p JOIN events e USING (event_id)
""")
def stream_window_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "window-rows")
    records = plain_feed(arrivals(spark, sf_dir, "events", "event_id"))
    _finish(spark, land_windowed_rows(records, path))
    return read_committed(spark, path).select(
        "topic", F.date_format("window_start", SECONDS).alias("window_start"), "value"
    )


@query(f"""
WITH {FEED_SQL},
placed AS (
  SELECT topic, event_id, date_trunc('day', ts) AS window_start FROM feed
  UNION ALL
  SELECT topic, event_id, date_trunc('day', ts) - INTERVAL '1 day' FROM feed
)
SELECT p.topic, strftime(p.window_start, '%Y-%m-%d_%H-%M-%S') AS window_start, e.props AS value
FROM placed p JOIN events e USING (event_id)
""")
def stream_window_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text folder per window, here of two days so that the folders stay few."""
    path = scratch_path(spark, "window-text")
    records = plain_feed(arrivals(spark, sf_dir, "events", "event_id"))
    _finish(spark, land_windows(records, path, "2 days", "1 day"))
    return read_committed(spark, path, file_format="text").select("topic", "window_start", "value")


@query("SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, props FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives twice, in any order, and is kept once."""
    path = scratch_path(spark, "deduplicated")
    once, again = (plain_feed(arrivals(spark, sf_dir, "events", "event_id", mixed=mixed)) for mixed in (True, False))
    _finish(spark, land_without_replays(once.union(again), path, "offset"))
    return read_committed(spark, path).select(
        F.col("offset").alias("event_id"), F.col("key").alias("user_id"), F.col("value").alias("props")
    )


@query(f"""
WITH {FEED_SQL},
cut AS (SELECT max(event_id) + 1 AS n FROM events)
SELECT moment, topic, event_id FROM feed, cut, (VALUES ('cut'), ('whole')) m(moment)
WHERE moment = 'whole' OR event_id * {BATCHES} // n < {BATCHES - 1}
UNION ALL
SELECT 'folder', topic, event_id FROM feed, cut WHERE topic = 'account' OR event_id * {BATCHES} // n < {BATCHES - 1}
""")
def stream_committed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that stops between two folders is not read until it has run again.

    ``cut`` is what readers find then, ``folder`` what lies in the folders, ``whole`` what is
    there after the query has started again from its checkpoint.
    """
    path, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    records = plain_feed(arrivals(spark, sf_dir, "events", "event_id")).select("topic", F.col("offset").alias("event_id"))

    def stopping(batch: DataFrame, batch_id: int) -> None:
        if batch_id < BATCHES - 1:
            write_batch(batch, batch_id, path, ["topic"])
            return
        write_batch(batch.where("topic = 'account'"), batch_id, path, ["topic"], commits=False)
        raise OSError("stopped between two folders")

    def landing(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, ["topic"])

    try:
        start(records.writeStream.foreachBatch(stopping), checkpoint).awaitTermination()
    except StreamingQueryException:
        pass
    moments = {"cut": read_committed(spark, path), "folder": spark.read.parquet(path)}
    frozen = {name: rows.select(F.lit(name).alias("moment"), "topic", "event_id") for name, rows in moments.items()}
    copies = {name: scratch_path(spark, name) for name in frozen}
    for name, rows in frozen.items():
        rows.write.parquet(copies[name])
    start(records.writeStream.foreachBatch(landing), checkpoint).awaitTermination()
    whole = read_committed(spark, path).select(F.lit("whole").alias("moment"), "topic", "event_id")
    return whole.unionByName(spark.read.parquet(copies["cut"])).unionByName(spark.read.parquet(copies["folder"]))


@query(f"""
WITH {FEED_SQL},
cut AS (SELECT max(event_id) + 1 AS n FROM events),
before AS (
  SELECT topic, part, event_id * {BATCHES} // n AS batch, event_id FROM feed, cut
  WHERE event_id * 2 < n AND NOT (event_id * 8 >= n AND event_id * 4 < n)
),
early AS (
  SELECT topic, part, min(event_id) AS lo, max(event_id) + 1 AS hi FROM before, cut
  WHERE event_id * 4 < n GROUP BY topic, part
)
SELECT topic, event_id, count(*) AS times,
  (SELECT any_value(e.hi) FROM early e WHERE e.topic = f.topic AND e.part = f.part) AS first_stop
FROM feed f GROUP BY topic, part, event_id
""")
def stream_restart_from_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events land but for a hole; a query with a new checkpoint starts at the hole.

    What landed behind the hole is read again and left out. Each event comes with how often it
    landed and the offset its topic partition was read again from.
    """
    path, ledger = scratch_path(spark, "routed"), scratch_path(spark, "ledger")
    events = table(spark, sf_dir, "events")
    n = (events.agg(F.max("event_id")).first()[0] or 0) + 1

    def land(records: DataFrame) -> None:
        _finish(spark, route_and_append(routed(records, ROUTED_FIELDS), path, ledger_path=ledger))

    half = feed(arrivals(spark, sf_dir, "events", "event_id")).where(f"offset * 2 < {n}")
    for part in (f"offset * 8 < {n}", f"offset * 4 >= {n}"):
        land(half.where(part))
    known = feed(events).select("topic", "partition").distinct()
    landed = read_committed(spark, ledger, commits_of=path)
    starts = staged_table(starting_positions(landed, known), "starts")
    again = feed(arrivals(spark, sf_dir, "events", "event_id")).join(F.broadcast(starts), ["topic", "partition"])
    land(not_landed(again.where("offset >= start_offset").drop("start_offset"), staged_table(landed, "landed")))
    times = read_committed(spark, path).groupBy("topic", "partition", F.col("offset").alias("event_id")).agg(F.count(F.lit(1)).alias("times"))
    return times.join(starts, ["topic", "partition"]).select("topic", "event_id", "times", F.col("start_offset").alias("first_stop"))
