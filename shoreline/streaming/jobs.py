"""The streaming jobs: raw landing, event routing, sliding windows and replay removal.

None keeps state between batches: what a batch needs of earlier ones it reads from their output.
Outputs are read with :func:`shoreline.streaming.commits.read_committed`, which leaves out a
batch that is being written.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from shoreline.functions.stamps import arrival_date
from shoreline.operators.events import (
    DEFAULT_ROUTE,
    EVENT_SCHEMA,
    ROUTES,
    parse_events,
    path_column,
    record_text,
    route_events,
)
from shoreline.operators.offsets import offset_ledger
from shoreline.streaming.commits import begin, committed
from shoreline.streaming.replays import MONTH_COLUMN, ensure_index, index_path, key_prints, suspects, without_landed
from shoreline.streaming.sinks import batch_fields, for_each_batch, run_identity, write_batch

# The sliding window.
WINDOW_LENGTH = "2 minutes"
WINDOW_SLIDE = "1 minute"


def land_raw(records: DataFrame, path: str, *, files: int | None = None) -> DataStreamWriter:
    """Append every record as a text line below ``topic=<topic>``."""
    lines = records.select(record_text().alias("value"), "topic")

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, ["topic"], file_format="text", files=files)

    return lines.writeStream.foreachBatch(handle)


def routed(
    records: DataFrame,
    fields: Mapping[str, str],
    *,
    schema: StructType | str = EVENT_SCHEMA,
    rules: Sequence[tuple[str, str]] = ROUTES,
    default: str = DEFAULT_ROUTE,
) -> DataFrame:
    """Topic, position, text, route and the named event fields of each record.

    Records are parsed by the whole schema, so a record's route does not depend on which
    ``fields`` are picked. ``extract_date`` is the date of arrival; see
    :func:`shoreline.functions.stamps.arrival_date`.
    """
    events = route_events(parse_events(records, schema), "event", rules, default)
    picked = [path_column(events, f"event.{path}").alias(name) for name, path in fields.items()]
    return events.select(
        "topic", "partition", "offset", "value", "route", arrival_date().alias("extract_date"), *picked
    )


def route_and_append(
    routed_records: DataFrame,
    path: str,
    *,
    ledger_path: str | None = None,
    partition_by: Sequence[str] = ("topic", "route", "extract_date"),
    files: int | None = None,
) -> DataStreamWriter:
    """Write all routes of a batch in one pass, and the offsets it held.

    The commit of the records is that of their ledger too: read it with ``commits_of=path``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if ledger_path:
            begin(batch.sparkSession, path, run_identity(batch), batch_id)
            write_batch(offset_ledger(batch), batch_id, ledger_path, ["topic"], commits=False)
        write_batch(batch, batch_id, path, partition_by, files=files)

    return routed_records.writeStream.foreachBatch(for_each_batch(handle) if ledger_path else handle)


def in_windows(
    records: DataFrame, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE, at: str = "timestamp"
) -> DataFrame:
    """Each record once per window that covers it, with the window's bounds. Keeps no state."""
    windows = records.withColumn("window", F.window(at, length, slide))
    return windows.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop(
        "window"
    )


def land_windows(
    records: DataFrame, path: str, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE
) -> DataStreamWriter:
    """One text folder per topic and window, holding the values of the records it covers.

    Made for a live stream, where a batch covers few windows. A backfill covers thousands and
    would make as many folders: use :func:`land_windowed_rows` there.
    """
    rows = in_windows(records, length, slide).select(
        F.col("value"), "topic", F.date_format("window_start", "yyyy-MM-dd_HH-mm-ss").alias("window_start")
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, ["topic", "window_start"], file_format="text")

    return rows.writeStream.foreachBatch(handle)


def land_windowed_rows(
    records: DataFrame, path: str, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE
) -> DataStreamWriter:
    """The same rows as Parquet with their window as columns, one folder per topic and day."""
    rows = in_windows(records, length, slide).select(
        "window_start",
        "window_end",
        "value",
        "topic",
        F.date_format("window_start", "yyyy-MM-dd").alias("window_date"),
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, ["topic", "window_date"])

    return rows.writeStream.foreachBatch(handle)


def keep_counts(
    records: DataFrame,
    path: str,
    *,
    length: str = WINDOW_LENGTH,
    slide: str = WINDOW_SLIDE,
    by: Sequence[str] = ("topic",),
    files: int = 1,
) -> DataStreamWriter:
    """Write each batch's records per pane; :func:`current_counts` sums panes up to windows.

    A pane is as wide as length and slide allow, so that every window is made of whole panes
    and a record is counted once, however many windows cover it. A batch's counts stand on
    their own: nothing is kept between batches, so no record is too late to be counted, and a
    batch that runs again replaces its own counts.
    """
    width = pane_width(records, length, slide)

    def handle(batch: DataFrame, batch_id: int) -> None:
        placed = batch.groupBy(F.window("timestamp", width)["start"].alias("pane_start"), *by)
        day = F.date_format("pane_start", "yyyy-MM-dd").alias("pane_date")
        counts = placed.agg(F.count(F.lit(1)).alias("records")).select("*", day)
        write_batch(counts, batch_id, path, ["pane_date"], files=files)

    return records.writeStream.foreachBatch(handle)


def pane_width(df: DataFrame, length: str, slide: str) -> str:
    """The widest pane that both a window's length and its slide are multiples of."""
    micros = ", ".join(f"unix_micros(timestamp_seconds(0) + INTERVAL '{text}')" for text in (length, slide))
    return f"{math.gcd(*df.sparkSession.sql(f'SELECT {micros}').first())} microseconds"


def current_counts(
    panes: DataFrame, length: str = WINDOW_LENGTH, slide: str = WINDOW_SLIDE, by: Sequence[str] = ("topic",)
) -> DataFrame:
    """The records of each window over all batches and runs: batches summed per pane, panes per window.

    ``length`` and ``slide`` are those the panes were made for, or multiples of the panes.
    """
    summed = panes.groupBy("pane_start", *by).agg(F.sum("records").alias("records"))
    return in_windows(summed, length, slide, "pane_start").groupBy("window_start", "window_end", *by).agg(
        F.sum("records").alias("records")
    )


def land_without_replays(
    records: DataFrame, path: str, key: str, *, at: str = "timestamp", files: int | None = None
) -> DataStreamWriter:
    """Append records whose key has not landed for the same event date; however late they are.

    Copies inside a batch are removed first, then those of which a copy landed before, found
    by an index of keys (:mod:`shoreline.streaming.replays`). What the batch itself wrote
    before a failure does not count, so it is written alike when it runs again, nor do
    batches that are not committed. A copy is a record with the same key and event date. A
    record without a key is no copy of any other: all of them stay. Two queries that run at
    the same time on one path do not see each other's open batches.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_identity(batch)
        dated = batch.withColumn("event_date", F.date_format(at, "yyyy-MM-dd"))
        alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
        fresh = dated.withColumn("_alone", alone).dropDuplicates([key, "event_date", "_alone"]).drop("_alone")
        begin(spark, path, run, batch_id)
        landed = spark.read.schema(StructType([*fresh.schema.fields, *batch_fields()])).parquet(path)
        ensure_index(spark, path, landed, key)
        dates = [row.event_date for row in dated.select("event_date").distinct().toLocalIterator()]
        places = suspects(spark, path, fresh, key, dates, run, batch_id)
        fresh = without_landed(fresh, committed(landed, path), key, places)
        write_batch(key_prints(fresh, key), batch_id, index_path(path), [MONTH_COLUMN], commits=False)
        write_batch(fresh, batch_id, path, ["event_date"], files=files)

    return records.writeStream.foreachBatch(for_each_batch(handle))
