"""Sinks that write a micro-batch again without duplicating it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField

from shoreline.streaming.commits import BATCH_COLUMN, DIRECT, RUN_COLUMN, begin, commit


def run_identity(batch: DataFrame) -> str:
    """The id of the streaming query at work, which its checkpoint keeps over restarts.

    A batch handed over by hand, outside any stream, has none and counts as ``direct``.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def batch_fields() -> list[StructField]:
    """The columns that :func:`write_batch` adds."""
    return [StructField(RUN_COLUMN, StringType()), StructField(BATCH_COLUMN, LongType())]


def write_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    partition_by: Sequence[str],
    *,
    file_format: str = "parquet",
    files: int | None = None,
    commits: bool = True,
) -> None:
    """Write below ``<partition columns>/run_id=<id>/batch_id=<n>``, replacing what that batch wrote.

    A batch that runs again after a failure reads the same records, so it replaces its own
    folders and no others. A query with another checkpoint counts its batches from 0 again
    but has another id: it adds to what is there. That needs partition columns that do not change between runs:
    take dates from the record or from the streaming plan, not from the clock in here.

    When all of it is written the batch is committed, see :mod:`shoreline.streaming.commits`;
    ``commits=False`` leaves that to the caller, for a path that shares another one's commit.

    Rows are rebalanced by partition column: small ones share a task and a large one is
    split, so a topic with most of the records takes several files. That is up to AQE, which
    Spark turns off in stateful streams; there, tasks write what they hold. ``files`` spreads
    each partition over at most so many tasks and files instead; 1 makes a single file.
    """
    spark, run = batch.sparkSession, run_identity(batch)
    columns = [*partition_by, RUN_COLUMN, BATCH_COLUMN]
    keyed = batch.withColumns({RUN_COLUMN: F.lit(run), BATCH_COLUMN: F.lit(batch_id)})
    if files:
        laid_out = keyed.repartition(*partition_by, F.pmod(F.xxhash64(*batch.columns), F.lit(files)))
    elif spark.conf.get("spark.sql.adaptive.enabled") == "true":
        laid_out = keyed.hint("rebalance", *partition_by)
    else:
        laid_out = keyed
    if commits:
        begin(spark, path, run, batch_id)
    (
        laid_out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .format(file_format)
        .save(path)
    )
    if commits:
        commit(spark, path, run, batch_id)


def for_each_batch(handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For handlers that use a batch more than once: keep it meanwhile, and skip empty ones.

    What is kept is bounded by the source's limit per trigger; a lost executor's share is
    read again from the source. A handler that writes once needs neither: it reads the
    source once, and an empty batch replaces nothing.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                handle(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def start(
    writer: DataStreamWriter, checkpoint: str, *, name: str | None = None, every_seconds: int | None = None
) -> StreamingQuery:
    """Start a query, every so many seconds or once over everything available.

    Spark records a batch in the checkpoint only after its output is written.
    """
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": f"{every_seconds} seconds"} if every_seconds else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def preview(stream: DataFrame, rows: int = 10) -> DataStreamWriter:
    """Print the first rows of every batch."""
    return stream.writeStream.format("console").option("numRows", rows).option("truncate", False)
