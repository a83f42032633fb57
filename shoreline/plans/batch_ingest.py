"""One landed file to one deduplicated output with a count report."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoreline.functions.timestamps import BLANK_MODE, TimestampMode, canonical_timestamps
from shoreline.operators.dedup import latest_rows_counted
from shoreline.operators.profile import count_report
from shoreline.session import staged
from shoreline.sinks.delimited import DEFAULT_ROWS_PER_FILE, file_count, into_files, write_dated, write_delimited
from shoreline.sinks.tables import (
    COMPLETED,
    FAILED,
    IN_PROCESSING,
    STARTED,
    AuditTrail,
    append_report,
    write_report,
)
from shoreline.sources.delimited import MISFIT, read_checked, read_compressed
from shoreline.sources.dialect import APOSTROPHE_DIALECT, Dialect
from shoreline.sources.types import inferred_types

SOURCE_ROWS = "_source_rows"


@dataclass(frozen=True)
class IngestJob:
    """What to read, how to deduplicate it and where results go."""

    source: str
    target: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    time_columns: tuple[str, ...] = ()
    name: str = ""
    report: str | None = None
    audit: str | None = None
    rows_per_file: int = DEFAULT_ROWS_PER_FILE
    #: True: ``rows // rows_per_file + 1`` files (fewer if there are fewer rows), for which the rows are counted
    #: before they are written. False: no file exceeds ``rows_per_file``, and rows go to
    #: the target in the pass that deduplicates them.
    exact_files: bool = False
    #: Write below ``extract_date=<stamp>`` and keep other extracts.
    stamp: str | None = None
    #: Spread the rows over so many tasks before deduplicating. For files that one task each
    #: must read (gzip, multi-line records); others are split anyway.
    spread: int | None = None
    #: Read large files with multi-line records in splits: three passes by many tasks instead of one
    #: pass by one task per file.
    in_splits: bool = False
    dialect: Dialect = APOSTROPHE_DIALECT
    #: Fields a record has; None takes the first line's width.
    width: int | None = None
    #: Types of an inferring dialect's columns, as found before; None finds them in one pass.
    schema: StructType | None = None
    #: Where records of another width go, as Parquet with their text. None: they fail the job.
    quarantine: str | None = None
    #: One table that the reports of many jobs are added to.
    reports: str | None = None
    timestamps: TimestampMode = BLANK_MODE
    casts: Mapping[str, str] | None = None

    @staticmethod
    def from_properties(properties: Mapping[str, str], **settings) -> IngestJob:
        """A job from the keys of a descriptor; ``settings`` fill the other fields."""
        dialect = settings.pop("dialect", APOSTROPHE_DIALECT)
        if properties.get("MVAL"):
            dialect = dialect.with_(multiline=properties["MVAL"].strip().lower() == "true")
        if properties.get("PART_CAL_VAL"):
            settings["rows_per_file"] = int(properties["PART_CAL_VAL"])
        if properties.get("REPORT_FILE_PATH"):
            settings["report"] = _path(properties, "REPORT_FILE")
        return IngestJob(
            source=_path(properties, "SRC_FILE"),
            target=_path({"TAR_FILE_NM": _source_name(properties), **_filled(properties)}, "TAR_FILE"),
            keys=_names(properties["Dedup_Key"]),
            order=_names(properties["Dedup_order_Key"]),
            time_columns=_names(properties.get("TIME_COLS") or ""),
            name=properties["SRC_FILE_NM"],
            dialect=dialect,
            **settings,
        )


def jobs_from(descriptors: DataFrame, **settings) -> list[IngestJob]:
    """The jobs of a descriptor table, one row each; see ``sources.properties.job_properties``."""
    return [IngestJob.from_properties(row.asDict(), **settings) for row in descriptors.toLocalIterator()]


def _filled(properties: Mapping[str, str]) -> dict[str, str]:
    return {key: value for key, value in properties.items() if value}


def _source_name(properties: Mapping[str, str]) -> str:
    """What an output without a name of its own is called: its source's folder and name, so that jobs never share one."""
    folder = re.sub(r"^\w+:/*", "", properties.get("SRC_FILE_PATH") or "").strip("/")
    return "/".join(part for part in (folder, properties["SRC_FILE_NM"]) if part)


def _path(properties: Mapping[str, str], prefix: str) -> str:
    parts = [properties.get(f"{prefix}_PATH"), properties.get(f"{prefix}_NM")]
    return "/".join(part for part in parts if part)


def _names(text: str) -> tuple[str, ...]:
    return tuple(name.strip() for name in text.split(",") if name.strip())


def deduplicated(spark: SparkSession, job: IngestJob) -> DataFrame:
    """The job's rows with their source counts: one scan, one shuffle, nothing run yet."""
    return _deduplicated(open_source(spark, job), job)


def _deduplicated(source: DataFrame, job: IngestJob) -> DataFrame:
    clean = canonical_timestamps(_fitting(source, job), job.time_columns, job.timestamps)
    return latest_rows_counted(clean, job.keys, job.order, casts=job.casts, count_as=SOURCE_ROWS)


def open_source(spark: SparkSession, job: IngestJob) -> DataFrame:
    """The source, opened once per job: what that takes, a look at the first line or a pass for the types, is not repeated."""
    if job.dialect.infer:
        schema = job.schema or inferred_types(spark, job.source, job.dialect)
        if not len(schema):
            return spark.createDataFrame([], schema)
        return read_compressed(spark, job.source, job.dialect.with_(infer=False), schema, job.spread)
    source = read_checked(spark, job.source, job.dialect, job.width, job.in_splits)
    return source.repartition(job.spread) if job.spread else source


def _fitting(source: DataFrame, job: IngestJob) -> DataFrame:
    """Records of the expected width; the others fail the job unless they have a place to go."""
    if MISFIT not in source.columns:
        return source
    if job.quarantine:
        return source.where(F.col(MISFIT).isNull()).drop(MISFIT)
    message = F.concat(F.lit("a record has another width than expected: "), F.col(MISFIT))
    checked = F.when(F.col(MISFIT).isNull(), F.col("_c0")).otherwise(F.raise_error(message).cast("string"))
    return source.withColumn("_c0", checked).drop(MISFIT)


def _keep_misfits(source: DataFrame, job: IngestJob) -> None:
    """The quarantine is a pass of its own over the source, for jobs that have one."""
    if job.quarantine and MISFIT in source.columns:
        kept = source.where(F.col(MISFIT).isNotNull()).select(F.col(MISFIT).alias("record"), F.col("_c0").alias("first_field"))
        kept.write.mode("overwrite").parquet(job.quarantine)


def run_ingest(spark: SparkSession, job: IngestJob) -> DataFrame:
    """Run one job and return its report.

    A failure leaves a ``failed`` row in the audit trail and is raised.
    """
    trail = AuditTrail(spark, job.audit, job.name)
    trail.note(STARTED)
    try:
        trail.note(IN_PROCESSING)
        source = open_source(spark, job)
        if source.columns:
            _keep_misfits(source, job)
            rows = _deduplicated(source, job)
            report = _write_sized(rows, job) if job.exact_files else _write_through(rows, job)
        else:
            report = _write_nothing(spark, job)
        if job.report:
            write_report(report, job.report)
        if job.reports:
            append_report(report, job.reports)
    except Exception as failure:
        trail.note(FAILED, str(failure))
        raise
    trail.note(COMPLETED)
    return report


def _write_nothing(spark: SparkSession, job: IngestJob) -> DataFrame:
    """A source without a line: what an earlier run wrote is replaced as by one with rows."""
    if job.quarantine:
        spark.createDataFrame([], "record string, first_field string").write.mode("overwrite").parquet(job.quarantine)
    _write(spark.createDataFrame([], "_c0 string"), job)
    return spark.createDataFrame([(job.name, 0, 0, 0)], REPORT_SCHEMA)


def _write_sized(rows: DataFrame, job: IngestJob) -> DataFrame:
    with staged(rows, "dedup") as result:
        counts = count_report(result, job.name, SOURCE_ROWS).first()
        files = file_count(counts["dedup_count"], job.rows_per_file)
        _write(into_files(result.drop(SOURCE_ROWS), files), job)
    return rows.sparkSession.createDataFrame([counts], REPORT_SCHEMA)


REPORT_SCHEMA = "file string, dedup_count bigint, source_count bigint, duplicate_count bigint"


def _write_through(rows: DataFrame, job: IngestJob) -> DataFrame:
    """Count in the tasks that write.

    They are the last stage of the job, where Spark takes one result per partition however
    often a task runs, so the counts stay exact when executors are lost.
    """
    counts = Observation()
    observed = rows.observe(counts, F.count(F.lit(1)).alias("dedup"), F.sum(SOURCE_ROWS).alias("source"))
    _write(observed.drop(SOURCE_ROWS), job, max_rows_per_file=job.rows_per_file)
    dedup, source = counts.get["dedup"], counts.get["source"] or 0
    return rows.sparkSession.createDataFrame([(job.name, dedup, source, source - dedup)], REPORT_SCHEMA)


def _write(rows: DataFrame, job: IngestJob, max_rows_per_file: int | None = None) -> None:
    if job.stamp:
        write_dated(rows, job.target, job.stamp, job.dialect, max_rows_per_file=max_rows_per_file)
    else:
        write_delimited(rows, job.target, job.dialect, max_rows_per_file=max_rows_per_file)


def run_all(
    spark: SparkSession,
    jobs: Iterable[IngestJob],
    *,
    at_once: int = 8,
    run: Callable[[SparkSession, IngestJob], DataFrame] = run_ingest,
) -> list[tuple[IngestJob, DataFrame | Exception]]:
    """Run jobs of one application, several at a time; a failing job stops no other one.

    Each job comes back with its report or with what made it fail. Jobs that would write to
    the same place are refused before any of them runs.

    Each job has a scheduler pool of its own. With ``spark.scheduler.mode`` FAIR, small files
    then do not wait for a large one.
    """

    def attempt(job: IngestJob) -> DataFrame | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", job.name)
        try:
            return run(spark, job)
        except Exception as failure:
            return failure

    batch = list(jobs)
    places = Counter((job.target, job.stamp) for job in batch)
    shared = sorted(target for (target, _), count in places.items() if count > 1)
    if shared:
        raise ValueError(f"several jobs write to {', '.join(shared)}")
    with ThreadPoolExecutor(at_once) as pool:
        return list(zip(batch, pool.map(inheritable_thread_target(spark)(attempt), batch)))
