"""Typed tables, count reports and the audit trail."""

from __future__ import annotations

import json
import uuid
import warnings
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoreline.session import replace_text_file

# What a run can report about itself.
STARTED = "Started"
IN_PROCESSING = "InProcessing"
COMPLETED = "Completed"
FAILED = "failed"

AUDIT_SCHEMA = "job string, status string, at timestamp, error string"


def write_report(report: DataFrame, path: str) -> None:
    """Replace the headerless report of a job."""
    report.write.mode("overwrite").option("header", False).csv(path)


def append_report(report: DataFrame, path: str) -> None:
    """Add to one report table over many jobs."""
    _append(report, path)


def _append(rows: DataFrame, path: str) -> None:
    """Write to a folder of its own below ``path``.

    Jobs that append to one folder at the same time would share its temporary files and
    remove each other's.
    """
    rows.coalesce(1).write.parquet(f"{path.rstrip('/')}/entry={uuid.uuid4().hex}")


class AuditTrail:
    """The statuses of one run of a job, in one file that grows with each.

    Without a ``path`` nothing is kept. What goes wrong here is a warning: it must not decide
    over a job.
    """

    def __init__(self, spark: SparkSession, path: str | None, job: str):
        self.spark, self.job, self.lines = spark, job, []
        self.file = path and f"{path.rstrip('/')}/{uuid.uuid4().hex}.json"

    def note(self, status: str, error: str | None = None) -> None:
        if not self.file:
            return
        at = datetime.now(timezone.utc).isoformat(timespec="microseconds")
        self.lines.append(json.dumps({"job": self.job, "status": status, "at": at, "error": error}))
        try:
            replace_text_file(self.spark, self.file, "\n".join(self.lines) + "\n")
        except Exception as failure:
            warnings.warn(f"audit row not written to {self.file}: {failure}", stacklevel=2)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All rows of an audit trail."""
    return spark.read.schema(AUDIT_SCHEMA).json(path)


def typed_columns(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Name and cast positional columns by a schema of the same width; misfits become null."""
    return df.select(*[typed.alias(name) for name, _, typed in _typed(df, schema)])


def _typed(df: DataFrame, schema: StructType | str) -> list[tuple]:
    struct = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if len(struct) != len(df.columns):
        raise ValueError(f"the schema has {len(struct)} columns, the data {len(df.columns)}")
    return [(field.name, F.col(have), F.col(have).try_cast(field.dataType)) for have, field in zip(df.columns, struct)]


def load_table(df: DataFrame, table: str, schema: StructType | str, path: str | None = None) -> dict[str, int]:
    """Drop the table and create it anew as Parquet, holding ``df`` with the schema's types.

    Returns per column how many values became null because they do not fit its type, counted
    by the tasks that write.
    """
    columns = _typed(df, schema)
    lost, misfits = [f"_lost_{i}" for i in range(len(columns))], Observation()
    marked = df.select(
        *[typed.alias(name) for name, _, typed in columns],
        *[(have.isNotNull() & typed.isNull()).alias(mark) for mark, (_, have, typed) in zip(lost, columns)],
    )
    counted = marked.observe(misfits, *[F.count_if(mark).alias(mark) for mark in lost]).drop(*lost)
    writer = counted.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return {name: misfits.get[mark] for mark, (name, _, _) in zip(lost, columns)}
