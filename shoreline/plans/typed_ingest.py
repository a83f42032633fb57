"""A compressed or plain file with inferred or declared types to a dated extract."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shoreline.sinks.delimited import write_dated
from shoreline.sinks.tables import COMPLETED, FAILED, IN_PROCESSING, STARTED, AuditTrail, load_table
from shoreline.sources.delimited import read_compressed
from shoreline.sources.dialect import TYPED_DIALECT, Dialect
from shoreline.sources.schema_files import read_schema_files, schema_ddl
from shoreline.sources.types import inferred_types


def run_typed_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    stamp: str | None = None,
    dialect: Dialect = TYPED_DIALECT,
    schema: StructType | str | None = None,
    partitions: int | None = None,
    audit: str | None = None,
) -> DataFrame:
    """Read, type and write one extract; returns the rows as read.

    A declared ``schema`` spares the one pass over the data that finding types takes.
    ``partitions`` spreads the rows of a codec that cannot be split.
    """

    trail = AuditTrail(spark, audit, source)
    trail.note(STARTED)
    try:
        trail.note(IN_PROCESSING)
        plain = dialect.with_(infer=False)
        if dialect.infer and schema is None:
            schema = inferred_types(spark, source, dialect)
        rows = read_compressed(spark, source, plain, schema, partitions)
        write_dated(rows, target, stamp or f"{datetime.now(timezone.utc):%Y-%m-%d_%H_%M_%S}", plain)
    except Exception as failure:
        trail.note(FAILED, str(failure))
        raise
    trail.note(COMPLETED)
    return rows


def load_by_schema_file(
    spark: SparkSession,
    rows: DataFrame,
    schema_file: str,
    table: str,
    path: str | None = None,
) -> tuple[str, dict[str, int]]:
    """Create ``table`` from positional rows with the columns a schema file declares.

    Returns the DDL, one short text, and per column how many values did not fit its type.
    """
    found = schema_ddl(read_schema_files(spark, schema_file)).take(2)
    if len(found) != 1:
        raise ValueError(f"{schema_file} names {'no schema file' if not found else 'several schema files'}, one is needed")
    ddl = found[0]["ddl"]
    return ddl, load_table(rows, table, ddl, path)
