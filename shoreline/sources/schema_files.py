"""Column definitions from the schema file beside a data file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions.schematypes import ddl_type
from shoreline.functions.stamps import base_name

# Fixed value.
HEADER_LINES = 3


def read_schema_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(schema_file, text)``, one row per file; schema files are a few lines long."""
    files = spark.read.text(path, wholetext=True)
    return files.select(base_name(F.col("_metadata.file_path")).alias("schema_file"), F.col("value").alias("text"))


def schema_columns(files: DataFrame) -> DataFrame:
    """``(schema_file, position, column_name, type)``, one row per column.

    ``position`` counts columns from 0, like the names of a positional scan.
    """
    columns = files.select("schema_file", F.posexplode(_definitions("text")).alias("position", "definition"))
    return columns.select("schema_file", "position", "definition.column_name", "definition.type")


def schema_ddl(files: DataFrame) -> DataFrame:
    """``(schema_file, ddl)``, one DDL text per file in column order."""
    fields = F.transform(
        _definitions("text"), lambda d: F.concat(F.lit("`"), d["column_name"], F.lit("` "), d["type"])
    )
    return files.select("schema_file", F.array_join(fields, ", ").alias("ddl"))


def _definitions(text: Column | str) -> Column:
    """Header lines and lines with a closing bracket hold no column; others are ``name: type;``."""
    lines = F.split(text, r"\r?\n")
    lines = F.slice(lines, HEADER_LINES + 1, F.size(lines))
    entries = F.filter(lines, lambda line: ~F.contains(line, F.lit(")")) & F.contains(line, F.lit(":")))
    return F.transform(entries, _definition)


def _definition(line: Column) -> Column:
    parts = F.split(line, ":")
    return F.struct(
        F.trim(parts[0]).alias("column_name"),
        ddl_type(F.replace(F.trim(parts[1]), F.lit(";"), F.lit(""))).alias("type"),
    )
