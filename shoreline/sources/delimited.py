"""Positional delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from shoreline.sources.dialect import BEL_DIALECT, Dialect
from shoreline.sources.multiline import read_multiline

#: Column that holds records of another width than expected.
MISFIT = "_misfit"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    dialect: Dialect = BEL_DIALECT,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read files without header as ``_c0 .. _cN``.

    Fields are trimmed and an empty field is null. Without ``schema`` the column count comes
    from the first line and every column is a string; with ``dialect.infer`` Spark reads the
    data once more to find types, which a given ``schema`` avoids.
    """
    reader = spark.read.options(**dialect.read_options())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    dialect: Dialect = BEL_DIALECT,
    width: int | None = None,
    in_splits: bool = False,
) -> DataFrame:
    """Text columns ``_c0 .. _cN`` and ``_misfit``: a record's whole text where its width is another.

    Without ``width`` the first line's is expected; an empty source then has no columns. A
    record that is wider or narrower is never cut or filled silently: its ``_misfit`` says so.
    ``in_splits`` reads each file with multi-line records by several tasks.
    """
    if width is None:
        width = len(read_delimited(spark, path, dialect).columns)
    if not width:
        return spark.createDataFrame([], StructType([]))
    schema = StructType([*positional_schema(width).fields, StructField(MISFIT, StringType(), True)])
    if dialect.multiline and in_splits:
        return read_multiline(spark, path, dialect, schema, columnNameOfCorruptRecord=MISFIT, mode="PERMISSIVE")
    options = {**dialect.read_options(), "columnNameOfCorruptRecord": MISFIT, "columnPruning": "false"}
    return spark.read.options(**options).schema(schema).csv(path)


def read_compressed(
    spark: SparkSession,
    path: str | list[str],
    dialect: Dialect = BEL_DIALECT,
    schema: StructType | str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Read files whose suffix names a codec (``.gz``, ``.bz2``, ...).

    A gzip file is one task, whatever its size. ``partitions`` spreads its rows before
    costly work; leave it out where the next operator shuffles anyway.
    """
    df = read_delimited(spark, path, dialect, schema)
    return df.repartition(partitions) if partitions else df


def positional_schema(width: int) -> StructType:
    """``_c0 .. _cN`` as strings, to read without looking at the data first."""
    return StructType([StructField(f"_c{i}", StringType(), True) for i in range(width)])


def schema_from_names(names: str, separator: str = " ") -> StructType:
    """Nullable string fields from a list of names in one text."""
    return StructType([StructField(name, StringType(), True) for name in names.split(separator) if name])
