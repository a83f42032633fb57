"""Delimited output: overwrite, dated folders and a file count that follows the row count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.sources.dialect import BEL_DIALECT, Dialect

# Fixed value: rows per output file where a job names none.
DEFAULT_ROWS_PER_FILE = 10_000_000


def write_delimited(
    df: DataFrame,
    path: str,
    dialect: Dialect = BEL_DIALECT,
    *,
    max_rows_per_file: int | None = None,
    compression: str | None = None,
) -> None:
    """Replace what is at ``path``.

    A dialect without quotes cannot hold every text: a value with a separator or a line end
    fails the job instead of being written as something else.
    """
    if not dialect.quote:
        df = _refusing(df, [dialect.sep, dialect.record_sep or "\n", "\r"])
    writer = df.write.mode("overwrite").options(**dialect.write_options())
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)


def _refusing(df: DataFrame, parts: list[str]) -> DataFrame:
    def checked(name: str) -> Column:
        found = reduce(lambda a, b: a | b, (F.contains(F.col(f"`{name}`"), F.lit(part)) for part in parts))
        message = F.lit(f"column {name} holds a separator or line end, which needs a dialect with quotes")
        return F.when(found, F.raise_error(message).cast("string")).otherwise(F.col(f"`{name}`")).alias(name)

    return df.select(*[checked(name) if kind == "string" else F.col(f"`{name}`") for name, kind in df.dtypes])


def write_dated(
    df: DataFrame,
    path: str,
    stamp: str,
    dialect: Dialect = BEL_DIALECT,
    *,
    max_rows_per_file: int | None = None,
) -> None:
    """Write below ``extract_date=<stamp>``, leaving other extracts in place.

    Running again with the same stamp replaces that extract, also by an empty one.
    """
    write_delimited(df, f"{path.rstrip('/')}/extract_date={stamp}", dialect, max_rows_per_file=max_rows_per_file)


def file_count(rows: int, rows_per_file: int = DEFAULT_ROWS_PER_FILE) -> int:
    """A full multiple gets one more file, and no rows still get one."""
    return rows // rows_per_file + 1


def into_files(df: DataFrame, files: int) -> DataFrame:
    """``files`` partitions: merged without a shuffle where there are enough.

    Spark writes no file for an empty partition, so fewer rows than files make fewer files.
    """
    return df.coalesce(files) if df.rdd.getNumPartitions() >= files else df.repartition(files)
