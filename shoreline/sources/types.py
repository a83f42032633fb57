"""Column types of delimited text, found in one pass.

Each kind is a test that a text can pass; one aggregate says for every column which kinds all of
its texts pass. A column gets the first kind of the order, so whole numbers are integers and a
column of whole numbers and fractions is floating point. The result is a schema to read the
files with, and to keep with a job so that later runs need no pass.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from shoreline.sources.delimited import read_delimited
from shoreline.sources.dialect import Dialect

_DATE = r"^\d{4}-\d\d-\d\d$"
_WHOLE = r"^\s*[-+]?\d+\s*$"
_NUMBER = r"(?i)^\s*[-+]?((\d+\.?\d*|\.\d+)(e[-+]?\d+)?[df]?|nan|inf(inity)?)\s*$"


def shape_of(pattern: str) -> str | None:
    """What texts of a pattern look like, where it has digits alone; a cheap look before parsing."""
    fields = re.findall(r"([A-Za-z])\1*", pattern)
    if "'" in pattern or "[" in pattern or set(fields) - set("yMdHmsS"):
        return None
    runs = re.findall(r"[A-Za-z]+|[^A-Za-z]+", pattern)
    return "^" + "".join(rf"\d{{{len(run)}}}" if run.isalpha() else re.escape(run) for run in runs) + "$"


#: Kinds in their order; a text's fitting kinds are bits in this order.
KINDS = ("int", "bigint", "double", "date", "timestamp", "boolean")


def _bits(*kinds: str) -> int:
    return sum(1 << KINDS.index(kind) for kind in kinds)


def kind_bits(text: Column, dialect: Dialect) -> Column:
    """The kinds a text is of, as bits.

    The text's shape decides which parser is asked, one per text: parsers fail by an
    exception, which takes far longer than reading.
    """
    pattern = dialect.timestamp_format
    as_time = F.try_to_timestamp(text, F.lit(pattern)) if pattern else text.try_cast("timestamp")
    time_shape = shape_of(pattern) if pattern else r"^\s*\d{4}-"
    whole = F.when(text.try_cast("int").isNotNull(), _bits("int", "bigint", "double"))
    whole = whole.when(text.try_cast("bigint").isNotNull(), _bits("bigint", "double")).otherwise(_bits("double"))
    return (
        F.when(text.rlike(_WHOLE), whole)
        .when(text.rlike(_NUMBER), F.when(text.try_cast("double").isNotNull(), _bits("double")).otherwise(0))
        .when(text.rlike(_DATE) & text.try_cast("date").isNotNull(), _bits("date", "timestamp"))
        .when(text.rlike(time_shape) if time_shape else F.lit(True), F.when(as_time.isNotNull(), _bits("timestamp")).otherwise(0))
        .when(F.lower(text).isin("true", "false"), _bits("boolean"))
        .otherwise(0)
    )


def fitting_kinds(rows: DataFrame, dialect: Dialect) -> DataFrame:
    """One row; per column the kinds that all its texts are of, null for a column without text.

    Null and empty texts fit any kind.
    """
    found = rows.agg(*[F.bit_and(F.when(F.col(name) != "", kind_bits(F.col(name), dialect))).alias(name) for name in rows.columns])

    def kinds(bits: Column) -> Column:
        return F.array_compact(F.array(*[F.when(bits.bitwiseAND(_bits(kind)) != 0, F.lit(kind)) for kind in KINDS]))

    return found.select(*[F.when(F.col(name).isNotNull(), kinds(F.col(name))).alias(name) for name in rows.columns])


def inferred_types(spark: SparkSession, path: str | list[str], dialect: Dialect) -> StructType:
    """The schema of files without header; text where no kind fits, or where there is none."""
    rows = read_delimited(spark, path, dialect.with_(infer=False))
    if not rows.columns:
        return StructType([])
    found = fitting_kinds(rows, dialect).first()
    return StructType([StructField(name, DataType.fromDDL((found[name] or ["string"])[0]), True) for name in rows.columns])
