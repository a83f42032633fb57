"""What has landed: an inventory of data, schema and stats files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.sources.listing import listed

# Name patterns of the landed kinds.
LANDED_KINDS = {"data": "*data.dsv", "schema": "*.schema", "stats": "*.stats"}


def list_landed(
    spark: SparkSession, root: str | list[str], kinds: Mapping[str, str] = LANDED_KINDS
) -> DataFrame:
    """``(path, kind, length, modified, zero_byte)`` for every landed file below ``root``.

    Contents are never read. Spark's file sources pass over empty files and over names that
    begin with ``_`` or ``.``, so the names come from the file system itself, listed by tasks.
    """
    found = listed(spark, [root] if isinstance(root, str) else root)
    return found.withColumn("path", plain_path("path")).select(
        "path",
        landed_kind("path", kinds).alias("kind"),
        "length",
        F.when(F.col("length") > 0, F.timestamp_millis("at")).alias("modified"),
        (F.col("length") == 0).alias("zero_byte"),
    ).where("kind IS NOT NULL")


def landed_kind(path: Column | str, kinds: Mapping[str, str] = LANDED_KINDS) -> Column:
    """The kind whose name pattern (``*`` and literal text) the path ends with."""
    column = F.col(path) if isinstance(path, str) else path
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(kinds.items()):
        like = pattern.replace("_", r"\_").replace("*", "%")
        kind = F.when(column.like(like), F.lit(name)).otherwise(kind)
    return kind


def plain_path(path: Column | str) -> Column:
    """Local paths come as ``file:/x`` or ``file:///x``; both become ``/x``."""
    return F.regexp_replace(path, "^file:(//)?", "")
