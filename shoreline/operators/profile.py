"""Counts that describe data and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.functions.timestamps import DATE_LENGTH, MICROS_LENGTH, SECONDS_LENGTH, SENTINEL_MODE, TimestampMode


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per timestamp text column: rows, nulls and each known or unknown length.

    All columns are counted in one pass over the data.
    """
    measures = {
        "rows": lambda c: F.count(F.lit(1)),
        "nulls": lambda c: F.count_if(F.col(c).isNull()),
        "dates": lambda c: F.count_if(F.char_length(c) == DATE_LENGTH),
        "seconds": lambda c: F.count_if(F.char_length(c) == SECONDS_LENGTH),
        "micros": lambda c: F.count_if(F.char_length(c) == MICROS_LENGTH),
        "unknown": lambda c: F.count_if(
            F.col(c).isNotNull() & ~F.char_length(c).isin(DATE_LENGTH, SECONDS_LENGTH, MICROS_LENGTH)
        ),
    }
    structs = [
        F.struct(F.lit(c).alias("column_name"), *[measure(c).alias(name) for name, measure in measures.items()])
        for c in columns
    ]
    return df.agg(F.array(*structs).alias("profile")).select(F.inline("profile"))


def replaced_profile(df: DataFrame, columns: Sequence[str], mode: TimestampMode = SENTINEL_MODE) -> DataFrame:
    """One row per canonical column: rows, and rows that hold the replacement."""
    structs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(c) == mode.replacement).alias("replaced"),
        )
        for c in columns
    ]
    return df.agg(F.array(*structs).alias("profile")).select(F.inline("profile"))


def partition_profile(df: DataFrame) -> DataFrame:
    """``(partition, rows)`` of the DataFrame as it is partitioned; shows skew."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def count_report(deduplicated: DataFrame, file_name: str, source_rows: str = "_source_rows") -> DataFrame:
    """The one-row report over rows that carry their source counts."""
    return deduplicated.agg(
        F.count(F.lit(1)).alias("dedup_count"), F.coalesce(F.sum(source_rows), F.lit(0)).alias("source_count")
    ).select(
        F.lit(file_name).alias("file"),
        "dedup_count",
        "source_count",
        (F.col("source_count") - F.col("dedup_count")).alias("duplicate_count"),
    )
