"""Job descriptors written as ``key<separator>value`` lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions.stamps import base_name

# Keys a job descriptor may hold.
JOB_KEYS = (
    "SRC_FILE_PATH",
    "SRC_FILE_NM",
    "SRC_FILE_SCHEMA_NM",
    "SRC_FILE_STATS_NM",
    "TAR_FILE_PATH",
    "TAR_FILE_NM",
    "REPORT_FILE_PATH",
    "REPORT_FILE_NM",
    "TBL_NAME",
    "TIME_COLS",
    "Dedup_Key",
    "Dedup_order_Key",
    "MVAL",
    "PART_CAL_VAL",
    "tbl_id",
)


def read_descriptors(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row ``(job, text)`` per descriptor file; the job is the file's name."""
    files = spark.read.text(path, wholetext=True)
    return files.select(base_name(F.col("_metadata.file_path")).alias("job"), F.col("value").alias("text"))


def property_lines(descriptors: DataFrame, separator: str = "=") -> DataFrame:
    """``(job, line, key, value)``, one row per line that holds a property."""
    rows = descriptors.select("job", F.explode_outer(_properties("text", separator)).alias("property"))
    return rows.filter(F.col("property").isNotNull()).select("job", "property.*")


def job_properties(descriptors: DataFrame, separator: str = "=", keys: Sequence[str] = JOB_KEYS) -> DataFrame:
    """One row per job with a column per key; the last of repeated keys wins.

    ``properties`` is the map of all pairs, also of those that ``keys`` does not list.
    A descriptor is one row already, so its properties need no shuffle to come together.
    """
    properties = descriptors.withColumn("pairs", _properties("text", separator))

    def last(key: str) -> Column:
        found = F.filter("pairs", lambda p: p["key"] == key)
        return F.try_element_at(found, F.lit(-1))["value"].alias(key)

    names = F.array_distinct(F.transform("pairs", lambda p: p["key"]))
    values = F.transform(
        names, lambda name: F.element_at(F.filter("pairs", lambda p: p["key"] == name), F.lit(-1))["value"]
    )
    return properties.select("job", *map(last, keys), F.map_from_arrays(names, values).alias("properties"))


def _properties(text: Column | str, separator: str) -> Column:
    """Only the first separator of a line splits it, so a value may hold it or be empty.

    Lines without a separator carry no property.
    """
    lines = F.transform(
        F.split(text, r"\r?\n"),
        lambda line, place: F.struct(place.alias("line"), F.split(line, f"\\Q{separator}\\E", 2).alias("pair")),
    )
    return F.transform(
        F.filter(lines, lambda entry: F.size(entry["pair"]) == 2),
        lambda entry: F.struct(
            entry["line"].alias("line"),
            F.trim(entry["pair"][0]).alias("key"),
            F.trim(entry["pair"][1]).alias("value"),
        ),
    )
