"""From landed files to job descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoreline.functions.stamps import base_name, dir_name, joined_path
from shoreline.session import scratch_path

# How companion names are formed from a data file's name.
SCHEMA_PREFIX = "PROD4."
SCHEMA_SUFFIX = ".schema"
STATS_SUFFIX = ".stats"
TABLE_FROM_TOKEN = 3
TOKENS_AFTER_TABLE = 4
TABLE_ID_SUFFIX = "00"


def derive_names(files: DataFrame) -> DataFrame:
    """Add file, table, schema and stats names to rows with a ``path``.

    A name has ``_``-separated tokens; the table name lies between the leading two and the
    trailing four. A name with fewer tokens names no table, hence no schema file.
    """
    tokens = F.split("file_name", "_")
    table_length = F.size(tokens) - (TABLE_FROM_TOKEN - 1) - TOKENS_AFTER_TABLE
    table = F.when(
        table_length > 0, F.array_join(F.slice(tokens, TABLE_FROM_TOKEN, F.greatest(table_length, F.lit(0))), "_")
    )
    stem = F.array_join(F.slice(tokens, 1, F.size(tokens) - 1), "_")
    return (
        files.withColumns({"file_name": base_name("path"), "folder": dir_name("path")})
        .withColumns({"table_name": table, "stats_name": F.concat(stem, F.lit(STATS_SUFFIX))})
        .withColumn("schema_name", F.concat(F.lit(SCHEMA_PREFIX), "table_name", F.lit(SCHEMA_SUFFIX)))
    )


def number_files(files: DataFrame) -> DataFrame:
    """Add ``tbl_id``: the file's place in path order, followed by ``00``.

    Places come from the sizes of the range-sorted partitions, so no task sees all files, as
    the one of an unpartitioned window would. The rows are written once between; only a count
    per partition is brought together.
    """
    spark = files.sparkSession
    path = scratch_path(spark, "numbered")
    ranged = files.repartitionByRange("path").sortWithinPartitions("path").withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    counts = rows.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(upto), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("path")) + F.col("_before")
    numbered = rows.join(F.broadcast(counts.drop("count")), "_part").withColumn("_place", place)
    return numbered.withColumn("tbl_id", F.concat(F.col("_place").cast("string"), F.lit(TABLE_ID_SUFFIX))).drop(
        "_place", "_part", "_before"
    )


def match_companions(landed: DataFrame) -> DataFrame:
    """Data files with ``has_schema`` and ``has_stats``: whether each expected partner landed.

    ``landed`` is the inventory of :func:`shoreline.sources.landing.list_landed`. A partner
    lies in the data file's own folder. A name too short to name a table expects no schema.
    """
    data = derive_names(landed.filter(F.col("kind") == "data"))
    for kind in ("schema", "stats"):
        partners = (
            landed.filter(F.col("kind") == kind)
            .select(dir_name("path").alias("folder"), base_name("path").alias(f"{kind}_name"))
            .distinct()
            .withColumn(f"has_{kind}", F.lit(True))
        )
        data = data.join(partners, ["folder", f"{kind}_name"], "left").withColumn(
            f"has_{kind}", F.coalesce(f"has_{kind}", F.lit(False))
        )
    return data


def job_table(data_files: DataFrame, source_path: str | None = None, target_path: str | None = None) -> DataFrame:
    """One job description per data file, in the columns of a descriptor.

    Without ``source_path`` a file is read where it landed.
    """
    source = F.lit(source_path) if source_path is not None else F.col("folder")
    return number_files(data_files).select(
        "tbl_id",
        F.col("file_name").alias("SRC_FILE_NM"),
        F.col("schema_name").alias("SRC_FILE_SCHEMA_NM"),
        F.col("stats_name").alias("SRC_FILE_STATS_NM"),
        F.lit(target_path).cast("string").alias("TAR_FILE_PATH"),
        source.alias("SRC_FILE_PATH"),
        F.col("table_name").alias("TBL_NAME"),
        joined_path(source, "file_name").alias("source_file"),
    )


def with_settings(jobs: DataFrame, settings: DataFrame) -> DataFrame:
    """Job descriptions with the settings of their tables, ready for ``batch_ingest.jobs_from``.

    ``settings`` has ``TBL_NAME`` and any descriptor columns (``Dedup_Key``, ``TIME_COLS``, ...).
    Of columns that both have, the settings' value counts where it is given. A file whose
    table has no settings has no keys to deduplicate by: :func:`without_settings` has these. Two
    settings for one table would make two jobs with one target and are an error.
    """
    double = settings.where("TBL_NAME IS NOT NULL").groupBy("TBL_NAME").count().where("count > 1").orderBy("TBL_NAME").take(3)
    if double:
        raise ValueError(f"several settings for {', '.join(row.TBL_NAME for row in double)}")
    named = settings.select("TBL_NAME", *[F.col(c).alias(f"_set_{c}") for c in settings.columns if c != "TBL_NAME"])
    both = jobs.join(named, "TBL_NAME")
    merged = [F.coalesce(F.col(f"_set_{c}"), F.col(c)).alias(c) if c in settings.columns and c != "TBL_NAME" else F.col(c) for c in jobs.columns]
    added = [F.col(f"_set_{c}").alias(c) for c in settings.columns if c not in jobs.columns]
    return both.select(*merged, *added)


def without_settings(jobs: DataFrame, settings: DataFrame) -> DataFrame:
    """Job descriptions of files that :func:`with_settings` leaves out: no settings know their table, or no table is named."""
    return jobs.join(settings.select("TBL_NAME"), "TBL_NAME", "left_anti").select(*jobs.columns)
