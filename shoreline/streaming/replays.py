"""An index of landed keys, so that looking for replays does not read what landed.

``<path>/_keys`` has the 64-bit hash of each landed key with its event date, by month, run and
batch, which keeps the files few. A batch reads the hashes of its own dates' months, eight bytes
a key, and looks up landed records only for dates and batches that hold one of its hashes: for new records that is nothing, for a replay the batch it
repeats. The lookup compares the keys themselves, so equal hashes of different keys lose no record.

A batch writes its hashes before its records. If it fails in between, the index names a batch
that has not landed, which the lookup finds out; the other way round a replay would pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import make_folder, path_exists
from shoreline.streaming.commits import BATCH_COLUMN, RUN_COLUMN

KEYS = "_keys"
DATE_COLUMN = "event_date"
MONTH_COLUMN = "event_month"
_SCHEMA = f"{DATE_COLUMN} string, print bigint, {MONTH_COLUMN} string, {RUN_COLUMN} string, {BATCH_COLUMN} bigint"
_PLACE = [DATE_COLUMN, RUN_COLUMN, BATCH_COLUMN]


def index_path(path: str) -> str:
    return f"{path.rstrip('/')}/{KEYS}"


def key_prints(rows: DataFrame, key: str) -> DataFrame:
    """Date and hash of each key; records without a key have none, as they repeat nothing."""
    return rows.where(F.col(key).isNotNull()).select(DATE_COLUMN, F.xxhash64(key).alias("print"), _month())


def _month() -> Column:
    return F.substring(DATE_COLUMN, 1, 7).alias(MONTH_COLUMN)


def ensure_index(spark: SparkSession, path: str, landed: DataFrame, key: str) -> None:
    """Index what landed before there was an index; done once for a path."""
    done = f"{index_path(path)}/_whole"
    if not path_exists(spark, done):
        prints = landed.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("print"), _month(), *_PLACE)
        prints.write.mode("overwrite").partitionBy(MONTH_COLUMN, RUN_COLUMN, BATCH_COLUMN).parquet(index_path(path))
        make_folder(spark, done)


def of_dates(dates: list[str | None], column: str = DATE_COLUMN) -> Column:
    """Whether a row belongs to one of the dates; None stands for records without event time."""
    known = F.col(column).isin([d for d in dates if d is not None])
    return known | F.col(column).isNull() if None in dates else known


def suspects(spark: SparkSession, path: str, fresh: DataFrame, key: str, dates: list[str | None], run: str, batch_id: int) -> list[tuple]:
    """``(date, run, batch)`` of the landed batches that may hold a key of ``fresh``; not the batch at work."""
    own = (F.col(RUN_COLUMN) == run) & (F.col(BATCH_COLUMN) == batch_id)
    months = list({d and d[:7] for d in dates})
    landed = spark.read.schema(_SCHEMA).parquet(index_path(path)).where(of_dates(months, MONTH_COLUMN) & of_dates(dates) & ~own)
    new = key_prints(fresh, key).select(F.col(DATE_COLUMN).alias("_date"), F.col("print").alias("_print"))
    same = (F.col("print") == F.col("_print")) & F.col(DATE_COLUMN).eqNullSafe(F.col("_date"))
    return [tuple(place) for place in landed.join(new, same, "left_semi").select(*_PLACE).distinct().collect()]


def without_landed(fresh: DataFrame, landed: DataFrame, key: str, places: list[tuple]) -> DataFrame:
    """``fresh`` without records whose key ``landed`` has, in the batches named, for the same date."""
    if not places:
        return fresh
    dates, runs, batches = (sorted(set(values), key=str) for values in zip(*places))
    by_folder: dict[tuple, list[int]] = {}
    for date, run, batch in places:
        by_folder.setdefault((date, run), []).append(batch)
    exact = reduce(
        lambda a, b: a | b,
        (of_dates([date]) & (F.col(RUN_COLUMN) == run) & F.col(BATCH_COLUMN).isin(found) for (date, run), found in by_folder.items()),
    )
    pruned = of_dates(dates) & F.col(RUN_COLUMN).isin(runs) & F.col(BATCH_COLUMN).isin(batches)
    found = landed.where(pruned & exact).select(F.col(key).alias("_key"), F.col(DATE_COLUMN).alias("_date"))
    same = (F.col(key) == F.col("_key")) & F.col(DATE_COLUMN).eqNullSafe(F.col("_date"))
    return fresh.join(found, same, "left_anti")
