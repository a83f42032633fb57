"""Ranking within keys, and the latest row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: int = 1,
    *,
    casts: Mapping[str, str] | None = None,
    into: str = "row_number",
) -> DataFrame:
    """The ``first`` rows of each key, highest order values first, numbered from 1.

    Null keys form one group and null order values come last. ``casts`` compares an order
    column as another type (text puts "9" above "10"). All other columns decide between
    equal order values, so the result depends on the data alone and a task that runs again
    finds the same rows.

    Spark turns the filter into a group limit on both sides of the shuffle: every map task
    sends at most ``first`` rows per key, so a key that holds a third of all rows costs its
    reducer that many rows per map task.
    """
    ranking = [value.desc() for value in _ranking(df, keys, order, casts).values()]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn(into, F.row_number().over(window)).filter(F.col(into) <= first)


def latest_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, casts: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per key, the one :func:`number_rows` puts first."""
    return number_rows(df, keys, order, casts=casts, into="_row_number").drop("_row_number")


def latest_rows_counted(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    casts: Mapping[str, str] | None = None,
    count_as: str = "_source_rows",
) -> DataFrame:
    """:func:`latest_rows` with the number of source rows behind each key.

    The sum of that column is the source count, found in the pass that removes the
    duplicates. It travels through the shuffle as data, so that map tasks which run again
    after a lost executor cannot count twice, as a metric collected on their side would.
    Map tasks combine the rows of a key before the shuffle, as in :func:`latest_rows`.
    """
    ranking = _ranking(df, keys, order, casts)
    contest = F.struct(*[value.alias(name) for name, value in ranking.items()])
    if all(name in ranking and not _unordered(df.schema[name].dataType) for name in df.columns if name not in keys):
        # The contest holds every other column, so its winner is the row.
        best = F.max(contest)
    else:
        best = F.max_by(F.struct(*[name for name in df.columns if name not in keys]), contest)
    grouped = df.groupBy(*keys).agg(best.alias("_best"), F.count(F.lit(1)).alias(count_as))
    columns = [F.col(name) if name in keys else F.col("_best").getField(name).alias(name) for name in df.columns]
    return grouped.select(*columns, count_as)


def _ranking(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], casts: Mapping[str, str] | None
) -> dict[str, Column]:
    """What rows are compared by, by name: order columns first, then every other column."""
    casts = casts or {}
    ranking = {f"_cast_{n}" if n in casts else n: F.col(n).try_cast(casts[n]) if n in casts else F.col(n) for n in order}
    for name in df.columns:
        if name not in keys and name not in ranking:
            unordered = _unordered(df.schema[name].dataType)
            ranking[name] = F.to_json(F.struct(name)) if unordered else F.col(name)
    return ranking


def _unordered(data_type: DataType) -> bool:
    """Whether Spark cannot compare values of this type."""
    if isinstance(data_type, (MapType, VariantType)):
        return True
    if isinstance(data_type, ArrayType):
        return _unordered(data_type.elementType)
    return isinstance(data_type, StructType) and any(_unordered(field.dataType) for field in data_type)
