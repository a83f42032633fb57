"""Ledger of consumed offsets, what it covers, and positions to start from.

A ledger has a range of offsets per batch and topic partition, ``until_offset`` exclusive. Ranges
of several runs may overlap, and a range that never landed leaves a hole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTITION = ["topic", "partition"]


def offset_ledger(records: DataFrame) -> DataFrame:
    """First and next offset of each topic partition; ``until_offset`` is exclusive."""
    return records.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def coverage(ledger: DataFrame) -> DataFrame:
    """How many ranges cover each stretch of a topic partition, 0 for a hole between two of them.

    Range ends are counted up and down along the offsets, so the work is a sort of the
    ledger's rows whatever overlaps. Empty and reversed ranges cover nothing.
    """
    ends = F.explode(
        F.array(
            F.struct(F.col("from_offset").alias("at"), F.lit(1).alias("step")),
            F.struct(F.col("until_offset").alias("at"), F.lit(-1).alias("step")),
        )
    )
    steps = ledger.where("from_offset < until_offset").select(*PARTITION, ends.alias("end"))
    changes = steps.groupBy(*PARTITION, F.col("end.at").alias("at")).agg(F.sum("end.step").alias("step")).where("step <> 0")
    along = Window.partitionBy(*PARTITION).orderBy("at")
    stretches = changes.select(
        *PARTITION,
        F.col("at").alias("from_offset"),
        F.lead("at").over(along).alias("until_offset"),
        F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("times"),
    )
    return stretches.where("until_offset IS NOT NULL")


def gaps(ledger: DataFrame) -> DataFrame:
    """The ranges between landed ones that never landed."""
    return coverage(ledger).where("times = 0").drop("times")


def islands(ledger: DataFrame) -> DataFrame:
    """Unbroken ranges, each with the number of offsets in it that several ranges cover."""
    along = Window.partitionBy(*PARTITION).orderBy("from_offset").rowsBetween(Window.unboundedPreceding, 0)
    holes_before = F.count_if(F.col("times") == 0).over(along)
    landed = coverage(ledger).withColumn("_island", holes_before).where("times > 0")
    size = F.col("until_offset") - F.col("from_offset")
    return (
        landed.groupBy(*PARTITION, "_island")
        .agg(
            F.min("from_offset").alias("from_offset"),
            F.max("until_offset").alias("until_offset"),
            F.sum(F.when(F.col("times") > 1, size).otherwise(0)).alias("repeated"),
        )
        .drop("_island")
    )


def starting_positions(ledger: DataFrame, partitions: DataFrame) -> DataFrame:
    """Where each known ``(topic, partition)`` continues; 0 where the ledger has none.

    That is the end of its first unbroken range, so that a range which never landed is read. What landed
    behind it is read again: :func:`not_landed` leaves it out.
    """
    saved = islands(ledger).groupBy(*PARTITION).agg(F.min("until_offset").alias("saved"))
    return partitions.join(saved, PARTITION, "left").select(
        *PARTITION, F.coalesce("saved", F.lit(0)).alias("start_offset")
    )


def not_landed(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """Records, also of a stream, whose offset lies in no range of the ledger."""
    landed = islands(ledger).select(*[F.col(c).alias(f"_{c}") for c in (*PARTITION, "from_offset", "until_offset")])
    same = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
    inside = (F.col("offset") >= F.col("_from_offset")) & (F.col("offset") < F.col("_until_offset"))
    return records.join(landed, same & inside, "left_anti")


def starting_offsets_json(positions: DataFrame) -> DataFrame:
    """All positions as the one JSON text the Kafka source takes as ``startingOffsets``.

    One entry per topic partition, so the text grows with the topics, not with the records.
    """
    entries = F.array_sort(F.collect_list(F.struct("partition", "start_offset")))
    offsets = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["partition"].cast("string"), e["start_offset"]))
    )
    by_topic = positions.groupBy("topic").agg(F.to_json(offsets).alias("offsets"))
    members = F.transform(
        F.array_sort(F.collect_list(F.struct("topic", "offsets"))),
        lambda t: F.concat(F.lit('"'), t["topic"], F.lit('":'), t["offsets"]),
    )
    return by_topic.agg(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("starting_offsets"))
