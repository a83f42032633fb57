"""Kafka topics as streaming DataFrames of text records.

The connector comes with the cluster (``spark-sql-kafka``). Every job downstream takes any
streaming DataFrame with the columns of :data:`RECORD_SCHEMA`, so a file stream serves too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)


def kafka_options(
    servers: str,
    topics: str | Sequence[str],
    *,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    client: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Source options. ``client`` passes security and other consumer settings through.

    Spark keeps positions in the query's checkpoint and commits none to the broker;
    ``starting_offsets`` only counts for a query without a checkpoint. The limit per trigger
    is what holds back a burst.
    """
    names = topics.split(",") if isinstance(topics, str) else topics
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(name.strip() for name in names),
        "startingOffsets": starting_offsets,
        **{f"kafka.{name}": value for name, value in (client or {}).items()},
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """One stream over all topics; the ``topic`` column tells them apart."""
    return text_records(spark.readStream.format("kafka").options(**options).load())


def text_records(records: DataFrame) -> DataFrame:
    """Key and value as text, with where and when the record was stored."""
    return records.select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        "topic",
        F.col("partition").cast("int"),
        F.col("offset").cast("bigint"),
        F.col("timestamp").cast("timestamp"),
    )
