"""What each batch of a stream took from its sources, told by the stream itself.

A listener hears of every batch once it is committed and keeps a row per source: the positions it
read from and to, rows and seconds. Positions come from the source, so they have no holes where a
topic does (compacted or transactional topics), which a ledger made from records shows as gaps.
"""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from shoreline.session import replace_text_file

_SCHEMA = """run_id string, batch_id bigint, at timestamp, source_no int, source string,
    start_position string, end_position string, rows bigint, seconds double, observed string"""


class ProgressLedger(StreamingQueryListener):
    """Writes each batch's progress below ``path``; one file per batch and run, replaced if told again.

    ``queries`` limits it to the queries of these names; None hears all of the session. What
    goes wrong here is a warning: it must not stop a stream.
    """

    def __init__(self, spark: SparkSession, path: str, queries: set[str] | None = None):
        self.spark, self.path, self.queries = spark, path.rstrip("/"), queries

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.queries is not None and progress.name not in self.queries:
            return
        observed = {name: row.asDict(True) for name, row in (progress.observedMetrics or {}).items()}
        rows = [
            {
                "run_id": str(progress.id),
                "batch_id": progress.batchId,
                "at": progress.timestamp,
                "source_no": number,
                "source": source.description,
                "start_position": source.startOffset,
                "end_position": source.endOffset,
                "rows": source.numInputRows,
                "seconds": progress.batchDuration / 1000,
                "observed": json.dumps(observed, default=str),
            }
            for number, source in enumerate(progress.sources)
        ]
        try:
            replace_text_file(self.spark, f"{self.path}/{progress.id}-{progress.batchId}.json", "\n".join(map(json.dumps, rows)) + "\n")
        except Exception as failure:
            warnings.warn(f"progress not written to {self.path}: {failure}", stacklevel=2)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """A row per run, batch and source. Batches that took nothing are told too while a stream idles."""
    return spark.read.schema(_SCHEMA).json(path)


def topic_ranges(progress: DataFrame) -> DataFrame:
    """Kafka positions as a ledger: topic, partition, ``from_offset`` and ``until_offset`` per batch.

    A partition that is new in a batch has no start and begins at 0. Partitions of which
    nothing was taken are left out.
    """

    def positions(column: str, name: str) -> DataFrame:
        parsed = F.from_json(column, "map<string, map<string, bigint>>")
        topics = progress.select("run_id", "batch_id", "source_no", F.explode(parsed).alias("topic", "offsets"))
        return topics.select("run_id", "batch_id", "source_no", "topic", F.explode("offsets").alias("partition", name))

    keys = ["run_id", "batch_id", "source_no", "topic", "partition"]
    both = positions("end_position", "until_offset").join(positions("start_position", "from_offset"), keys, "left")
    ranges = both.withColumns({"from_offset": F.coalesce("from_offset", F.lit(0)), "partition": F.col("partition").cast("int")})
    return ranges.where("until_offset > from_offset").select("topic", "partition", "from_offset", "until_offset", "run_id", "batch_id")


def observing_ranges(records: DataFrame, partitions: list[tuple[str, int]], name: str = "ranges") -> DataFrame:
    """A stream that tells, with each batch's progress, the offsets it held of the named topic partitions.

    The tasks that process the batch count along, so no batch is read twice for its ledger. A
    metric per end of a topic partition: meant for topics whose partitions are known.
    """
    ends = []
    for topic, partition in partitions:
        own = F.when((F.col("topic") == topic) & (F.col("partition") == partition), F.col("offset"))
        key = json.dumps([topic, partition])
        ends += [F.min(own).alias(f"from {key}"), (F.max(own) + 1).alias(f"until {key}")]
    return records.observe(name, *ends)


def observed_ranges(progress: DataFrame, name: str = "ranges") -> DataFrame:
    """The ledger that :func:`observing_ranges` made progress tell."""
    metrics = F.from_json(F.get_json_object("observed", f"$.{name}"), "map<string, bigint>")
    ends = progress.where("source_no = 0").select("run_id", "batch_id", F.explode(metrics).alias("metric", "offset"))
    place = F.regexp_extract("metric", r"^\w+ (.*)$", 1)
    topic, partition = F.get_json_object(place, "$[0]"), F.get_json_object(place, "$[1]").cast("int")
    end = F.split_part("metric", F.lit(" "), F.lit(1))
    ranges = ends.where("offset IS NOT NULL").groupBy(topic.alias("topic"), partition.alias("partition"), "run_id", "batch_id")
    return ranges.agg(
        F.max(F.when(end == "from", F.col("offset"))).alias("from_offset"), F.max(F.when(end == "until", F.col("offset"))).alias("until_offset")
    )
