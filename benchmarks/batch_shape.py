"""Batch ingestion here against the shape it replaces, on the same landed text.

The older shape counts the source, counts the deduplicated rows and writes them, three
actions over one uncached plan. Both use the same built-in expressions, so that only the
shape differs. A third of the rows has one key. Prints one JSON line.

    python benchmarks/batch_shape.py [sf_dir] [copies]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.functions.timestamps import BLANK_MODE, canonical_timestamps
from shoreline.operators.dedup import latest_rows
from shoreline.plans.batch_ingest import IngestJob, run_ingest
from shoreline.queries.inputs import landed_lines, table
from shoreline.session import scratch_path
from shoreline.sinks.delimited import file_count, write_delimited
from shoreline.sources.delimited import read_delimited
from shoreline.sources.dialect import APOSTROPHE_DIALECT

ROWS_PER_FILE = 250_000


def land(spark: SparkSession, sf_dir: str, copies: int) -> str:
    lines = landed_lines(table(spark, sf_dir, "lineitem"))
    copied = lines.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    hot = F.pmod(F.xxhash64("order_no", "line_no", "copy"), F.lit(3)) == 0
    skewed = copied.withColumns({name: F.when(~hot, F.col(name)) for name in ("part", "supplier")})
    wide = skewed.select("*", *[F.sha2(F.concat("price", F.lit(str(i))), 256).alias(f"x{i}") for i in range(10)])
    path = scratch_path(spark, "bench-landed")
    write_delimited(wide.repartition(24), path, APOSTROPHE_DIALECT)
    return path


def older_shape(spark: SparkSession, job: IngestJob) -> tuple[int, int]:
    source = canonical_timestamps(read_delimited(spark, job.source, job.dialect), job.time_columns, BLANK_MODE)
    source_count = source.count()
    rows: DataFrame = latest_rows(source, job.keys, job.order)
    dedup_count = rows.count()
    write_delimited(rows.coalesce(file_count(dedup_count, job.rows_per_file)), job.target, job.dialect)
    return dedup_count, source_count


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    source = land(spark, sf_dir, copies)

    def job(**settings) -> IngestJob:
        return IngestJob(
            source=source,
            target=scratch_path(spark, "bench-out"),
            keys=("_c0", "_c1"),
            order=("_c2", "_c3", "_c4"),
            time_columns=("_c2",),
            name="lines",
            rows_per_file=ROWS_PER_FILE,
            **settings,
        )

    shapes = {
        "older": lambda: older_shape(spark, job()),
        "exact_files": lambda: run_ingest(spark, job()).first()[1:3],
        "same_pass": lambda: run_ingest(spark, job(exact_files=False)).first()[1:3],
    }
    seconds, counts = {name: [] for name in shapes}, set()
    for _ in range(3):
        for name, run in shapes.items():
            began = time.perf_counter()
            counts.add(tuple(run()))
            seconds[name].append(round(time.perf_counter() - began, 2))
    spark.stop()
    assert len(counts) == 1, counts
    print(json.dumps({"seconds": {name: min(taken) for name, taken in seconds.items()}, "counts": counts.pop()}))


if __name__ == "__main__":
    main()
