"""Which batches of a path are whole.

A batch is written folder by folder, and one that runs again replaces its folders one after the
other, so a reader of the bare path can meet half of it. ``<path>/_commits`` says of each run up
to which batch it is whole: it is taken back before a batch is written again and set when all of
it is there. One small file per run, replaced in one step; batches handed over by hand, outside
any stream, have a file each, as they come in any order. Spark's readers pass over the folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoreline.session import make_folder, path_exists, read_text_file, replace_text_file

BATCH_COLUMN = "batch_id"
RUN_COLUMN = "run_id"
#: The run of batches that no stream handed over.
DIRECT = "direct"

COMMITS = "_commits"
_SCHEMA = "run_id string, from_batch bigint, upto_batch bigint"


def _marker(path: str, run: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{COMMITS}/{f'{run}-{batch_id}' if run == DIRECT else run}.json"


def begin(spark: SparkSession, path: str, run: str, batch_id: int) -> None:
    """Before a batch writes: from now on it does not count, however far an earlier try came."""
    make_folder(spark, f"{path.rstrip('/')}/{COMMITS}")
    marker = _marker(path, run, batch_id)
    found = read_text_file(spark, marker)
    if found is not None and json.loads(found)["upto_batch"] >= batch_id:
        _set(spark, marker, run, batch_id, batch_id - 1)


def commit(spark: SparkSession, path: str, run: str, batch_id: int) -> None:
    """After all of a batch is written."""
    _set(spark, _marker(path, run, batch_id), run, batch_id, batch_id)


def _set(spark: SparkSession, marker: str, run: str, batch_id: int, upto: int) -> None:
    first = batch_id if run == DIRECT else 0
    replace_text_file(spark, marker, json.dumps({"run_id": run, "from_batch": first, "upto_batch": upto}))


def read_committed(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    file_format: str = "parquet",
    commits_of: str | None = None,
) -> DataFrame:
    """The rows of whole batches.

    ``commits_of`` names the path whose commits count where one commit stands for several
    paths, as that of routed records does for their ledger. A path that has no commits at
    all, written by something else, is read as it is.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return committed(reader.format(file_format).load(path), commits_of or path)


def committed(rows: DataFrame, path: str) -> DataFrame:
    """Rows with ``run_id`` and ``batch_id`` without those of batches that are not whole."""
    spark, folder = rows.sparkSession, f"{path.rstrip('/')}/{COMMITS}"
    if not path_exists(spark, folder):
        return rows
    whole = spark.read.schema(_SCHEMA).json(folder).withColumnRenamed("run_id", "_run")
    batch = F.col(BATCH_COLUMN)
    inside = (F.col(RUN_COLUMN) == F.col("_run")) & (batch >= F.col("from_batch")) & (batch <= F.col("upto_batch"))
    return rows.join(whole, inside, "left_semi")
