"""Session settings and shared scratch storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs are designed for. Executor counts and memory stay with the launcher.
#: The shuffle partition count is a starting point that AQE coalesces from, so it is set
#: for the large case; tests and small runs lower it.
RECOMMENDED_CONF = {
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

#: Overrides for streams. The partition count of a stateful query is fixed by its first run
#: and each partition is a state store, so it follows the executors' cores, not the data.
STREAMING_CONF = {
    "spark.sql.shuffle.partitions": "2000",
}


#: Scratch paths taken inside ``scratch_cleared``.
_TAKEN: ContextVar[list[str] | None] = ContextVar("taken", default=None)


def build_session(app_name: str, overrides: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **(overrides or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the cluster's checkpoint folder, else its warehouse's."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created until something is written."""
    path = f"{shared_folder(spark)}/shoreline/{label}-{uuid.uuid4().hex}"
    if (taken := _TAKEN.get()) is not None:
        taken.append(path)
    return path


@contextmanager
def scratch_cleared(spark: SparkSession) -> Iterator[None]:
    """Remove what was written to scratch paths taken in the block, also after an error.

    For steps that write their result elsewhere before the block ends: a result that is still
    to be computed would miss its inputs.
    """
    taken: list[str] = []
    token = _TAKEN.set(taken)
    try:
        yield
    finally:
        _TAKEN.reset(token)
        for path in taken:
            remove_folder(spark, path)


def remove_folder(spark: SparkSession, path: str) -> None:
    store, target = _store(spark, path)
    store.delete(target, True)


@contextmanager
def scratch_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh path in the shared folder whose content goes away with the block."""
    path = scratch_path(spark, label)
    try:
        yield path
    finally:
        remove_folder(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _store(spark, path)
    return store.exists(target)


def qualified_path(spark: SparkSession, path: str) -> str:
    """A path with the scheme of the file system it belongs to."""
    store, target = _store(spark, path)
    return store.makeQualified(target).toString()


def list_files(spark: SparkSession, root: str) -> Iterator[tuple[str, int, int]]:
    """Path, length and modification time in milliseconds of every file below ``root``."""
    store, top = _store(spark, root)
    found = store.listFiles(top, True)
    while found.hasNext():
        file = found.next()
        yield file.getPath().toString(), file.getLen(), file.getModificationTime()


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Give a single file another name, as landed files have names that Spark does not write."""
    store, old = _store(spark, source)
    new = _store(spark, target)[1]
    store.mkdirs(new.getParent())
    if not store.rename(old, new):
        raise OSError(f"{source} cannot be renamed to {target}")


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None where there is none."""
    store, target = _store(spark, path)
    if not store.exists(target):
        return None
    stream = store.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers find the old or the new content, never a part."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm
    store, target = _store(spark, path)
    fresh = _store(spark, f"{target.getParent().toString()}/.{uuid.uuid4().hex}")[1]
    stream = store.create(fresh, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs = jvm.org.apache.hadoop.fs
    how = context._gateway.new_array(fs.Options.Rename, 1)
    how[0] = fs.Options.Rename.OVERWRITE
    files = fs.FileContext.getFileContext(store.getUri(), context._jsc.hadoopConfiguration())
    files.rename(store.makeQualified(fresh), store.makeQualified(target), how)


def make_folder(spark: SparkSession, path: str) -> None:
    store, target = _store(spark, path)
    store.mkdirs(target)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its source has fewer splits than that, before costly work per row.

    A source with splits enough, and any stream, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def _store(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write ``df`` once to the shared folder and yield it read back.

    Several actions can then use the result without running its lineage again, and a lost
    executor costs no recomputation.
    """
    with scratch_folder(df.sparkSession, label) as path:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
