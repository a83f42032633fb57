"""File systems listed by tasks, a folder each.

Folders are taken level by level: each task lists the folders dealt to it, what they hold is
written to the shared folder, and the folders among it are the next level's work. The driver
learns how many there are and holds no name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoreline.session import list_files, qualified_path, scratch_path

#: Path, length, time in milliseconds since 1970, and whether it is a folder.
ENTRY = "path string, length bigint, at bigint, folder boolean"
_NAMES = ["path", "length", "at", "folder"]
_BATCH = 10_000


def _place(uri: str) -> tuple[arrow_fs.FileSystem, str, str]:
    """The file system of a path, the path as it takes it, and what to put before its answers."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file" or uri.startswith("/"):
        return arrow_fs.LocalFileSystem(), "/" + (rest if scheme == "file" else uri).lstrip("/"), ""
    authority, _, inner = rest.lstrip("/").partition("/")
    known = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    store, base = arrow_fs.FileSystem.from_uri(f"{known}://{authority}/")
    by_bucket = base.strip("/") == authority  # the bucket is part of the path
    return store, f"{authority}/{inner}" if by_bucket else f"/{inner}", f"{scheme}://{'' if by_bucket else authority}"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            store, path, prefix = _place(uri)
            found = store.get_file_info(arrow_fs.FileSelector(path))
            for at in range(0, len(found), _BATCH):
                some = [i for i in found[at : at + _BATCH] if i.type in (arrow_fs.FileType.File, arrow_fs.FileType.Directory)]
                columns = [
                    pa.array([prefix + i.path for i in some], pa.string()),
                    pa.array([i.size for i in some], pa.int64()),
                    pa.array([(i.mtime_ns or 0) // 1_000_000 for i in some], pa.int64()),
                    pa.array([i.type == arrow_fs.FileType.Directory for i in some], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def listed(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """``path``, ``length`` and ``at`` of every file below the roots, whatever its name or size.

    Roots in a store that only Hadoop reaches are listed page by page from the driver.
    """
    tops = [qualified_path(spark, root) for root in roots]
    if not all(map(_reachable, tops)):
        rows = [row for root in roots for row in list_files(spark, root)]
        return spark.createDataFrame(rows, "path string, length bigint, at bigint")
    level, size = spark.createDataFrame([(top,) for top in tops], "path string"), len(tops)
    found = spark.createDataFrame([], ENTRY)
    while size:
        # A given number of partitions stays; small ones by key would be merged into one task.
        tasks = min(size, 4 * spark.sparkContext.defaultParallelism)
        path = scratch_path(spark, "listing")
        level.repartition(tasks, "path").mapInArrow(_entries, ENTRY).write.parquet(path)
        entries = spark.read.schema(ENTRY).parquet(path)
        found = found.unionByName(entries)
        level = entries.where("folder").select("path")
        size = level.count()
    return found.where(~F.col("folder")).drop("folder")


def _reachable(uri: str) -> bool:
    try:
        _place(uri)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True
