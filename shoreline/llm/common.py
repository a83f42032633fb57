"""What several operators share: tables, staging in the shared folder, word rows in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from shoreline.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Texts are handed to Python in slices of about this many bytes, however long one text is.
SLICE_BYTES = 2 << 20

#: Words whose hashes a task remembers before it starts over; bounds its memory.
REMEMBERED_WORDS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which also cuts its lineage.

    Every later use reads the files, so losing an executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` does it for texts of ASCII alone and is the faster one.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def unused_name(df: DataFrame, wish: str) -> str:
    """``wish``, or the first variant of it that no column of ``df`` has."""
    taken, name = {c.lower() for c in df.columns}, wish
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of about ``SLICE_BYTES`` in the named binary column."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > SLICE_BYTES:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


class WordHashes(dict):
    """64-bit hash of a word; remembers those it has computed."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that sums of them spread well."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows_hash(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``length`` consecutive word hashes, by doubling; one entry per start."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, reach, result, done = mixed(words + np.uint64(seed)), 1, None, 0
        while True:
            if length & reach:
                part = power[done : done + n]
                result = part.copy() if result is None else mixed(result * np.uint64(0x9E3779B97F4A7C15) + part)
                done += reach
            if done == length:
                return result
            power = mixed(power[:-reach] * np.uint64(0xC2B2AE3D27D4EB4F) + power[reach:])
            reach *= 2


def with_scores(docs: DataFrame, name: str, scores) -> DataFrame:
    """``docs`` and a double column ``name``: ``scores`` of each slice's texts, given as bytes."""
    at, names = docs.columns.index("text"), [*docs.columns, name]
    fields = [StructField("text", BinaryType()) if f.name == "text" else f for f in docs.schema.fields]
    schema = StructType([*fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values = pa.array(scores([text or b"" for text in part.column(at).to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns, values], names=names)

    result = docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, schema)
    return result.withColumn("text", F.col("text").cast("string"))
