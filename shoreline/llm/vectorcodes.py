"""Vector codes: each of four parts of a vector as the number of its nearest codebook entry.

Codebooks are fitted by rounds of assigning all parts and averaging those of each entry. The
nearest entry is found by equal-average search: entries are sorted by the sum of their
components; the search starts where a part's own sum lies and goes outward on both sides.
By the Cauchy-Schwarz inequality the squared difference of two sums over the dimension is at
most their squared distance, so the search ends once that exceeds the best distance strictly;
entries at equal distance are still met, and the lower number wins. All numbers are integers.

A round is one pass over the staged vectors: tasks send one row per used entry (count and sums),
at most ``PARTS * ENTRIES`` each, which are added up by entry. The codebooks, ``PARTS *
ENTRIES`` short vectors, are all that goes to the driver and to the tasks.

Components x become ``floor(SCALE * x)``. Edge cases. Vectors that are null or hold null or
non-finite components are dropped. Codes need vectors of one length that four divides: it is
the most frequent such length above 0 (of equals the larger one). Vectors of another length,
or with a component whose integer reaches ``LIMIT`` over the length (64-bit distances would not
hold it: 2 to the 25th for 64 components), keep their row but have no code and no error, and do
not count for the codebooks. Rows with equal ids are vectors
of their own, and rows without id come last; equal ids start codebooks in the order of their
vectors. Fewer than ``ENTRIES`` vectors make smaller codebooks, none make an empty one. Extra
columns go through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shoreline.llm.common import unused_name, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components as integers, times the vector's length, stay below this on both sides of 0.
LIMIT = 1 << 31
#: Parts that are searched for together, and entries they are compared with at once.
TOGETHER, STEP = 512, 16


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return vector.isNotNull() & finite


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest entry of ``book`` for each part, by equal averages.

    Parts with close sums share a window of entries that grows outward, ``STEP`` entries at a
    time, as long as one of them needs it; only those that do are compared.
    """
    entries, dimension = book.shape
    far = np.iinfo(np.int64).max
    chosen, best = np.zeros(len(parts), np.int64), np.full(len(parts), far if dimension else 0)
    if not len(parts) or not entries or not dimension:
        return chosen, best
    by_sum = np.argsort(book.sum(axis=1), kind="stable")
    book = book[by_sum]
    sums, own = book.sum(axis=1), parts.sum(axis=1)
    peak = max(int(np.abs(book).max()), int(np.abs(parts).max()))
    # Products of floats are faster, and exact as far as all their sums are.
    number = np.float64 if 4 * dimension * peak**2 < 1 << 53 else np.int64
    columns, book_squares = book.T.astype(number), (book**2).sum(axis=1)
    order = np.argsort(own, kind="stable")
    for group in (order[at : at + TOGETHER] for at in range(0, len(order), TOGETHER)):
        rows, sum_of = parts[group].astype(number), own[group]
        squares, near, which = (parts[group] ** 2).sum(axis=1), np.full(len(group), far), np.zeros(len(group), np.int64)

        def open_parts(gap: np.ndarray) -> np.ndarray:
            unseen = near == far
            return np.flatnonzero(unseen | (np.maximum(gap, 0) ** 2 <= np.where(unseen, 0, near) * dimension))

        def compare(some: np.ndarray, begin: int, end: int) -> None:
            lower = np.argsort(by_sum[begin:end]) + begin
            products = (rows[some] @ columns[:, lower]).astype(np.int64)
            distances = squares[some, None] + book_squares[lower] - 2 * products
            place = distances.argmin(axis=1)
            distance, entry = distances[np.arange(len(some)), place], by_sum[lower[place]]
            nearer = (distance < near[some]) | ((distance == near[some]) & (entry < which[some]))
            near[some[nearer]], which[some[nearer]] = distance[nearer], entry[nearer]

        low = high = int(np.searchsorted(sums, sum_of[len(group) // 2]))
        growing = True
        while growing:
            growing = False
            if high < entries and len(some := open_parts(sums[high] - sum_of)):
                end = min(high + STEP, entries)
                compare(some, high, end)
                high, growing = end, True
            if low > 0 and len(some := open_parts(sum_of - sums[low - 1])):
                begin = max(low - STEP, 0)
                compare(some, begin, low)
                low, growing = begin, True
        chosen[group], best[group] = which, near
    return chosen, best


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, number]`` are the entries' integer components."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry number and squared distance, by vector and part."""
        cut = vectors.reshape(len(vectors), PARTS, -1)
        codes, errors = zip(*(nearest(cut[:, part], book) for part, book in enumerate(self.entries)))
        return np.stack(codes, axis=1), np.stack(errors, axis=1)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), dimension)


@dataclass(frozen=True)
class Staged:
    """Vectors as integers, in ``ints``; null where they take no part."""

    rows: DataFrame
    ints: str
    dimension: int


def staged_integers(vectors: DataFrame, vector_column: str = "embedding") -> Staged:
    """The usable rows with their integers, written once for all rounds."""
    ints, length = unused_name(vectors, "ints"), unused_name(vectors, "length")
    floors = F.transform(vector_column, lambda x: F.floor(x.cast("double") * SCALE))
    small = F.forall(vector_column, lambda x: F.abs(x.cast("double")) * SCALE * F.size(vector_column) < LIMIT)
    kept = vectors.where(usable(F.col(vector_column))).withColumn(ints, F.when(small, floors).cast("array<int>"))
    rows = written(kept, "vector-integers")
    sizes = rows.where(F.col(ints).isNotNull()).groupBy(F.size(ints).alias(length)).count()
    common = sizes.where((F.col(length) > 0) & (F.col(length) % PARTS == 0)).orderBy(F.desc("count"), F.desc(length)).first()
    dimension = common[length] if common else 0
    return Staged(rows.withColumn(ints, F.when(F.size(ints) == dimension, F.col(ints))) if dimension else rows, ints, dimension)


def fit(staged: Staged, id_column: str = "vec_id") -> Codebooks:
    """Codebooks after ``ROUNDS`` rounds, begun with the parts of the smallest ids."""
    dimension = staged.dimension
    if not dimension:
        return Codebooks(np.zeros((PARTS, 0, 0), np.int64))
    ints = staged.rows.select(id_column, F.col(staged.ints).alias("ints")).where(F.col("ints").isNotNull())
    first = ints.orderBy(F.col(id_column).asc_nulls_last(), "ints").limit(ENTRIES).select("ints").toArrow()
    seeds = np.array(first.column(0).to_pylist(), np.int64).reshape(-1, PARTS, dimension // PARTS)
    books = Codebooks(seeds.transpose(1, 0, 2))
    for _ in range(ROUNDS):
        books = _averaged(ints.select("ints"), books, dimension)
    return books


def _averaged(ints: DataFrame, books: Codebooks, dimension: int) -> Codebooks:
    """One round: the floor of the mean of the parts of each entry; unused entries stay."""
    entries, size = books.entries.shape[1], dimension // PARTS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(PARTS * entries, np.int64), np.zeros((PARTS * entries, size), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), dimension)
            codes, _ = books.search(vectors)
            slots = (codes + np.arange(PARTS) * entries).ravel()
            counts += np.bincount(slots, minlength=len(counts))
            np.add.at(sums, slots, vectors.reshape(-1, size))
        used = np.flatnonzero(counts)
        parts = pa.array(sums[used].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), parts], names=["slot", "n", "sums"])

    partial = ints.mapInArrow(add, "slot bigint, n bigint, sums array<bigint>")
    totals = partial.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(size)])
    renewed = books.entries.copy()
    for slot, n, *total in totals.collect():
        renewed[slot // entries, slot % entries] = [value // n for value in total]
    return Codebooks(renewed)


def coded(staged: Staged, books: Codebooks) -> tuple[DataFrame, str, str]:
    """The staged rows without their integers, with code and error; names of these two columns.

    A code has two hex digits per part; an error is the squared distance over all parts.
    """
    rows, ints, dimension = staged.rows, staged.ints, staged.dimension
    code, error = unused_name(rows, "code"), unused_name(rows, "error")
    kept = [c for c in rows.columns if c != ints]
    schema = StructType([rows.schema[c] for c in kept] + [StructField(code, StringType()), StructField(error, LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ints)
            there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)) if dimension else np.empty(0, np.int64)
            texts, errors = np.full(len(column), None, object), np.full(len(column), None, object)
            if len(there):
                found, distances = books.search(_matrix(column.drop_null(), dimension))
                texts[there] = [bytes(row).hex() for row in found.astype(np.uint8)]
                errors[there] = distances.sum(axis=1).tolist()
            columns = [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, code, error])

    return rows.mapInArrow(encode, schema), code, error


def with_group_sums(rows: DataFrame, value: str, by: str, name: str) -> DataFrame:
    """``rows`` and the sum of ``value`` over those with an equal ``by``, nulls together.

    Sums are made on the map side and joined back, so a group of any size is no single task.
    """
    key = unused_name(rows, "group_key")
    sums = rows.groupBy(F.col(by).alias(key)).agg(F.sum(value).alias(name))
    return rows.join(sums, F.col(by).eqNullSafe(F.col(key)), "left").drop(key)
