"""Exact top-k inner products over norm-sorted blocks of integer vectors.

Vectors are sorted by descending length and packed into blocks. An orthogonal rotation (the
eigenvectors of the Gram matrix, that is the right singular vectors) puts most of each vector
into its leading components. For a group of queries and a block of candidates

* a block is skipped if the product of lengths is below every query's k-th best score so far;
* the product of the leading components plus the product of the remaining lengths bounds the
  score (Cauchy-Schwarz); only candidates whose bound reaches the k-th best are multiplied out.

The k-th best starts from the longest vectors, which every query meets first. It tells how short
a candidate can be and still matter; queries that reach equally far are grouped. A share of
groups meets a slice of blocks in one task, which holds the groups and goes through the blocks in
descending length while the k-th best rises. So a block is shuffled once per share, not once per
group, and a task holds a bounded number of queries and one block. Vectors travel as the smallest
integers that hold all of them. Scores are exact integers while they fit in 64 bits.

Edge cases. Vectors that are null, or hold null or non-finite components, take no part, nor do rows
without an id, which could not be named as a result; shorter vectors count as ended by zeros. A candidate never has its query's id. Rows that repeat an id are each
a candidate; of repeated query ids the vector that sorts first is the query. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoreline.llm.common import written

#: Candidates in a block, queries in a group, blocks of a slice and, at most, groups of a share.
CANDIDATES, QUERIES, SLICE, SHARE = 2048, 512, 64, 64

#: The longest vectors, which give the first k-th best scores.
HEAD = 4096

#: Rotated components that are multiplied before a candidate's bound is known.
LEADING = 24

_PACKED = "ids binary, vectors binary, floors binary, bound double"


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """``vec_id`` and ``v``, floor(scale * component) of each vector that takes part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    there = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    return vectors.where(there & finite).select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("v"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors as rows, ended by zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    result = np.zeros((len(lengths), size), np.int64)
    result[np.arange(size) < lengths[:, None]] = column.flatten().to_numpy()
    return result


def _narrowest(low: int | None, high: int | None) -> type:
    """The smallest integer type for components from ``low`` to ``high``."""
    for kind in (np.int16, np.int32):
        if low is None or (np.iinfo(kind).min <= low and high <= np.iinfo(kind).max):
            return kind
    return np.int64


def rotation(vectors: DataFrame, size: int) -> np.ndarray:
    """Orthogonal matrix whose columns are the directions of descending energy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((size, size))
        for batch in batches:
            rows = _matrix(batch.column("v"), size).astype(np.float64)
            gram += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size, dtype=np.int32)), pa.array(gram.ravel())], names=["cell", "x"])

    cells = vectors.select("v").mapInArrow(run, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x")).toArrow()
    gram = np.zeros(size * size)
    gram[cells.column(0).to_numpy()] = cells.column(1).to_numpy()
    return np.ascontiguousarray(np.linalg.eigh(gram.reshape(size, size))[1][:, ::-1])


def _packed(size: int, kind: type, limit: int):
    """Consecutive rows ``vec_id``, ``v``, ``floor``, ``bound`` of a partition, up to ``limit`` in one.

    The bound of the first row, which sorts first, holds for all of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            numbers = [batch.column(c).to_numpy() for c in ("vec_id", "floor", "bound")]
            columns = [*numbers, _matrix(batch.column("v"), size).astype(kind)]
            held = columns if held is None else [np.concatenate(pair) for pair in zip(held, columns)]
            while len(held[0]) >= limit:
                yield pack(*(c[:limit] for c in held))
                held = [c[limit:] for c in held]
        if held is not None and len(held[0]):
            yield pack(*held)

    def pack(ids: np.ndarray, floors: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        values = [pa.array([x.tobytes()], pa.binary()) for x in (ids, rows, floors)]
        return pa.RecordBatch.from_arrays([*values, pa.array(bounds[:1])], names=["ids", "vectors", "floors", "bound"])

    return run


def _numbered(packed: DataFrame, name: str) -> DataFrame:
    """``packed`` in the shared folder, with a ``number`` from 0 in the order of its partitions.

    The window sees one row per partition, and so does the broadcast.
    """
    stored = written(packed.withColumn("at", F.monotonically_increasing_id()), name)
    parts = stored.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    starts = written(parts.select("part", before.alias("before")), name)
    placed = stored.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(starts), "part")
    number = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("number", number).drop("part", "before", "at")


class _Block:
    """Vectors with their rotations, lengths, and lengths behind the leading components."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, turn: np.ndarray):
        self.ids, self.rows = ids, rows
        self.rotated = rows @ turn
        self.norms = np.linalg.norm(self.rotated, axis=1)
        self.rest = np.linalg.norm(self.rotated[:, LEADING:], axis=1)


class _Queries(_Block):
    """A group of queries with their best candidates so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, turn: np.ndarray, k: int, floor: np.ndarray | None = None):
        super().__init__(ids, rows, turn)
        self.k, self.floor = k, np.full(len(ids), -np.inf) if floor is None else floor.copy()
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]

    def reach(self) -> np.ndarray:
        """The length below which no candidate matters, by query."""
        return np.where(self.floor <= 0, -np.inf, self.floor) / np.maximum(self.norms, 1e-300) * (1 - 1e-9)

    def meet(self, block: _Block) -> None:
        longest = block.norms.max(initial=0)
        slack = 1e-9 * (1 + self.norms.max(initial=0) * longest)
        live = np.flatnonzero(self.norms * longest + slack >= self.floor)
        if not len(live):
            return
        bound = self.rotated[live, :LEADING] @ block.rotated[:, :LEADING].T
        bound += np.outer(self.rest[live], block.rest) + slack
        at, candidate = np.nonzero((bound >= self.floor[live, None]) & (block.ids[None, :] != self.ids[live, None]))
        if not len(at):
            return
        if len(at) * 8 > bound.size:
            scores = self._products(self.rows[live], block.rows.T)[at, candidate]
        else:
            scores = np.einsum("ij,ij->i", self.rows[live[at]], block.rows[candidate])
        keep = scores >= self.floor[live[at]]
        at, candidate, scores = at[keep], candidate[keep], scores[keep]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        for start, end in zip(starts, [*starts[1:], len(at)]):
            i = live[at[start]]
            own_scores = np.concatenate((self.best[i][0], scores[start:end]))
            own_ids = np.concatenate((self.best[i][1], block.ids[candidate[start:end]]))
            order = np.lexsort((own_ids, -own_scores))[: self.k]
            self.best[i] = own_scores[order], own_ids[order]
            if len(order) == self.k:
                self.floor[i] = max(self.floor[i], own_scores[order[-1]])

    def _products(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """In floating point while that is exact."""
        largest = np.abs(left).max(initial=0) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
        if largest < 2**52:
            return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
        return left @ right

    def found(self) -> pa.RecordBatch:
        counts = [len(scores) for scores, _ in self.best]
        columns = [np.repeat(self.ids, counts), np.concatenate([b[1] for b in self.best]), np.concatenate([b[0] for b in self.best])]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` best of each query.

    ``queries`` is a condition on ``vec_id``. Ties go to the smaller ``vec_id``.
    """
    context = vectors.sparkSession.sparkContext
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    base = written(quantised(vectors, scale).withColumn("norm", F.sqrt(squares)), "vectors")
    size, low, high = base.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    size, kind = size or 1, _narrowest(low, high)
    turn = rotation(base, size)
    head = base.orderBy(F.desc("norm"), "vec_id").limit(HEAD).select("vec_id", "v").toArrow().combine_chunks().to_batches()
    head = [(b.column("vec_id").to_numpy(), _matrix(b.column("v"), size).astype(kind)) for b in head]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its first k-th best and the length of the shortest candidate that can matter."""
        longest = [_Block(ids, rows.astype(np.int64), turn) for ids, rows in head]
        for batch in batches:
            for start in range(0, batch.num_rows, QUERIES):
                part = batch.slice(start, QUERIES)
                group = _Queries(part.column("vec_id").to_numpy(), _matrix(part.column("v"), size), turn, k)
                for block in longest:
                    group.meet(block)
                columns = [part.column("vec_id"), part.column("v"), pa.array(group.floor), pa.array(group.reach())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "floor", "bound"])

    by_length = base.select("vec_id", "v", F.lit(0.0).alias("floor"), F.col("norm").alias("bound"))
    by_length = by_length.repartitionByRange(F.desc("bound"), "vec_id").sortWithinPartitions(F.desc("bound"), "vec_id")
    blocks = _numbered(by_length.mapInArrow(_packed(size, kind, CANDIDATES), _PACKED), "blocks")
    asked = base.where(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    started = written(asked.mapInArrow(begin, "vec_id bigint, v array<bigint>, floor double, bound double"), "queries")
    by_reach = started.repartitionByRange("bound", "vec_id").sortWithinPartitions("bound", "vec_id")
    groups = _numbered(by_reach.mapInArrow(_packed(size, kind, QUERIES), _PACKED), "groups")

    n_groups, n_slices = groups.count(), -(-blocks.count() // SLICE)
    share = max(1, min(SHARE, n_groups * n_slices // (2 * context.defaultParallelism)))
    groups = groups.withColumn("share", F.floor(F.col("number") / share))
    blocks = blocks.withColumn("slice", F.floor(F.col("number") / SLICE))
    needed = groups.groupBy("share").agg(F.min("bound").alias("needed"))
    longest = blocks.groupBy("slice").agg(F.max("bound").alias("longest"))
    shares = F.sequence(F.lit(0), F.lit(-(-n_groups // share) - 1)) if n_groups else F.array()
    met = longest.select("slice", "longest", F.explode(shares.cast("array<bigint>")).alias("share")).join(needed, "share")
    met = written(met.where("longest >= needed").select("share", "slice"), "met")

    asking = met.join(groups, "share").select("share", "slice", F.lit(0).alias("side"), "number", "ids", "vectors", "floors")
    facing = met.join(blocks, "slice").select("share", "slice", F.lit(1).alias("side"), "number", "ids", "vectors", F.lit(None).cast("binary"))
    tasks = min(max(1, met.count()), int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = asking.union(facing).repartition(tasks, "share", "slice").sortWithinPartitions("share", "slice", "side", "number")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                row = {c: column[i].as_py() for c, column in columns.items()}
                if (row["share"], row["slice"]) != key:
                    yield from (group.found() for group in held)
                    key, held = (row["share"], row["slice"]), []
                ids = np.frombuffer(row["ids"], np.int64)
                rows = np.frombuffer(row["vectors"], kind).reshape(len(ids), size).astype(np.int64)
                if row["side"]:
                    block = _Block(ids, rows, turn)
                    for group in held:
                        group.meet(block)
                else:
                    held.append(_Queries(ids, rows, turn, k, np.frombuffer(row["floors"], np.float64)))
        yield from (group.found() for group in held)

    found = dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
