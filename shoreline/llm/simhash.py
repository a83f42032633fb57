"""Near-duplicate documents by SimHash fingerprints and BK-trees.

A fingerprint holds 64 majority bits over the hashes of a document's word shingles. Two
fingerprints that differ in at most ``radius`` bits agree in all bits of at least
``blocks - radius`` of ``blocks`` bit blocks. So for each choice of so many blocks, the
fingerprints that agree there make a shard, and every link lies inside some shard. A shard
gets a BK-tree (children keyed by their Hamming distance to the parent); a search follows only
edges within the radius. Shards are dealt over the executors: the trees hold every
fingerprint of the corpus, so they are too large to broadcast.

Edge cases. A text that is null, empty or without words has fingerprint zero and links like
any other. A null ``doc_id`` is never the id of a component unless all of its members' are.
Repeated rows give repeated rows. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoreline.llm.common import slices, written

#: Seed of the shingle hashes.
SEED = 42

#: More fingerprints than this in one shard are split into chunks, each pair of them a shard.
SHARD_LIMIT = 2048

#: Blocks are chosen so that a shard of evenly spread fingerprints has about this many.
SHARD_AIM = 256


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number, for every row."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_fingerprint_batches(shingle), "doc_id bigint, fp bigint")


def _fingerprint_batches(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values = [fingerprint(text, shingle) for text in part.column("text").to_pylist()]
                fps = np.array(values, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    return run


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """A bit is 1 if more than half of the shingle hashes have it."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(b" ".join(words), SEED)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        last = shingle - 1
        hashes = b"".join(
            [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - last].tolist(), ends[last:].tolist())]
        )
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(bits), 255):  # eight sums in one addition, none of them above 255
        ones += bits[start : start + 255].view(np.uint64).sum(axis=0, dtype=np.uint64).view(np.uint8)
    return int.from_bytes(np.packbits(ones * 2 > len(bits)).tobytes(), "big")


def block_plan(n: int, radius: int) -> tuple[int, list[tuple[int, ...]]]:
    """How many bit blocks, and which of them agree in a shard, for ``n`` fingerprints."""
    blocks = radius + 1
    while blocks < 4 * radius and n >> (64 * (blocks - radius) // blocks) > SHARD_AIM:
        blocks += 1
    return blocks, list(combinations(range(blocks), blocks - radius))


def shard_rows(fps: DataFrame, n: int, radius: int) -> DataFrame:
    """``shard`` and ``fp``: each fingerprint once for every choice of blocks."""
    blocks, choices = block_plan(n, radius)
    edges = [64 * i // blocks for i in range(blocks + 1)]

    def mask(chosen: tuple[int, ...]) -> int:
        bits = sum(((1 << edges[b + 1]) - 1) ^ ((1 << edges[b]) - 1) for b in chosen)
        return bits - (1 << 64) if bits >= 1 << 63 else bits

    keys = F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask(c)))) for i, c in enumerate(choices)))
    return fps.select(F.explode(keys).alias("shard"), "fp")


def split_hot(rows: DataFrame, limit: int = SHARD_LIMIT) -> DataFrame:
    """The same shards, those above ``limit`` as pairs of chunks, so that no link is lost."""
    chunks = F.ceil(F.col("members") / limit).cast("int").alias("chunks")
    hot = rows.groupBy("shard").agg(F.count("*").alias("members")).where(F.col("members") > limit).select("shard", chunks)
    dealt = rows.join(hot, "shard", "left")
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int")
    others = F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))
    paired = dealt.select("shard", "fp", F.coalesce(own, F.lit(0)).alias("own"), F.explode(others).alias("other"))
    pair = F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other"))
    return paired.select(pair.alias("shard"), "fp")


def links(fps: DataFrame, n: int, radius: int) -> DataFrame:
    """``a`` and ``b``: links that connect what is connected, not every pair of it.

    ``fps`` holds ``n`` different fingerprints in a column ``fp``.
    """
    shards = split_hot(shard_rows(fps, n, radius)).repartition("shard").sortWithinPartitions("shard", "fp")
    return shards.mapInArrow(_link_batches(radius), "a bigint, b bigint").distinct()


def _link_batches(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, carried = [], [], (np.empty(0, np.int64), np.empty(0, np.int64))
        for last, (shard, fp) in _flagged(_columns(batches)):
            shard, fp = np.concatenate((carried[0], shard)), np.concatenate((carried[1], fp))
            bounds = np.flatnonzero(np.diff(shard)) + 1
            stop = len(shard) if last else (bounds[-1] if len(bounds) else 0)
            carried = (shard[stop:], fp[stop:])
            runs = np.concatenate(([0], bounds[bounds < stop], [stop])).tolist() if stop else [0]
            values = fp.view(np.uint64).tolist()
            for start, end in zip(runs, runs[1:]):
                if end - start > 1:
                    for x, y in shard_links(values[start:end], radius):
                        a.append(x)
                        b.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (a, b)], names=["a", "b"]
            )
            a, b = [], []

    return run


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        yield batch.column("shard").to_numpy(), batch.column("fp").to_numpy()


def _flagged(items: Iterator) -> Iterator:
    """Each item with whether it is the last."""
    items = iter(items)
    for item in items:
        for following in items:
            yield False, item
            item = following
        yield True, item


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links from each value to one of its component, found with a BK-tree.

    A subtree whose nodes are all in the searching value's component cannot add to it and is
    not entered; that keeps a shard of near copies from being compared pair by pair.
    """
    parent = list(range(len(values)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    children: list[dict[int, int]] = [{}]
    uniform = [True]
    for i in range(1, len(values)):
        x, own = values[i], i
        stack = [0]
        while stack:
            k = stack.pop()
            if uniform[k] and find(k) == own:
                continue
            d = (x ^ values[k]).bit_count()
            if d <= radius:
                root = find(k)
                if root != own:
                    low, high = (root, own) if root < own else (own, root)
                    parent[high] = own = low
            for e, c in children[k].items():
                if -radius <= e - d <= radius:
                    stack.append(c)
        k = 0
        while True:
            if uniform[k] and find(k) != own:
                uniform[k] = False
            d = (x ^ values[k]).bit_count()
            down = children[k].get(d)
            if down is None:
                children[k][d] = i
                break
            k = down
        children.append({})
        uniform.append(True)
    return [(values[find(i)], values[i]) for i in range(len(values)) if find(i) != i]


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component; roots themselves have no row.

    Alternates the large-star and small-star steps: each node's neighbours are linked to the
    smallest of them, until every edge ends in its root. Steps are written to the shared folder.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), label)
    seen = None
    while True:
        edges = written(_small_star(_large_star(edges)), label)
        total = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(total) == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(total)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest id of the row's component."""
    marked = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    found = links(distinct.select("fp"), distinct.count(), radius)
    rooted = components(found).select(F.col("node").alias("fp"), "root")
    members = distinct.join(rooted, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(members.join(ids, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, radius: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` that lead their component: one row per component.

    Rows without an id stay, as nothing tells them apart. Of rows of a component that share the
    leading id the one with the smallest text stays, a null text last.
    """
    texts = docs.select(F.xxhash64("text").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    keyed = docs.where("doc_id IS NOT NULL").groupBy(F.xxhash64("text").alias("text_key")).agg(F.min(F.col("doc_id").cast("bigint")).alias("first_id"))
    prints = fingerprints(texts, shingle).distinct().select(F.col("doc_id").alias("text_key"), "fp")
    marked = written(keyed.join(prints, "text_key"), "fingerprints")
    distinct = written(marked.select("fp").distinct(), "distinct")
    rooted = components(links(distinct, distinct.count(), radius)).select(F.col("node").alias("fp"), "root")
    members = marked.join(rooted, "fp", "left").select("text_key", "first_id", F.coalesce("root", "fp").alias("root"))
    return leaders(docs, members)


def leaders(docs: DataFrame, members: DataFrame) -> DataFrame:
    """One row of ``docs`` per ``root``, and the rows without an id.

    ``members`` has for every different text with an id its hash as ``text_key``, the smallest id
    with that text as ``first_id``, and ``root``, which is the same throughout a component.
    """
    members = written(members, "members")
    ids = members.groupBy("root").agg(F.min("first_id").alias("first_id"))
    leading = members.join(ids, ["root", "first_id"]).select("root", F.col("first_id").alias("leading_id"), F.col("text_key").alias("leading_key"))
    leading = leading.hint("merge")
    same = (docs["doc_id"] == leading["leading_id"]) & (F.xxhash64(docs["text"]) == leading["leading_key"])
    row = F.struct(*(docs[c] for c in docs.columns))
    kept = docs.join(leading, same).select("root", row.alias("row"))
    plain = [F.col(f"row.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    order = F.struct(F.col("row.text").isNull(), F.col("row.text"), F.xxhash64(*plain))  # never null, as min_by skips nulls
    first = kept.groupBy("root").agg(F.min_by("row", order).alias("row")).select("row.*")
    return first.unionByName(docs.where("doc_id IS NULL"))
