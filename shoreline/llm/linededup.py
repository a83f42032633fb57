"""Repeated lines, as one compressed keep bitmap per document.

Hashes of the lines are partitioned by range of (hash, document, position) and sorted so
inside each partition; a stream over a partition meets the first holder of each line first and
marks the lines of later documents. Ranges may cut the lines of one hash, so a hash that a
third of all documents hold is spread over many partitions. The first run of each partition
waits for the firsts of the runs at the partitions' ends: at most two rows per partition,
which is the bound of what is broadcast.

Only hashes and positions are shuffled. The texts meet the bitmaps in one join at the end.

A line's key is the line without white space (U+0020, U+0009 to U+000D) at both ends, with A-Z
in lower case. Keys of at least ``MIN_CHARS`` characters that are in two documents or more lose
all lines except those in the document with the smallest ``doc_id``.

Edge cases. A null or empty text is one empty line. Rows without ``doc_id`` keep all lines and
count for no other document. Rows that share a ``doc_id`` are one document for the choice of
the first. Further columns, whatever their names, go through unchanged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from shoreline.llm.common import ascii_lower, slices, unused_name, written

MIN_CHARS = 10
BLANKS = " \t\n\x0b\x0c\r"

_DROPPED, _WAITING, _FIRST = 0, 1, 2
_MARKS = "kind tinyint, h1 bigint, h2 bigint, doc_id bigint, place bigint"


def line_hashes(docs: DataFrame) -> DataFrame:
    """``h1``, ``h2``, ``doc_id`` and ``place`` (text hash and line number) of each line with a key."""
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.shiftleft(F.hash("text").cast("bigint"), 32).alias("tag"),
        F.posexplode_outer(F.split("text", "\n")).alias("number", "line"),
    )
    key = ascii_lower(F.btrim("line", F.lit(BLANKS)))
    keyed = texts.select("doc_id", (F.col("tag") + F.col("number")).alias("place"), key.alias("key"))
    keyed = keyed.where(F.char_length("key") >= MIN_CHARS)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "place")


def marked_lines(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``place`` of each line that goes."""
    order = ("h1", "h2", "doc_id", "place")
    # Written first: the sample that the ranges come from would hash every line a second time.
    hashes = written(line_hashes(docs), "line-hashes")
    ranged = hashes.repartitionByRange(*order).sortWithinPartitions(*order)
    marks = written(ranged.mapInArrow(_stream, _MARKS), "line-marks")
    firsts = marks.where(f"kind = {_FIRST}").groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"))
    waiting = marks.where(f"kind = {_WAITING}").join(F.broadcast(firsts), ["h1", "h2"])
    late = waiting.where("doc_id > first_id").select("doc_id", "place")
    return marks.where(f"kind = {_DROPPED}").select("doc_id", "place").union(late)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines after the first document of their run; the partition's first run waits."""
    run, first, opening = None, 0, True

    def emit(kind: int, *columns) -> pa.RecordBatch:
        arrays = [pa.array(np.asarray(c, np.int64)) for c in columns]
        kinds = pa.array(np.full(len(columns[0]), kind, np.int8))
        return pa.RecordBatch.from_arrays([kinds, *arrays], names=["kind", "h1", "h2", "doc_id", "place"])

    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc, place = (batch.column(i).to_numpy() for i in range(4))
        changes = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        changes[0] = (h1[0], h2[0]) != run
        starts = np.flatnonzero(changes)
        firsts = np.concatenate(([first], doc[starts]))[np.cumsum(changes)]
        head = 0
        if opening:  # all of the first run waits
            if run is None:
                yield emit(_FIRST, h1[:1], h2[:1], doc[:1], place[:1])
                run, starts = (h1[0], h2[0]), starts[1:]
            head = starts[0] if len(starts) else len(h1)
            opening = not len(starts)
            yield emit(_WAITING, h1[:head], h2[:head], doc[:head], place[:head])
        late = np.flatnonzero(doc[head:] > firsts[head:]) + head
        yield emit(_DROPPED, h1[late], h2[late], doc[late], place[late])
        run, first = (h1[-1], h2[-1]), firsts[-1]
    if run is not None and not opening:
        yield emit(_FIRST, [run[0]], [run[1]], [first], [0])


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tag`` and ``keep`` for each document that loses a line.

    ``keep`` is a deflated bitmap, first line first, 1 for a line that stays; lines past its
    end stay. ``tag`` is the hash of the text it belongs to.
    """
    tag = F.shiftright("place", 32).cast("int").alias("tag")
    lines = marked_lines(docs).select("doc_id", tag, F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("line"))
    return lines.groupBy("doc_id", "tag").agg(F.collect_set("line").alias("lines")).mapInArrow(
        _bitmap_batches, "doc_id bigint, tag int, keep binary"
    )


def _bitmap_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for lines in batch.column("lines"):
            gone = lines.values.to_numpy()
            keep = np.ones(gone.max() + 1, np.uint8)
            keep[gone] = 0
            maps.append(zlib.compress(np.packbits(keep).tobytes() + bytes([len(keep) % 8])))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(maps, pa.binary())], names=["doc_id", "tag", "keep"])


def dropped_lines(keep: bytes) -> set[int]:
    """Numbers of the lines that a bitmap drops."""
    plain = zlib.decompress(keep)
    bits = np.unpackbits(np.frombuffer(plain[:-1], np.uint8))
    size = len(bits) - (-plain[-1] % 8)
    return set(np.flatnonzero(bits[:size] == 0).tolist())


def without_repeats(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with the lines gone from ``text``; names of the added line and drop counts."""
    bitmaps = written(keep_bitmaps(docs), "keep-bitmaps")
    n_lines, n_dropped = unused_name(docs, "n_lines"), unused_name(docs, "n_dropped")
    keep, doc, tag = (unused_name(docs, name) for name in ("keep", "kept_id", "kept_tag"))
    bitmaps = bitmaps.toDF(doc, tag, keep).hint("merge")
    same = (docs["doc_id"] == bitmaps[doc]) & (F.hash(docs["text"]) == bitmaps[tag])
    joined = docs.join(bitmaps, same, "left").select(
        *(docs[c].cast("binary").alias(c) if c == "text" else docs[c] for c in docs.columns), keep
    )
    schema = StructType(
        [StructField(f.name, BinaryType()) if f.name == "text" else f for f in docs.schema.fields]
        + [StructField(n_lines, LongType()), StructField(n_dropped, LongType())]
    )
    at, names = docs.columns.index("text"), [*docs.columns, n_lines, n_dropped]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts, before, dropped = [], [], []
                for text, bits in zip(part.column(at).to_pylist(), part.column(len(names) - 2).to_pylist()):
                    gone = dropped_lines(bits) if bits else ()
                    if gone:
                        lines = text.split(b"\n")
                        before.append(len(lines))
                        text = b"\n".join([line for i, line in enumerate(lines) if i not in gone])
                    else:
                        before.append((text or b"").count(b"\n") + 1)
                    texts.append(text)
                    dropped.append(len(gone))
                columns = [*part.columns[:-1], pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
                columns[at] = pa.array(texts, pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    result = joined.mapInArrow(apply, schema)
    return result.withColumn("text", F.col("text").cast("string")), n_lines, n_dropped
