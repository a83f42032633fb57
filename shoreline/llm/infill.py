"""Fill-in-the-middle texts, put together by a secondary sort of pieces.

Each text is cut at two drawn places between its units (runs of A-Z and a-z, or one other
character) into prefix, middle and suffix, and each of these into pieces of whole units, up to
``PIECE_BYTES`` long; a longer unit is cut between characters. A piece carries its document and
its position in the output. Pieces are repartitioned by document and sorted by position inside
the partitions, so a stream over a partition meets every output in its order and never holds
more than a piece of it: digests grow piece by piece. To restore the texts the stream is cut
again at the marks it meets, and the parts are sorted back by their place in the text. That
second sort stays inside the partitions, as the documents lie together already: texts are
shuffled once.

The output is ``<P>prefix<S>suffix<M>middle`` (form ``psm``), ``<S>suffix<P>prefix<M>middle``
(``spm``) or the text as it is (``plain``): texts that are empty or hold a mark, and a share of
the others. Cuts and forms come from the SHA-256 of a seed and the document's id, so they are
the same in every run. The marks are the only ``<P>``, ``<S>`` and ``<M>`` in an output that is
not plain, which makes restoring exact.

Edge cases. A null text is an empty one; a null id draws like an empty one. Rows that repeat or
share an id are transformed each on its own, by a row number that follows from the file and the
row in it. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from shoreline.llm.common import SLICE_BYTES, slices

PIECE_BYTES = 32 << 10

# The marks, the parts they begin (numbered as in the text), and their orders.
MARKS = {b"<P>": 0, b"<M>": 1, b"<S>": 2}
ORDERS = {"psm": (b"<P>", b"<S>", b"<M>"), "spm": (b"<S>", b"<P>", b"<M>"), "plain": ()}

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_IS_LETTER = np.isin(np.arange(256), np.frombuffer(_LETTERS, np.uint8))
_SUMMARY = 3  # sorts behind the parts

_ABOUT = ["row", "id", "n", "form", "prefix_chars", "middle_chars"]


def _about_schema(docs: DataFrame, id_column: str) -> list[StructField]:
    kinds = [LongType(), docs.schema[id_column].dataType, LongType(), StringType(), LongType(), LongType()]
    return [StructField(name, kind) for name, kind in zip(_ABOUT, kinds)]


def _starts(text: bytes, begin: int, end: int) -> np.ndarray:
    """Where units begin in a stretch of a text."""
    stretch = np.frombuffer(text, np.uint8, end - begin, begin)
    letter = _IS_LETTER[stretch]
    after = np.concatenate(([begin > 0 and bool(_IS_LETTER[text[begin - 1]])], letter[:-1]))
    return np.flatnonzero(((stretch & 0xC0) != 0x80) & ~(letter & after)) + begin


class Units:
    """Number and places of a text's units; only numbers per stretch of ``SLICE_BYTES`` are held."""

    def __init__(self, text: bytes):
        self.text = text
        self.stretches = [(at, min(at + SLICE_BYTES, len(text))) for at in range(0, len(text), SLICE_BYTES)]
        self.last = (0, _starts(text, *self.stretches[0])) if text else (0, np.empty(0, np.int64))
        rest = [len(_starts(text, *stretch)) for stretch in self.stretches[1:]]
        self.upto = np.cumsum([len(self.last[1]), *rest])

    def __len__(self) -> int:
        return int(self.upto[-1])

    def offset(self, unit: int) -> int:
        """The byte at which a unit begins, or the end of the text."""
        if unit == len(self):
            return len(self.text)
        stretch = int(np.searchsorted(self.upto, unit, "right"))
        if self.last[0] != stretch:
            self.last = (stretch, _starts(self.text, *self.stretches[stretch]))
        return int(self.last[1][unit - (self.upto[stretch - 1] if stretch else 0)])


def _characters(text: bytes, begin: int, end: int) -> int:
    cuts = range(begin, end, SLICE_BYTES)
    return sum(int(np.count_nonzero((np.frombuffer(text, np.uint8, min(SLICE_BYTES, end - at), at) & 0xC0) != 0x80)) for at in cuts)


def chunks(text: bytes, begin: int, end: int, size: int) -> Iterator[bytes]:
    """Consecutive pieces of whole units; at least one, which may be empty."""
    while end - begin > size:
        cut = begin + size
        while text[cut] & 0xC0 == 0x80:
            cut -= 1
        whole = len(text[begin:cut].rstrip(_LETTERS)) if text[cut] in _LETTERS else 0
        cut = begin + whole if whole else cut
        yield text[begin:cut]
        begin = cut
    yield text[begin:end]


def laid_out(text: bytes, draws: tuple[int, int, int, int], plain: int, spm: int) -> tuple[tuple, Iterator[bytes]]:
    """Unit count, form and sizes of a text, and the pieces of its output in order."""
    units = Units(text)
    n = len(units)
    if not text or any(mark in text for mark in MARKS) or draws[2] % 100 >= 100 - plain:
        return (n, "plain", None, None), chunks(text, 0, len(text), PIECE_BYTES)
    first, second = sorted(units.offset(draw % (n + 1)) for draw in draws[:2])
    form = "spm" if draws[3] % 100 < spm else "psm"
    bounds = ((0, first), (first, second), (second, len(text)))

    def pieces() -> Iterator[bytes]:
        for mark in ORDERS[form]:
            for i, piece in enumerate(chunks(text, *bounds[MARKS[mark]], PIECE_BYTES)):
                yield piece if i else mark + piece

    return (n, form, _characters(text, 0, first), _characters(text, first, second)), pieces()


class _Gathered:
    """Rows put together to record batches of limited size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size >= SLICE_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [pa.array(column, kind) for column, kind in zip(zip(*self.rows), self.schema.types)]
            self.rows, self.size = [], 0
            yield pa.RecordBatch.from_arrays(columns, schema=self.schema)


def output_pieces(docs: DataFrame, id_column: str = "doc_id", *, plain: int = 10, spm: int = 20, seed: int = 1) -> DataFrame:
    """The pieces of each document's output, with ``position`` in it, not yet in order.

    ``plain`` is the percentage of texts that stay as they are, ``spm`` the percentage of the
    others whose suffix comes first. The columns before ``position`` say of the document its
    row, id, units, form and the characters of prefix and middle.
    """
    about = _about_schema(docs, id_column)
    schema = StructType([*about, StructField("position", IntegerType()), StructField("piece", BinaryType())])
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    draws = [F.conv(F.substr(digest, F.lit(1 + 8 * i), F.lit(8)), 16, 10).cast("bigint").alias(f"h{i}") for i in range(4)]
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), *draws, F.col("text").cast("binary").alias("text")
    )
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Gathered(arrow)
        for batch in batches:
            for part in slices(batch, "text"):
                for row, doc_id, *drawn, text in zip(*(column.to_pylist() for column in part.columns)):
                    facts, pieces = laid_out(text or b"", tuple(drawn), plain, spm)
                    for position, piece in enumerate(pieces):
                        yield from out.add((row, doc_id, *facts, position, piece), len(piece))
        yield from out.flush()

    return rows.mapInArrow(cut, schema)


def in_order(pieces: DataFrame) -> DataFrame:
    """The pieces of a document in one partition, one after the other."""
    return pieces.repartition("row").sortWithinPartitions("row", "position")


def _in_small(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch, column):
            yield from zip(*(c.to_pylist() for c in part.columns))


class Splitter:
    """Cuts an output that comes in pieces at its marks, which may lie across pieces."""

    def __init__(self, form: str):
        self.marks, self.part, self.held = list(ORDERS[form]), 0, b""

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        data = self.held + piece
        self.held = b""
        while self.marks:
            mark = self.marks[0]
            at = data.find(mark)
            if at < 0:
                keep = next((k for k in (2, 1) if data.endswith(mark[:k])), 0)
                data, self.held = data[: len(data) - keep], data[len(data) - keep :]
                break
            if at:
                yield self.part, data[:at]
            self.part, data = MARKS[mark], data[at + len(mark) :]
            self.marks.pop(0)
        if data:
            yield self.part, data

    def rest(self) -> Iterator[tuple[int, bytes]]:
        if self.held:
            yield self.part, self.held


def digests(pieces: DataFrame) -> DataFrame:
    """One row per document with the SHA-256 of its output and of the text restored from it."""
    about = pieces.schema.fields[: len(_ABOUT)]
    one = StructField("output_sha256", StringType())
    parts = [StructField("part", IntegerType()), StructField("place", LongType()), StructField("piece", BinaryType())]
    split_schema = StructType([*about, one, *parts])
    last_schema = StructType([*about, one, StructField("restored_sha256", StringType())])
    split_arrow, last_arrow, width = to_arrow_schema(split_schema), to_arrow_schema(last_schema), len(about)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current = _Gathered(split_arrow), None

        def end() -> Iterator[pa.RecordBatch]:
            if current is not None:
                for part, data in splitter.rest():
                    yield from out.add((*current, None, part, place, data), len(data))
                yield from out.add((*current, digest.hexdigest(), _SUMMARY, 0, b""))

        for *facts, _, piece in _in_small(batches, "piece"):
            if current is None or facts[0] != current[0]:
                yield from end()
                current, digest, splitter, place = facts, hashlib.sha256(), Splitter(facts[3]), 0
            digest.update(piece)
            for part, data in splitter.feed(piece):
                yield from out.add((*current, None, part, place, data), len(data))
                place += 1
        yield from end()
        yield from out.flush()

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, digest = _Gathered(last_arrow), hashlib.sha256()
        for *facts, output, part, _, piece in _in_small(batches, "piece"):
            if part == _SUMMARY:
                yield from out.add((*facts, output, digest.hexdigest()))
                digest = hashlib.sha256()
            else:
                digest.update(piece)
        yield from out.flush()

    parted = in_order(pieces).mapInArrow(split, split_schema)
    return parted.sortWithinPartitions("row", "part", "place").mapInArrow(restore, last_schema)


def outputs(pieces: DataFrame) -> DataFrame:
    """One row per document with its whole ``output`` text."""
    about = pieces.schema.fields[: len(_ABOUT)]
    schema = StructType([*about, StructField("output", StringType())])
    arrow = to_arrow_schema(schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, current, held = _Gathered(arrow), None, []
        for *facts, _, piece in _in_small(batches, "piece"):
            if current is not None and facts[0] != current[0]:
                text = b"".join(held)
                yield from out.add((*current, text.decode()), len(text))
                held = []
            current = facts
            held.append(piece)
        if current is not None:
            yield from out.add((*current, b"".join(held).decode()))
        yield from out.flush()

    return in_order(pieces).mapInArrow(join, schema)
