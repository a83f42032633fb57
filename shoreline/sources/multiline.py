"""Delimited files with line feeds inside quoted fields, read in splits.

Spark's own multi-line reading gives each file to one task, as a line's meaning depends on the
quotes before it. Here files are read as lines, split as any text. A first pass says of each
split whether it ends inside a quoted field if it begins outside of one, and if it begins
inside; from that, split by split along a file, follows how each one does begin. The second pass
puts lines together to records. Records that lie over a split's border are put together from
their fragments, at most two per split; Spark's ``from_csv`` parses the records. The second
pass runs once for the fragments, which are brought together, and once for all other records,
which stay where they are read: three readings by many tasks instead of one by a single task.

Both passes have to see the same splits: a second pass under other settings is an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoreline.session import scratch_path
from shoreline.sources.dialect import BEL_DIALECT, Dialect

_FLOW = "file string, start bigint, from_outside boolean, from_inside boolean"
_PIECE = "file string, start bigint, kind string, text string"
_ROWS = 4096
_WHOLE, _HEAD, _TAIL, _MIDDLE = "whole", "head", "tail", "middle"


def quote_flow(dialect: Dialect) -> Callable[[str, bool], bool]:
    """Whether a line ends inside a quoted field, given whether it begins inside of one.

    A quote opens a field only at its beginning; elsewhere in an unquoted field it is text.
    """
    quote, sep, escape = (re.escape(c) for c in (dialect.quote, dialect.sep, dialect.escape))
    blanks = r"[ \t]*" if dialect.trim else ""
    doubled = dialect.escape == dialect.quote
    inner = f"(?:{quote}{quote}|[^{quote}])*+" if doubled else f"(?:{escape}.|[^{quote}{escape}])*+"
    closed = re.compile(f"(^|{sep}){blanks}{quote}{inner}{quote}", re.DOTALL)
    opened = re.compile(f"(?:^|{sep}){blanks}{quote}{inner}{'' if doubled else escape + '?'}$", re.DOTALL)

    def ends_inside(line: str, inside: bool) -> bool:
        if dialect.quote not in line:
            return inside
        text = dialect.quote + line if inside else line
        return opened.search(closed.sub(r"\1", text)) is not None

    return ends_inside


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def _flows(dialect: Dialect):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flow = quote_flow(dialect)

        def rows() -> Iterator[tuple]:
            split, outside, inside = None, False, True
            for file, start, line in _lines(batches):
                if (file, start) != split:
                    if split:
                        yield (*split, outside, inside)
                    split, outside, inside = (file, start), False, True
                outside, inside = flow(line, outside), flow(line, inside)
            if split:
                yield (*split, outside, inside)

        yield from _batches(rows(), ["file", "start", "from_outside", "from_inside"], [pa.string(), pa.int64(), pa.bool_(), pa.bool_()])

    return run


def _pieces(dialect: Dialect):
    """Whole records, and the fragments at both ends of each split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flow = quote_flow(dialect)

        def rows() -> Iterator[tuple]:
            split, held, inside, first = None, [], False, False
            for file, start, line, begins_inside in _lines(batches):
                if (file, start) != split:
                    if held:
                        yield (*split, _MIDDLE if first else _TAIL, "\n".join(held))
                    split, held, inside, first = (file, start), [], begins_inside, begins_inside
                held.append(line)
                inside = flow(line, inside)
                if not inside:
                    yield (*split, _HEAD if first else _WHOLE, "\n".join(held))
                    held, first = [], False
            if held:
                yield (*split, _MIDDLE if first else _TAIL, "\n".join(held))

        yield from _batches(rows(), ["file", "start", "kind", "text"], [pa.string(), pa.int64(), pa.string(), pa.string()])

    return run


def split_beginnings(flows: DataFrame) -> DataFrame:
    """``file``, ``start`` and whether the split begins ``inside`` a quoted field.

    A split either sets the state, whatever it was, keeps it or turns it round. The state after
    it is what the last setting one left, turned round as often as splits did since.
    """
    along = Window.partitionBy("file").orderBy("start")
    upto, before = along.rowsBetween(Window.unboundedPreceding, 0), along.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("from_outside") & ~F.col("from_inside")
    sets = F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside").cast("int"))
    turned = flows.withColumn("turned", F.count_if(turns).over(upto)).withColumn("sets", sets)
    anchored = turned.withColumn("anchor", (F.col("sets") + F.col("turned")) % 2)
    anchor = F.coalesce(F.last("anchor", True).over(before), F.lit(0))
    state = (anchor + F.coalesce(F.lag("turned").over(along), F.lit(0))) % 2
    return anchored.select("file", "start", (state == 1).alias("inside"))


def multiline_records(spark: SparkSession, path: str | list[str], dialect: Dialect = BEL_DIALECT) -> DataFrame:
    """``record``: the text of each record, with its line feeds, without the one that ends it."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    if not dialect.quote:
        return lines.select(F.rtrim("value", F.lit("\r")).alias("record")).where("record <> ''")
    places = scratch_path(spark, "split-states")
    split_beginnings(lines.mapInArrow(_flows(dialect), _FLOW)).write.parquet(places)
    states = F.broadcast(spark.read.schema("file string, start bigint, inside boolean").parquet(places))  # a row per split
    other = F.raise_error(F.concat(F.lit("the splits have changed since they were looked at: "), "file")).cast("boolean")
    stated = lines.join(states, ["file", "start"], "left").select("file", "start", "value", F.coalesce("inside", other).alias("inside"))
    pieces = stated.mapInArrow(_pieces(dialect), _PIECE)
    whole = pieces.where(F.col("kind") == _WHOLE).select("text")
    fragments = pieces.where(F.col("kind") != _WHOLE)
    # A split's head comes before its tail, and a tail begins a record.
    order = [F.col("start"), F.when(F.col("kind") == _TAIL, 1).otherwise(0)]
    begun = F.count_if(F.col("kind") == _TAIL).over(Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    numbered = fragments.withColumn("record_no", begun).withColumn("order", F.struct(*order))
    parts = F.array_sort(F.collect_list(F.struct("order", "text")))
    stitched = numbered.groupBy("file", "record_no").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text"))
    texts = whole.unionByName(stitched.select("text"))
    return texts.select(F.rtrim("text", F.lit("\r")).alias("record")).where("record <> ''")


def read_multiline(
    spark: SparkSession, path: str | list[str], dialect: Dialect, schema: StructType | str, **options: str
) -> DataFrame:
    """Rows of files whose quoted fields may hold line feeds, each file read by as many tasks as it has splits."""
    ddl = schema if isinstance(schema, str) else schema.toDDL()
    own = {key: value for key, value in dialect.read_options().items() if key not in ("multiLine", "inferSchema", "lineSep")}
    options = {**own, **options}
    return multiline_records(spark, path, dialect).select(F.from_csv("record", F.lit(ddl), options).alias("row")).select("row.*")
