"""JSON records, from files and inside text columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

CORRUPT_FIELD = "_corrupt_record"


def read_json_records(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None
) -> DataFrame:
    """Read JSON lines. Without ``schema`` Spark infers one from all records, in a pass of its own."""
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT_FIELD)
    return reader.json(path) if schema is None else reader.schema(with_corrupt_field(schema)).json(path)


def inferred_schema(records: DataFrame, value: str = "value") -> StructType:
    """A schema that holds all JSON texts of a column, found by one aggregation over them.

    A job of its own, to find the fixed schema that parsing then uses. Texts that are no JSON
    object do not count.
    """
    objects = records.where(F.ltrim(value).startswith("{")).select(F.col(value).alias("value"))
    found = objects.select(F.expr("schema_of_variant_agg(try_parse_json(value))")).first()[0] or ""
    if not found.startswith("OBJECT<"):
        return StructType([])
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], found)
    return _plain(StructType.fromDDL(f"record {ddl}")["record"].dataType)


def _plain(kind: DataType) -> DataType:
    """Text where types disagree or nothing but null was seen, and floating point for decimals."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain(f.dataType), True) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType), True)
    if isinstance(kind, DecimalType):
        return DoubleType()
    return StringType() if isinstance(kind, (VariantType, NullType)) else kind


def is_one_document(text: Column | str) -> Column:
    """Whether a text is one JSON document with nothing after it.

    As an array's only element it makes an array of one, and of two with another element
    behind it. Text after the document changes the first count or, where it closes the array
    early, keeps the second at one.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    followed = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]"))) == 2
    return F.coalesce(alone & followed, F.lit(False))


def parse_json(text: Column | str, schema: StructType | str) -> Column:
    """A struct with a fixed schema; a text that is no such record fills ``_corrupt_record``.

    A fixed schema keeps every micro-batch alike, where inference per batch would write
    files whose columns differ.
    """
    return F.from_json(
        text, with_corrupt_field(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_FIELD}
    )


def with_corrupt_field(schema: StructType | str) -> StructType:
    struct = as_struct(schema)
    if CORRUPT_FIELD in struct.names:
        return struct
    return StructType([*struct.fields, StructField(CORRUPT_FIELD, StringType(), True)])


def as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def narrow_schema(schema: StructType | str, paths: Iterable[str]) -> StructType:
    """Only the fields at the dotted paths, whole below each.

    The parser skips what a schema leaves out, which saves most of the work when few fields
    of a large record are wanted. Text that is no JSON is still found; a value of another
    type than declared is only noticed in fields that are kept.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    fields = []
    for field in as_struct(schema):
        below = wanted.get(field.name)
        if below is None:
            continue
        if isinstance(field.dataType, StructType) and "" not in below:
            field = StructField(field.name, narrow_schema(field.dataType, below), field.nullable)
            if not field.dataType.fields:
                continue
        fields.append(field)
    return StructType(fields)


def field_type(struct: DataType, path: str) -> DataType | None:
    """The type at a dotted path, or null where the schema has none."""
    current: DataType | None = struct
    for name in path.split("."):
        if not isinstance(current, StructType) or name not in current.names:
            return None
        current = current[name].dataType
    return current
