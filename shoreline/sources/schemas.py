"""Schemas that grow: a table of versions, and rows of all versions read by the newest.

Records whose fields change over time are parsed by the schema of their time and stored below
its version. A batch that brings something new makes the next version: fields are added, numbers
widened, and a field whose types cannot be brought together becomes text. No version takes a
field away, so every earlier row can be read by a later schema.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from shoreline.session import list_files, path_exists, read_text_file, replace_text_file

VERSION_COLUMN = "schema_version"

#: Types that a later one of the same row can hold.
WIDENING = ((IntegerType(), LongType(), DoubleType()), (DateType(), TimestampType()))


def merged_type(old: DataType, new: DataType) -> DataType:
    """The narrowest type that holds values of both; text where there is none."""
    if old == new or isinstance(new, NullType):
        return old
    if isinstance(old, NullType):
        return new
    if isinstance(old, StructType) and isinstance(new, StructType):
        return merged_schema(old, new)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merged_type(old.elementType, new.elementType), True)
    for row in WIDENING:
        if old in row and new in row:
            return row[max(row.index(old), row.index(new))]
    return StringType()


def merged_schema(old: StructType, new: StructType) -> StructType:
    """All fields of both, those of ``old`` first and in their order."""
    later = {field.name: field.dataType for field in new}
    kept = [StructField(f.name, merged_type(f.dataType, later.get(f.name, f.dataType)), True) for f in old]
    return StructType(kept + [StructField(f.name, f.dataType, True) for f in new if f.name not in old.names])


class SchemaVersions:
    """The versions of one kind of record, a small file each below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def all(self) -> dict[int, StructType]:
        if not path_exists(self.spark, self.path):
            return {}
        names = [re.search(r"v(\d+)\.json$", path) for path, _, _ in list_files(self.spark, self.path)]
        numbers = sorted(int(name[1]) for name in names if name)
        return {n: StructType.fromJson(json.loads(read_text_file(self.spark, self._file(n)))) for n in numbers}

    def grow(self, found: StructType) -> tuple[int, StructType]:
        """The version that holds ``found``: the newest one, or a next one where it brings something new."""
        versions = self.all()
        number = max(versions, default=0)
        schema = merged_schema(versions[number], found) if number else found
        if not number or schema != versions[number]:
            number += 1
            replace_text_file(self.spark, self._file(number), json.dumps(schema.jsonValue()))
        return number, schema

    def _file(self, number: int) -> str:
        return f"{self.path}/v{number:06}.json"


def as_type(value: Column, old: DataType, new: DataType) -> Column:
    """A value of an earlier version as the type a later one gives it."""
    if old == new:
        return value
    if isinstance(old, StructType) and isinstance(new, StructType):
        have = {field.name: field.dataType for field in old}
        fields = [
            (as_type(value[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return F.transform(value, lambda element: as_type(element, old.elementType, new.elementType))
    if isinstance(new, StringType) and isinstance(old, (StructType, ArrayType, MapType)):
        return F.to_json(value)
    return value.cast(new)


def read_versions(spark: SparkSession, path: str, versions: SchemaVersions) -> DataFrame:
    """Rows below ``schema_version=<n>`` of all versions, with the newest version's columns."""
    known = versions.all()
    newest = known[max(known)]
    rows = None
    for number, schema in known.items():
        folder = f"{path.rstrip('/')}/{VERSION_COLUMN}={number}"
        if not path_exists(spark, folder):
            continue
        part = spark.read.schema(schema).parquet(folder)
        have = {field.name: field.dataType for field in schema}
        columns = [
            (as_type(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in newest
        ]
        part = part.select(*columns, F.lit(number).alias(VERSION_COLUMN))
        rows = part if rows is None else rows.unionByName(part)
    return rows
