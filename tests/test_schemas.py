"""Schemas that grow with their records."""

import pytest
from pyspark.sql.types import DataType, StructType

from shoreline.sources.records import inferred_schema, parse_json
from shoreline.sources.schemas import VERSION_COLUMN, SchemaVersions, merged_schema, merged_type, read_versions


@pytest.mark.parametrize(
    "old, new, both",
    [
        ("int", "bigint", "bigint"),
        ("double", "bigint", "double"),
        ("bigint", "string", "string"),
        ("boolean", "bigint", "string"),
        ("date", "timestamp", "timestamp"),
        ("date", "bigint", "string"),
        ("array<int>", "array<double>", "array<double>"),
        ("array<int>", "int", "string"),
        ("struct<a: int>", "struct<b: string, a: double>", "struct<a: double, b: string>"),
        ("struct<a: int>", "string", "string"),
        ("array<struct<a: int>>", "array<struct<b: int>>", "array<struct<a: int, b: int>>"),
        ("void", "int", "int"),
        ("int", "void", "int"),
    ],
)
def test_types_are_brought_together(spark, old, new, both):
    first, second, expected = map(DataType.fromDDL, (old, new, both))
    assert merged_type(first, second).simpleString() == expected.simpleString()
    if not isinstance(first, StructType) and "struct" not in old:
        assert merged_type(second, first) == merged_type(first, second)


def test_merging_again_changes_nothing(spark):
    one, two = StructType.fromDDL("a int, b struct<x: int>"), StructType.fromDDL("c string, b struct<y: date>, a string")
    both = merged_schema(one, two)
    assert merged_schema(both, one) == merged_schema(both, two) == merged_schema(both, both) == both


def test_versions_and_their_rows(spark, tmp_path):
    versions, path = SchemaVersions(spark, str(tmp_path / "schemas")), str(tmp_path / "rows")
    assert versions.all() == {}
    batches = [
        ['{"id": 1, "v": 5, "who": {"n": 7}, "many": [1, 2]}'],
        ['{"id": 2, "v": 5}'],
        ['{"id": 3, "v": 0.5, "new": "x", "who": {"m": "q"}}', '{"id": 4, "many": [2.5]}'],
        ['{"id": 5, "v": "text", "who": "nobody"}'],
    ]
    numbers = []
    for batch in batches:
        records = spark.createDataFrame([(t,) for t in batch], "value string")
        number, schema = versions.grow(inferred_schema(records))
        parsed = records.select(parse_json("value", schema).alias("r")).select(*[f"r.{n}" for n in schema.names])
        parsed.write.mode("append").parquet(f"{path}/{VERSION_COLUMN}={number}")
        numbers.append(number)
    assert numbers == [1, 1, 2, 3]
    rows = {r.id: r for r in read_versions(spark, path, versions).collect()}
    assert {i: (r.v, r.new, r.schema_version) for i, r in rows.items()} == {
        1: ("5", None, 1), 2: ("5", None, 1), 3: ("0.5", "x", 2), 4: (None, None, 2), 5: ("text", None, 3),
    }
    assert rows[1].who == '{"n":7}' and rows[3].who == '{"m":"q"}' and rows[5].who == "nobody" and rows[2].who is None
    assert rows[1].many == [1.0, 2.0] and rows[4].many == [2.5]
