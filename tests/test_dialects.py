import pytest

from shoreline.sinks.delimited import write_delimited
from shoreline.sources.delimited import positional_schema, read_compressed, read_delimited, schema_from_names
from shoreline.sources.dialect import APOSTROPHE_DIALECT, BEL_DIALECT, TYPED_DIALECT, UNQUOTED_DIALECT

TEXTS = ["plain", "with\u0007bell", "it's", 'say "x"', "back\\slash", "'", '"', "\\", "two\nlines", "  padded  "]


@pytest.mark.parametrize("dialect", [BEL_DIALECT, APOSTROPHE_DIALECT], ids=["double", "apostrophe"])
def test_lossless_with_line_feeds(spark, tmp_path, dialect):
    dialect = dialect.with_(multiline=True, trim=False)
    df = spark.createDataFrame([(i, text, "end") for i, text in enumerate(TEXTS)], "id int, text string, tail string")
    write_delimited(df, str(tmp_path / "out"), dialect)
    back = read_delimited(spark, str(tmp_path / "out"), dialect, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_record_separator_keeps_line_feeds_without_multiline(spark, tmp_path):
    dialect = BEL_DIALECT.with_(record_sep="\u001e", trim=False)
    df = spark.createDataFrame([(i, text) for i, text in enumerate(TEXTS)], "id int, text string")
    write_delimited(df, str(tmp_path / "out"), dialect)
    assert sorted(read_delimited(spark, str(tmp_path / "out"), dialect, df.schema).collect()) == sorted(df.collect())


def write_text(path, text):
    path.write_text(text, newline="")
    return str(path)


def test_positional_trimmed_and_empty_is_null(spark, tmp_path):
    path = write_text(tmp_path / "a_data.dsv", "1\u0007  x y \u0007\u0007last\n2\u0007\u0007z\u0007 \n")
    df = read_delimited(spark, path)
    assert df.columns == ["_c0", "_c1", "_c2", "_c3"]
    assert set(df.dtypes) == {(f"_c{i}", "string") for i in range(4)}
    assert sorted(tuple(row) for row in df.collect()) == [("1", "x y", None, "last"), ("2", None, "z", None)]


def test_quoted_delimiters_and_line_feeds(spark, tmp_path):
    text = "1\u0007'it''s\u0007one'\n2\u0007'two\nlines'\n"
    path = write_text(tmp_path / "a_data.dsv", text)
    multi = read_delimited(spark, path, APOSTROPHE_DIALECT.with_(multiline=True))
    assert sorted(tuple(row) for row in multi.collect()) == [("1", "it's\u0007one"), ("2", "two\nlines")]
    assert read_delimited(spark, path, APOSTROPHE_DIALECT).count() == 3


def test_quotes_are_text_without_quoting(spark, tmp_path):
    path = write_text(tmp_path / "a_data.dsv", '1\u0007"x\n2\u0007y"z\n')
    rows = read_delimited(spark, path, UNQUOTED_DIALECT).collect()
    assert sorted(tuple(row) for row in rows) == [("1", '"x'), ("2", 'y"z')]


@pytest.mark.parametrize("dialect", [BEL_DIALECT, APOSTROPHE_DIALECT, UNQUOTED_DIALECT])
def test_empty_text_comes_back_as_null_and_a_blank_stays(spark, tmp_path, dialect):
    dialect = dialect.with_(trim=False)
    df = spark.createDataFrame([("1", "", "x"), ("2", None, "x"), ("3", " ", "x")], "a string, b string, c string")
    write_delimited(df, str(tmp_path / "out"), dialect)
    rows = read_delimited(spark, str(tmp_path / "out"), dialect).collect()
    assert sorted(tuple(row) for row in rows) == [("1", None, "x"), ("2", None, "x"), ("3", " ", "x")]


def test_types_are_inferred(spark, tmp_path):
    path = write_text(
        tmp_path / "a.csv", "1\u00072019-01-01:10:11:12\u00071.5\u0007true\u0007a\n2\u0007\u00072.5\u0007false\u0007b\n"
    )
    df = read_delimited(spark, path, TYPED_DIALECT)
    assert [kind for _, kind in df.dtypes] == ["int", "timestamp", "double", "boolean", "string"]
    assert str(df.filter("_c0 = 1").first()._c1) == "2019-01-01 10:11:12"


def test_compressed_files_are_read_and_spread(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id as string) a", "'x' b")
    write_delimited(df.coalesce(1), str(tmp_path / "gz"), compression="gzip")
    assert list((tmp_path / "gz").glob("*.csv.gz"))
    back = read_compressed(spark, str(tmp_path / "gz"), partitions=5)
    assert back.rdd.getNumPartitions() == 5
    assert sorted(back.collect()) == sorted(df.collect())


def test_schemas(spark):
    assert positional_schema(3).names == ["_c0", "_c1", "_c2"]
    assert schema_from_names("a b  c").simpleString() == "struct<a:string,b:string,c:string>"


def test_unquoted_output_refuses_what_it_cannot_hold(spark, tmp_path):
    for text in ("a\u0007b", "a\nb"):
        with pytest.raises(Exception, match="needs a dialect with quotes"):
            write_delimited(spark.createDataFrame([(text,)], "x string"), str(tmp_path / "out"), UNQUOTED_DIALECT)
