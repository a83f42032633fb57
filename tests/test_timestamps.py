import pytest
from pyspark.sql import functions as F

from shoreline.functions.timestamps import (
    BLANK_MODE,
    MODES,
    SENTINEL,
    SENTINEL_MODE,
    STRICT,
    as_timestamp,
    canonical_timestamp,
    canonical_timestamps,
    reformat_timestamp,
)

KNOWN = {
    "2019-01-01": "2019-01-01 00:00:00.000000",
    "2019-01-01:10:11:12": "2019-01-01 10:11:12.000000",
    "2019-01-01 10:11:12": "2019-01-01 10:11:12.000000",
    "2019-01-01:10:11:12.123456": "2019-01-01 10:11:12.123456",
    "2019-01-01 10:11:12.123456": "2019-01-01 10:11:12.123456",
    "2019-01-01T10:11:12": "2019-01-01T10:11:12.000000",
    "abcdefghij": "abcdefghij 00:00:00.000000",
}
UNKNOWN = ["", "junk", "2019-01-01 10:11", "2019-01-01 10:11:12.1234567"]


def results(spark, texts, column):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {row.text: row.out for row in df.select("text", column.alias("out")).collect()}


@pytest.mark.parametrize("mode", MODES.values(), ids=MODES)
def test_every_length(spark, mode):
    expected = KNOWN | {text: mode.replacement for text in UNKNOWN}
    assert results(spark, expected, canonical_timestamp("text", mode)) == expected


def test_null(spark):
    assert results(spark, [None], canonical_timestamp("text", SENTINEL_MODE)) == {None: SENTINEL}
    assert results(spark, [None], canonical_timestamp("text", BLANK_MODE)) == {None: " "}
    with pytest.raises(Exception, match="timestamp text is null"):
        results(spark, [None], canonical_timestamp("text", STRICT))


def test_validation_replaces_what_is_no_timestamp(spark):
    out = results(spark, ["abcdefghij", "2019-02-30", "2019-02-28"], canonical_timestamp("text", validate=True))
    assert out == {"abcdefghij": SENTINEL, "2019-02-30": SENTINEL, "2019-02-28": "2019-02-28 00:00:00.000000"}


def test_columns_change_in_one_projection(spark):
    df = spark.createDataFrame([("2019-01-01", "x", "junk")], "a string, b string, c string")
    out = canonical_timestamps(df, ["a", "c"])
    assert out.columns == ["a", "b", "c"]
    assert out.first() == ("2019-01-01 00:00:00.000000", "x", SENTINEL)
    assert "PythonUDF" not in out._jdf.queryExecution().toString()


def test_typed_and_reformatted(spark):
    typed = results(spark, ["2019-01-01 10:11:12.123456", "junk"], as_timestamp("text").cast("string"))
    assert typed == {"2019-01-01 10:11:12.123456": "2019-01-01 10:11:12.123456", "junk": None}
    out = results(
        spark, ["2019-01-01:10:11:12", "junk"], reformat_timestamp("text", "yyyy-MM-dd:HH:mm:ss", "dd.MM.yyyy HH:mm")
    )
    assert out == {"2019-01-01:10:11:12": "01.01.2019 10:11", "junk": None}


def test_sentinels_rank_below_dates(spark):
    df = spark.createDataFrame([(SENTINEL,), (" ",), ("2019-01-01 00:00:00.000000",)], "t string")
    assert df.orderBy(F.col("t").desc()).first().t.startswith("2019")
