"""Types found in one pass, beside those that Spark's own inference finds."""

from pyspark.sql import functions as F

from shoreline.plans.batch_ingest import IngestJob, run_ingest
from shoreline.sources.delimited import read_delimited
from shoreline.sources.dialect import TYPED_DIALECT, Dialect
from shoreline.sources.types import fitting_kinds, inferred_types

COLUMNS = {
    "whole": ["1", "-20", "", "300"],
    "long": ["1", "3000000000", "-1", "0"],
    "fraction": ["1", "2.5", "", "-0.25"],
    "exponent": ["1e3", "2", "-3.5E-2", ""],
    "day_first": ["2019-01-01:10:11:12", "2020-02-29:00:00:00", "", "2021-12-31:23:59:59"],
    "flag": ["true", "FALSE", "", "false"],
    "words": ["a", "1", "true", ""],
    "nothing": ["", "", "", ""],
    "almost": ["1", "2", "x", "4"],
    "mixed_flag": ["true", "1", "false", "0"],
}


def written(tmp_path, columns, name="rows.csv"):
    lines = ["\u0007".join(row) for row in zip(*columns.values())]
    (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path / name)


def test_types_equal_those_of_spark(spark, tmp_path):
    path = written(tmp_path, COLUMNS)
    own = inferred_types(spark, path, TYPED_DIALECT)
    assert [f.dataType for f in own] == [f.dataType for f in read_delimited(spark, path, TYPED_DIALECT).schema]
    typed = read_delimited(spark, path, TYPED_DIALECT.with_(infer=False), own)
    assert sorted(map(str, typed.collect())) == sorted(map(str, read_delimited(spark, path, TYPED_DIALECT).collect()))


def test_dates_and_timestamps_without_a_pattern(spark, tmp_path):
    path = written(tmp_path, {"day": ["2019-01-01", "2020-02-29"], "time": ["2019-01-01 10:11:12", "2019-01-01"], "bad": ["2019-02-30", "2019-01-01"]})
    assert [f.dataType.simpleString() for f in inferred_types(spark, path, Dialect(infer=True))] == ["date", "timestamp", "string"]


def test_every_text_counts(spark):
    """One text among many, in any partition, decides."""
    rows = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") == 13_579, "x").otherwise(F.col("id").cast("string")).alias("a"), F.lit(None).cast("string").alias("b"))
    found = fitting_kinds(rows, TYPED_DIALECT).first()
    assert (found.a, found.b) == ([], None)
    assert fitting_kinds(rows.where("a <> 'x'"), TYPED_DIALECT).first().a == ["int", "bigint", "double"]


def test_an_empty_source_has_no_types(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert len(inferred_types(spark, str(tmp_path / "none.csv"), TYPED_DIALECT)) == 0
    job = IngestJob(str(tmp_path / "none.csv"), str(tmp_path / "out"), ("_c0",), ("_c1",), name="none", dialect=TYPED_DIALECT)
    assert run_ingest(spark, job).collect() == [("none", 0, 0, 0)]


def jobs_run(spark, work):
    """How many Spark jobs a piece of work starts."""
    context, group = spark.sparkContext, f"count-{id(work)}"
    context.setJobGroup(group, "")
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_types_take_one_pass_of_a_job_and_none_when_kept(spark, tmp_path):
    path = written(tmp_path, {k: v * 50 for k, v in COLUMNS.items()})
    job = IngestJob(path, str(tmp_path / "out"), ("_c0",), ("_c1",), name="typed", dialect=TYPED_DIALECT)
    types = inferred_types(spark, path, TYPED_DIALECT)
    kept = IngestJob(path, str(tmp_path / "kept"), ("_c0",), ("_c1",), name="typed", dialect=TYPED_DIALECT, schema=types)
    reports = []
    found = jobs_run(spark, lambda: reports.append(run_ingest(spark, job)))
    given = jobs_run(spark, lambda: reports.append(run_ingest(spark, kept)))
    assert found - given <= 3  # a look at the first line and the aggregate's stages
    assert reports[0].collect() == reports[1].collect() and reports[0].first().dedup_count == 4
