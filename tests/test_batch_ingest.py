import glob
import os

import pytest

from shoreline.functions.timestamps import SENTINEL, SENTINEL_MODE
from shoreline.operators.profile import column_profile, partition_profile
from shoreline.plans.batch_ingest import IngestJob, deduplicated, run_all, run_ingest
from shoreline.plans.typed_ingest import run_typed_ingest
from shoreline.session import scratch_path, shared_folder, staged
from shoreline.sinks.delimited import DEFAULT_ROWS_PER_FILE, file_count, into_files
from shoreline.sinks.tables import append_report, load_table, read_audit, typed_columns
from shoreline.sources.delimited import read_delimited
from shoreline.sources.dialect import APOSTROPHE_DIALECT

ROWS = [
    "p1\u0007l1\u00072019-01-01\u00072019-01-01:10:11:12\u0007old",
    "p1\u0007l1\u00072019-01-02\u00072019-01-01:10:11:12\u0007'new\u0007er'",
    "p1\u0007l2\u0007junk\u00072019-01-01:10:11:12\u0007lone",
    "\u0007l1\u00072019-01-03\u0007\u0007first null key",
    "\u0007l1\u00072019-01-04\u0007\u0007second null key",
]
LATEST = {
    ("p1", "l1", "2019-01-02 00:00:00.000000", "2019-01-01 10:11:12.000000", "new\u0007er"),
    ("p1", "l2", " ", "2019-01-01 10:11:12.000000", "lone"),
    (None, "l1", "2019-01-04 00:00:00.000000", " ", "second null key"),
}


@pytest.fixture
def properties(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "pay_data.dsv").write_text("\n".join(ROWS) + "\n")
    return {
        "SRC_FILE_PATH": str(tmp_path / "in"),
        "SRC_FILE_NM": "pay_data.dsv",
        "TAR_FILE_PATH": str(tmp_path / "out"),
        "TAR_FILE_NM": "pay",
        "REPORT_FILE_PATH": str(tmp_path / "report"),
        "REPORT_FILE_NM": "pay",
        "TBL_NAME": "PAY",
        "TIME_COLS": "_c2,_c3",
        "Dedup_Key": "_c0, _c1",
        "Dedup_order_Key": "_c2 ,_c3",
        "MVAL": "true",
        "PART_CAL_VAL": "2",
    }


def output(spark, job):
    return {tuple(row) for row in read_delimited(spark, job.target, job.dialect.with_(trim=False)).collect()}


def test_from_descriptor_to_files_and_report(spark, properties, tmp_path):
    job = IngestJob.from_properties(properties, audit=str(tmp_path / "audit"), exact_files=True)
    assert job.dialect.multiline and job.rows_per_file == 2 and job.keys == ("_c0", "_c1")
    report = run_ingest(spark, job)
    assert report.collect() == [("pay_data.dsv", 3, 5, 2)]
    assert output(spark, job) == LATEST
    assert len(glob.glob(f"{job.target}/part-*")) == 2
    assert spark.read.csv(job.report).first() == ("pay_data.dsv", "3", "5", "2")
    trail = read_audit(spark, job.audit).orderBy("at").collect()
    assert [row.status for row in trail] == ["Started", "InProcessing", "Completed"]
    append_report(report, str(tmp_path / "all"))
    append_report(report, str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all")).count() == 2


@pytest.mark.parametrize("spread", [None, 3])
def test_written_in_the_same_pass(spark, properties, spread):
    job = IngestJob.from_properties(properties, exact_files=False, spread=spread)
    assert run_ingest(spark, job).collect() == [("pay_data.dsv", 3, 5, 2)]
    assert output(spark, job) == LATEST


def test_dated_extracts_stay_side_by_side(spark, properties):
    for stamp in ("2019-01-01_00_00_00", "2019-01-02_00_00_00", "2019-01-02_00_00_00"):
        job = IngestJob.from_properties(properties, stamp=stamp, timestamps=SENTINEL_MODE)
        run_ingest(spark, job)
    back = read_delimited(spark, job.target, job.dialect)
    assert back.groupBy("extract_date").count().count() == 2
    assert back.count() == 6 and back.filter(back._c2 == SENTINEL).count() == 2


def test_empty_source(spark, properties, tmp_path):
    (tmp_path / "in" / "pay_data.dsv").write_text("")
    for settings in ({}, {"exact_files": True}, {"width": 5}):
        report = run_ingest(spark, IngestJob.from_properties(properties, **settings))
        assert report.collect() == [("pay_data.dsv", 0, 0, 0)]


def test_records_of_another_width(spark, properties, tmp_path):
    wider, narrower = ROWS[2] + "\u0007more", "p9\u0007l9"
    (tmp_path / "in" / "pay_data.dsv").write_text("\n".join([*ROWS, wider, narrower]) + "\n")
    with pytest.raises(Exception, match="another width"):
        run_ingest(spark, IngestJob.from_properties(properties))
    job = IngestJob.from_properties(properties, quarantine=str(tmp_path / "aside"))
    assert run_ingest(spark, job).collect() == [("pay_data.dsv", 3, 5, 2)]
    assert output(spark, job) == LATEST
    assert sorted(r.record.strip() for r in spark.read.parquet(job.quarantine).collect()) == sorted([wider, narrower])


def test_targets_do_not_collide(properties):
    properties = {**properties, "TAR_FILE_NM": ""}
    names = {IngestJob.from_properties({**properties, "SRC_FILE_NM": name}).target for name in ("a", "b")}
    assert len(names) == 2


def test_jobs_share_audit_and_report_tables(spark, properties, tmp_path):
    audit, reports = str(tmp_path / "audit"), str(tmp_path / "reports")
    jobs = [IngestJob.from_properties({**properties, "TAR_FILE_NM": f"out{i}", "REPORT_FILE_NM": f"r{i}"}, audit=audit, reports=reports) for i in range(16)]
    assert all(not isinstance(r, Exception) for _, r in run_all(spark, jobs))
    assert read_audit(spark, audit).where("status = 'Completed'").count() == 16
    assert spark.read.parquet(reports).count() == 16


def test_a_failing_audit_does_not_fail_the_job(spark, properties, tmp_path):
    (tmp_path / "file").write_text("")
    job = IngestJob.from_properties(properties, audit=str(tmp_path / "file" / "audit"))
    with pytest.warns(UserWarning, match="audit"):
        assert run_ingest(spark, job).first().dedup_count == 3


def test_failure_is_noted_and_raised(spark, properties, tmp_path):
    job = IngestJob.from_properties({**properties, "SRC_FILE_NM": "missing"}, audit=str(tmp_path / "audit"))
    with pytest.raises(Exception, match="(?i)path"):
        run_ingest(spark, job)
    failed = read_audit(spark, job.audit).filter("status = 'failed'").first()
    assert failed.job == "missing" and "missing" in failed.error


def test_many_jobs_one_of_which_fails(spark, properties):
    jobs = [
        IngestJob.from_properties(properties),
        IngestJob.from_properties({**properties, "SRC_FILE_NM": "missing", "TAR_FILE_NM": "other"}),
    ]
    (_, report), (failed, reason) = run_all(spark, jobs)
    assert report.first().dedup_count == 3
    assert failed.name == "missing" and isinstance(reason, Exception)


def test_one_scan_and_one_shuffle(spark, properties):
    plan = deduplicated(spark, IngestJob.from_properties(properties))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Python" not in plan


@pytest.mark.parametrize("rows,per_file,files", [(0, 10, 1), (9, 10, 1), (10, 10, 2), (25, 10, 3)])
def test_file_count(rows, per_file, files):
    assert file_count(rows, per_file) == files
    assert file_count(DEFAULT_ROWS_PER_FILE) == 2


def test_into_files_goes_both_ways(spark):
    df = spark.range(0, 100, 1, 4)
    assert [into_files(df, n).rdd.getNumPartitions() for n in (1, 4, 9)] == [1, 4, 9]


def test_staged_table_goes_away(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(shared_folder(spark))
    with staged(spark.range(5).toDF("id"), "test") as rows:
        folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert rows.count() == 5 and glob.glob(folder)
    assert not glob.glob(folder)


def test_typed_ingest_leaves_an_audit_trail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1\u00072019-01-01:10:11:12\n")
    run_typed_ingest(
        spark, str(tmp_path / "a.csv"), str(tmp_path / "out"), schema="n int, at timestamp", audit=str(tmp_path / "audit")
    )
    assert len(glob.glob(str(tmp_path / "out" / "extract_date=*"))) == 1
    with pytest.raises(Exception):
        run_typed_ingest(spark, str(tmp_path / "none.csv"), str(tmp_path / "out"), audit=str(tmp_path / "audit"))
    trail = [row.status for row in read_audit(spark, str(tmp_path / "audit")).orderBy("at").collect()]
    assert trail == ["Started", "InProcessing", "Completed", "Started", "InProcessing", "failed"]


def test_table_is_replaced_with_the_declared_types(spark):
    df = spark.createDataFrame([("1", "x", "2019-01-01"), ("no", "y", "")], "_c0 string, _c1 string, _c2 string")
    for _ in range(2):
        load_table(df, "typed_rows", "n int, s string, d date")
    table = spark.table("typed_rows")
    assert [kind for _, kind in table.dtypes] == ["int", "string", "date"]
    assert sorted(table.collect(), key=str)[1][0] is None and table.count() == 2
    with pytest.raises(ValueError):
        typed_columns(df, "n int")


def test_profiles(spark):
    df = spark.createDataFrame([("2019-01-01",), (None,), ("",), ("2019-01-01 10:11:12",)], "t string")
    row = column_profile(df, ["t"]).first()
    assert (row.rows, row.nulls, row.dates, row.seconds, row.micros, row.unknown) == (4, 1, 1, 1, 0, 1)
    sizes = {r.partition: r.rows for r in partition_profile(spark.range(0, 10, 1, 2)).collect()}
    assert sizes == {0: 5, 1: 5}


def test_dialect_of_output_is_that_of_input(spark, properties):
    job = IngestJob.from_properties(properties)
    assert job.dialect.quote == APOSTROPHE_DIALECT.quote
    assert job.dialect.write_options()["quote"] == job.dialect.read_options()["quote"] == "'"


def test_an_empty_file_replaces_earlier_output_and_quarantine(spark, properties, tmp_path):
    (tmp_path / "in" / "pay_data.dsv").write_text("\n".join([*ROWS, "narrow"]) + "\n")
    for settings in ({}, {"exact_files": True}, {"stamp": "2021-01-01_00_00_00"}):
        job = IngestJob.from_properties({**properties, "TAR_FILE_NM": "pay" + "-".join(settings)}, quarantine=str(tmp_path / "aside"), **settings)
        text = (tmp_path / "in" / "pay_data.dsv").read_text()
        assert run_ingest(spark, job).first().dedup_count == 3
        assert spark.read.parquet(job.quarantine).count() == 1
        (tmp_path / "in" / "pay_data.dsv").write_text("")
        assert run_ingest(spark, job).first().dedup_count == 0
        assert spark.read.schema("_c0 string").option("recursiveFileLookup", True).csv(job.target).count() == 0
        assert spark.read.parquet(job.quarantine).count() == 0
        (tmp_path / "in" / "pay_data.dsv").write_text(text)


def test_same_names_in_two_folders_have_two_outputs(properties):
    properties = {**properties, "TAR_FILE_NM": ""}
    targets = {IngestJob.from_properties({**properties, "SRC_FILE_PATH": path}).target for path in ("/in/1", "/in/2", "hdfs://n/in/3")}
    assert len(targets) == 3 and all(t.startswith(properties["TAR_FILE_PATH"]) for t in targets)


def test_jobs_with_one_target_are_refused(spark, properties):
    job = IngestJob.from_properties(properties)
    with pytest.raises(ValueError, match="several jobs write to"):
        run_all(spark, [job, IngestJob.from_properties({**properties, "SRC_FILE_NM": "other"})])
    assert not glob.glob(f"{job.target}*")


def test_an_audit_trail_is_one_file_a_run(spark, properties, tmp_path):
    job = IngestJob.from_properties(properties, audit=str(tmp_path / "audit"))
    run_ingest(spark, job)
    assert len([f for f in os.listdir(job.audit) if f.endswith(".json")]) == 1
    rows = read_audit(spark, job.audit).orderBy("at").collect()
    assert [r.status for r in rows] == ["Started", "InProcessing", "Completed"] and all(r.at and r.error is None for r in rows)


def test_misfits_are_counted_while_loading(spark):
    df = spark.createDataFrame([("1", "x", "2019-01-01"), ("no", "y", "never"), (None, None, "")], "_c0 string, _c1 string, _c2 string")
    assert load_table(df, "typed_misfits", "n int, s string, d date") == {"n": 1, "s": 0, "d": 2}
    assert spark.table("typed_misfits").columns == ["n", "s", "d"] and spark.table("typed_misfits").count() == 3
