import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shoreline.functions.schematypes import ddl_type
from shoreline.functions.stamps import file_stamp, joined_path, trimmed_list
from shoreline.operators.manifest import derive_names, job_table, match_companions, number_files, with_settings, without_settings
from shoreline.operators.union import union_requests
from shoreline.plans.batch_ingest import jobs_from
from shoreline.queries.files import land_files, landing_to_ingest
from shoreline.sources.landing import list_landed
from shoreline.sources.listing import listed
from shoreline.sources.properties import job_properties, property_lines, read_descriptors
from shoreline.sources.schema_files import read_schema_files, schema_columns, schema_ddl

FULL = "ab_cd_CUSTOMER_ORD_20190101_120000_001_data.dsv"


@pytest.fixture
def landing(tmp_path):
    sub = tmp_path / "day 1+2%"
    sub.mkdir()
    files = {
        tmp_path / FULL: "x",
        tmp_path / "PROD4.CUSTOMER_ORD.schema": "x",
        tmp_path / "ab_cd_CUSTOMER_ORD_20190101_120000_001.stats": "x",
        sub / "ab_cd_OTHER_20190101_120000_002_data.dsv": "x",
        sub / "a_data.dsv": "",
        sub / "PROD4.EMPTY.schema": "",
        sub / "empty one.stats": "",
        sub / "unrelated.txt": "x",
    }
    for path, text in files.items():
        path.write_text(text)
    return tmp_path


def test_inventory(spark, landing):
    rows = {row.path: row for row in list_landed(spark, str(landing)).collect()}
    short = {path.removeprefix(str(landing) + "/"): (row.kind, row.length, row.zero_byte) for path, row in rows.items()}
    assert short == {
        FULL: ("data", 1, False),
        "PROD4.CUSTOMER_ORD.schema": ("schema", 1, False),
        "ab_cd_CUSTOMER_ORD_20190101_120000_001.stats": ("stats", 1, False),
        "day 1+2%/ab_cd_OTHER_20190101_120000_002_data.dsv": ("data", 1, False),
        "day 1+2%/a_data.dsv": ("data", 0, True),
        "day 1+2%/PROD4.EMPTY.schema": ("schema", 0, True),
        "day 1+2%/empty one.stats": ("stats", 0, True),
    }


def test_inventory_does_not_read_contents(spark, landing):
    plan = list_landed(spark, str(landing))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_names(spark):
    df = spark.createDataFrame([(f"/in/{FULL}",), ("/in/a_data.dsv",), ("/in/a_b_c_d_e_data.dsv",)], "path string")
    rows = {row.file_name: row for row in derive_names(df).collect()}
    full = rows[FULL]
    assert (full.table_name, full.schema_name, full.stats_name, full.folder) == (
        "CUSTOMER_ORD",
        "PROD4.CUSTOMER_ORD.schema",
        "ab_cd_CUSTOMER_ORD_20190101_120000_001.stats",
        "/in",
    )
    assert rows["a_data.dsv"].table_name is None and rows["a_data.dsv"].schema_name is None
    assert rows["a_data.dsv"].stats_name == "a.stats"
    assert rows["a_b_c_d_e_data.dsv"].table_name is None


def test_companions_and_jobs(spark, landing):
    matched = match_companions(list_landed(spark, str(landing)))
    found = {row.file_name: (row.has_schema, row.has_stats, row.zero_byte) for row in matched.collect()}
    assert found == {
        FULL: (True, True, False),
        "ab_cd_OTHER_20190101_120000_002_data.dsv": (False, False, False),
        "a_data.dsv": (False, False, True),
    }
    jobs = job_table(matched, target_path="/out").orderBy("source_file").collect()
    assert [row.tbl_id for row in jobs] == ["100", "200", "300"]
    assert jobs[0].source_file == f"{landing}/{FULL}" and jobs[0].TAR_FILE_PATH == "/out"


def test_numbers_follow_path_order_over_many_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select(F.concat(F.lit("/x/"), F.reverse(F.col("id").cast("string"))).alias("path"))
    rows = number_files(df).collect()
    places = [int(row.tbl_id.removesuffix("00")) for row in sorted(rows, key=lambda row: row.path)]
    assert sorted(places) == list(range(1, 1001))
    paths = [row.path for row in sorted(rows, key=lambda row: int(row.tbl_id.removesuffix("00")))]
    assert paths == sorted(paths)


@pytest.mark.parametrize("separator", ["=", "|"])
def test_descriptors(spark, tmp_path, separator):
    lines = ["TBL_NAME|A", "SRC_FILE_PATH|/in", "SRC_FILE_NM|x|y=z", "TAR_FILE_PATH|/out", "TAR_FILE_NM|a"]
    lines += ["TIME_COLS|", "Dedup_Key| _c0,_c1 ", "Dedup_order_Key|_c2", "no separator", "TBL_NAME|B"]
    text = "\n".join(line.replace("|", separator, 1) for line in lines)
    (tmp_path / "job_a.properties").write_text(text)
    (tmp_path / "job_b.properties").write_text(f"TBL_NAME{separator}C\r\nMVAL{separator}true\r\n")
    rows = job_properties(read_descriptors(spark, str(tmp_path)), separator).collect()
    jobs = {row.job: row.asDict() for row in rows}
    assert jobs["job_a.properties"]["TBL_NAME"] == "B"
    assert jobs["job_a.properties"]["SRC_FILE_NM"] == "x|y=z"
    assert jobs["job_a.properties"]["TIME_COLS"] == ""
    assert jobs["job_a.properties"]["MVAL"] is None
    assert jobs["job_b.properties"]["MVAL"] == "true"
    only_a = read_descriptors(spark, str(tmp_path / "job_a*"))
    (job,) = jobs_from(job_properties(only_a, separator))
    kept = [(r.line, r.key) for r in property_lines(only_a, separator).collect() if r.key == "TBL_NAME"]
    assert kept == [(0, "TBL_NAME"), (9, "TBL_NAME")]
    assert (job.source, job.keys, job.time_columns) == ("/in/x|y=z", ("_c0", "_c1"), ())


SCHEMA_TEXT = """record
{ final_delim=end }
(
  id: int32;
  name : nullable string[max=20];
  at: timestamp[microseconds];
  day: date;
  price: decimal[10,2];
  odd: blob;
)
"""


def test_schema_file(spark, tmp_path):
    (tmp_path / "PROD4.A.schema").write_text(SCHEMA_TEXT)
    files = read_schema_files(spark, str(tmp_path))
    rows = [(r.position, r.column_name, r.type) for r in schema_columns(files).orderBy("position").collect()]
    assert rows == [
        (0, "id", "int"),
        (1, "name", "string"),
        (2, "at", "timestamp"),
        (3, "day", "date"),
        (4, "price", "decimal(10,2)"),
        (5, "odd", "blob"),
    ]
    assert schema_ddl(files).first().ddl.startswith("`id` int, `name` string, `at` timestamp")


def test_types(spark):
    names = ["int", "uint64", "nullable int16", "string[20]", "timestamp[ms]", "date32", "double"]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    expected = ["int", "int", "int", "string", "timestamp", "date", "double"]
    assert [row.out for row in df.select(ddl_type("t").alias("out")).collect()] == expected


def test_lists_paths_and_stamps(spark):
    df = spark.createDataFrame([(" a, b ,c", "/x", "y")], "l string, d string, f string")
    assert df.select(trimmed_list("l"), joined_path("d", "f")).first() == (["a", "b", "c"], "/x/y")
    stamp = df.select(file_stamp(F.lit("2021-06-15 08:05:30").cast("timestamp"))).first()[0]
    assert stamp == "2021-06-15_08_05_30"


def test_union(spark):
    sources = {"a": spark.range(2), "b": spark.range(3).withColumn("x", F.lit("b")), "c": spark.range(9)}
    rows = union_requests(sources, "a, b,a")
    assert rows.columns == ["id", "source", "x"]
    assert {(r.source, r["count"]) for r in rows.groupBy("source").count().collect()} == {("a", 4), ("b", 3)}
    for bad in ("a,z", " "):
        with pytest.raises(ValueError):
            union_requests(sources, bad)


def test_names_that_spark_hides_are_listed(spark, tmp_path):
    for name in ("_x_data.dsv", ".y_data.dsv", "z_data.dsv"):
        (tmp_path / "in" / "deep").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / "deep" / name).write_text("a")
    found = list_landed(spark, str(tmp_path / "in")).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in found) == [".y_data.dsv", "_x_data.dsv", "z_data.dsv"]


def test_folders_are_listed_level_by_level(spark, tmp_path):
    expected = set()
    for i in range(30):
        folder = tmp_path / f"d{i % 3}" / f"_e{i % 5}" / f"f {i}%"
        folder.mkdir(parents=True)
        for j in range(i % 4):
            (folder / f".{j}_data.dsv").write_text("x" * j)
            expected.add((str(folder / f".{j}_data.dsv"), j))
    (tmp_path / "empty").mkdir()
    found = listed(spark, [str(tmp_path / "d0"), f"file://{tmp_path}/d1", f"{tmp_path}/d2/", str(tmp_path / "empty")])
    assert {(r.path, r.length) for r in found.collect()} == expected
    assert listed(spark, []).count() == 0
    with pytest.raises(Exception, match="(?i)no such|not exist|not found"):
        listed(spark, [str(tmp_path / "missing")]).count()


def test_folders_are_dealt_to_several_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "a_data.dsv").write_text("x")
    spark.sparkContext.setJobGroup("listing", "")
    listed(spark, [str(tmp_path)])
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) >= 16


def test_settings_of_tables(spark):
    jobs = spark.createDataFrame([("A", "/in/1"), ("B", "/in/2"), (None, "/in/3")], "TBL_NAME string, SRC_FILE_PATH string")
    settings = spark.createDataFrame([("A", "_c0"), ("C", "_c1"), (None, "_c2")], "TBL_NAME string, Dedup_Key string")
    assert [tuple(r) for r in with_settings(jobs, settings).collect()] == [("A", "/in/1", "_c0")]
    assert sorted(r.SRC_FILE_PATH for r in without_settings(jobs, settings).collect()) == ["/in/2", "/in/3"]
    with pytest.raises(ValueError, match="several settings for A"):
        with_settings(jobs, settings.union(settings))


def test_files_land_without_a_sort(spark, tmp_path, monkeypatch):
    """A partitioned write would sort all rows of a file in the memory of its task."""

    def sorting(*args):
        raise AssertionError("a partitioned write")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", sorting)
    flags = "NARNNRAN"
    lines = [(i // 3, i % 7, i % 5, i % 4, flags[i % 8]) for i in range(400)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([("X",)], "n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    expected = {}
    for order, part, supplier, number, flag in lines:
        key = (f"LINES_{flag}", "odd" if order % 2 else "even", 1 + number % 2, str(part), str(supplier))
        expected[key] = max(expected.get(key, ""), str(order))
    found = [tuple(r) for r in landing_to_ingest(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted([*[(*k, v) for k, v in expected.items()], ("NATIONS", "unknown", 1, None, None, None)], key=str)


def test_each_file_holds_its_lines_in_one_piece(spark, tmp_path):
    rows = spark.range(0, 3000, 1, 6).select(
        F.concat(F.lit("d/f"), (F.col("id") % 13).cast("string"), F.lit("_data.dsv")).alias("file"), F.col("id").cast("string").alias("value")
    )
    land_files(spark, rows, str(tmp_path / "root"))
    found = {f.name: sorted(map(int, f.read_text().split())) for f in (tmp_path / "root" / "d").iterdir() if f.suffix == ".dsv" and f.name[0] != "."}
    assert found == {f"f{k}_data.dsv": [*range(k, 3000, 13)] for k in range(13)}
