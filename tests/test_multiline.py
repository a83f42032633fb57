"""Multi-line records read in splits, beside Spark's reading of whole files."""

import random

import pytest

from shoreline.plans.batch_ingest import IngestJob, run_ingest
from shoreline.sinks.delimited import write_delimited
from shoreline.sources.delimited import read_delimited
from shoreline.sources.dialect import APOSTROPHE_DIALECT, BEL_DIALECT, UNQUOTED_DIALECT
from shoreline.sources.multiline import multiline_records, quote_flow, read_multiline, split_beginnings

DIALECTS = {"double": BEL_DIALECT, "apostrophe": APOSTROPHE_DIALECT}


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", DIALECTS)
@pytest.mark.parametrize("seed", range(2))
def test_rows_equal_those_of_whole_files(spark, tmp_path, small_splits, name, seed):
    rng, dialect = random.Random(seed), DIALECTS[name].with_(multiline=True, trim=False)
    alphabet = ["a", "b ", "\n", "\n\n", '"', "'", "\\", "\u0007", "é", "x" * 40]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(120)]
    texts += ["\n" * 700 + "long", "plain\nlines\n" * 90 + "end"]
    rows = spark.createDataFrame([(i, t, str(i)) for i, t in enumerate(texts)], "id bigint, text string, last string").coalesce(1)
    path = str(tmp_path / "rows")
    write_delimited(rows, path, dialect)
    schema = "id bigint, text string, last string"
    whole = {tuple(r) for r in read_delimited(spark, path, dialect, schema).collect()}
    split = read_multiline(spark, path, dialect, schema)
    assert {tuple(r) for r in split.collect()} == whole and split.count() == len(texts)
    assert multiline_records(spark, path, dialect).rdd.getNumPartitions() > 10


def test_one_file_in_several_tasks_keeps_its_texts(spark, tmp_path, small_splits):
    dialect = BEL_DIALECT.with_(multiline=True, trim=False)
    texts = [f"row {i}\n{'line ' * (i % 7)}\n, and \"quotes\"" for i in range(200)]
    path = str(tmp_path / "rows")
    write_delimited(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").coalesce(1), path, dialect)
    assert {r.id: r.text for r in read_multiline(spark, path, dialect, "id bigint, text string").collect()} == dict(enumerate(texts))


def test_line_ends_of_other_systems_blank_lines_and_no_quotes(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(b'1\x07"two\r\nlines"\r\n\r\n\r\n2\x07x\r\n3\x07"q"')
    rows = read_multiline(spark, str(tmp_path / "a.csv"), BEL_DIALECT, "id int, text string").collect()
    assert {(r.id, r.text.replace("\r", "")) for r in rows} == {(1, "two\nlines"), (2, "x"), (3, "q")}
    (tmp_path / "b.csv").write_text('1\u0007"open\n2\u0007x\n')
    assert read_multiline(spark, str(tmp_path / "b.csv"), UNQUOTED_DIALECT, "id int, text string").count() == 2


def test_quotes_open_only_at_the_beginning_of_a_field():
    flow = quote_flow(BEL_DIALECT)
    assert not flow('say "no', False) and flow('a\u0007"yes', False) and flow(' "yes', False)
    assert not flow('end"\u0007"whole"', True) and flow('end"\u0007"open', True) and flow(r"still \" in", True)
    assert flow("nothing", True) and not flow("nothing", False) and not flow(r'"a\\"', False)
    flow = quote_flow(APOSTROPHE_DIALECT)
    assert flow("'it''s", False) and not flow("'it''s'", False) and flow("it''s", True) and not flow("it''s'", True)


def test_states_follow_along_the_splits_of_a_file(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for file in "abc":
        state = False
        for start in range(0, 400, 10):
            outside, inside = rng.choice([(False, True), (True, False), (False, False), (True, True)])
            rows.append((file, start, outside, inside))
            expected[file, start] = state
            state = inside if state else outside
    rng.shuffle(rows)
    flows = spark.createDataFrame(rows, "file string, start bigint, from_outside boolean, from_inside boolean")
    assert {(r.file, r.start): r.inside for r in split_beginnings(flows).collect()} == expected


def test_other_splits_in_the_second_pass_are_an_error(spark, tmp_path, small_splits):
    path = str(tmp_path / "rows.csv")
    (tmp_path / "rows.csv").write_text('1\u0007"a\nb"\n' * 200)
    rows = read_multiline(spark, path, BEL_DIALECT, "id int, text string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    with pytest.raises(Exception, match="splits have changed"):
        rows.count()


def test_a_job_reads_in_splits_and_finds_misfits(spark, tmp_path, small_splits):
    lines = [f"{i % 50}\u0007'text\n{i}'\u0007{i:04}" for i in range(200)]
    (tmp_path / "rows.csv").write_text("\n".join([*lines, "7\u0007narrow", "8\u0007'a\nb'\u0007c\u0007wide"]) + "\n")
    found = []
    for name, in_splits in (("whole", False), ("splits", True)):
        job = IngestJob(
            str(tmp_path / "rows.csv"), str(tmp_path / name), ("_c0",), ("_c2",), name="rows", width=3, in_splits=in_splits,
            dialect=APOSTROPHE_DIALECT.with_(multiline=True), quarantine=str(tmp_path / f"{name}-aside"),
        )
        report = run_ingest(spark, job).collect()
        rows = sorted(tuple(r) for r in read_delimited(spark, job.target, job.dialect).collect())
        found.append((report, rows, sorted(r.record.strip() for r in spark.read.parquet(job.quarantine).collect())))
    assert found[0] == found[1] and found[0][0] == [("rows", 50, 200, 150)]
