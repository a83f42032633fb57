"""Streams over files that arrive one after another."""

import glob
import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from shoreline.queries import inputs
from shoreline.sources.kafka import RECORD_SCHEMA
from shoreline.streaming.jobs import (
    current_counts,
    in_windows,
    keep_counts,
    land_raw,
    land_windowed_rows,
    land_windows,
    land_without_replays,
    route_and_append,
    routed,
)
from shoreline.streaming.commits import begin, commit, read_committed
from shoreline.streaming.sinks import preview, start, write_batch

FIELDS = {"account": "originatingEvent.accountNumber", "card": "originatingEvent.cardPr"}


def value(number, **fields):
    return json.dumps({"originatingEvent": {"eventId": str(number), "accountNumber": f"A{number}", **fields}})


class Topic:
    """A folder of record files, read one file per batch."""

    def __init__(self, spark, root):
        self.spark, self.folder, self.files = spark, root / "arriving", 0
        self.folder.mkdir()

    def arrive(self, *rows):
        """Rows of (key, value, topic, offset, seconds after noon)."""
        noon = datetime(2020, 5, 4, 12, tzinfo=timezone.utc).timestamp()
        lines = [
            json.dumps(
                {
                    "key": key,
                    "value": text,
                    "topic": topic,
                    "partition": 0,
                    "offset": offset,
                    "timestamp": datetime.fromtimestamp(noon + at, timezone.utc).isoformat(),
                }
            )
            for key, text, topic, offset, at in rows
        ]
        path = self.folder / f"{self.files:03}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_600_000_000 + self.files, 1_600_000_000 + self.files))
        self.files += 1

    def stream(self):
        reader = self.spark.readStream.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", 1)
        return reader.json(str(self.folder))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path)


def finish(writer, checkpoint):
    query = start(writer, str(checkpoint))
    query.awaitTermination()
    return query


def forget_last_commit(checkpoint):
    """As if the application died after writing its last batch and before noting that."""
    last = max(int(os.path.basename(path)) for path in glob.glob(f"{checkpoint}/commits/[0-9]*"))
    for path in (f"{checkpoint}/commits/{last}", f"{checkpoint}/commits/.{last}.crc"):
        os.replace(path, f"{checkpoint}/forgotten-{os.path.basename(path)}")
    return last


def two_batches(topic):
    topic.arrive(
        ("k", value(1, chargebackId="CB"), "one", 0, 0),
        ("k", value(2, fraudTransactionId="FR"), "one", 1, 1),
        ("k", value(3), "two", 0, 2),
        ("k", "broken", "two", 1, 3),
    )
    topic.arrive(("k", value(4, chargebackId="CB", fraudTransactionId="FR"), "one", 2, 4), ("k", value(5), "one", 3, 5))


def routes(spark, path):
    return sorted((r.topic, r.offset, r.route, r.account, r.batch_id) for r in spark.read.parquet(path).collect())


EXPECTED_ROUTES = [
    ("one", 0, "chargeback", "A1", 0),
    ("one", 1, "fraud", "A2", 0),
    ("one", 2, "chargeback", "A4", 1),
    ("one", 3, "asyncout", "A5", 1),
    ("two", 0, "asyncout", "A3", 0),
    ("two", 1, "quarantine", None, 0),
]


@pytest.mark.parametrize("files", [None, 1])
def test_routes_and_ledger_survive_a_replay(spark, topic, tmp_path, files):
    two_batches(topic)
    path, ledger, checkpoint = (str(tmp_path / name) for name in ("out", "ledger", "checkpoint"))

    def run():
        stream = routed(topic.stream(), FIELDS)
        finish(route_and_append(stream, path, ledger_path=ledger, files=files), checkpoint)

    run()
    assert routes(spark, path) == EXPECTED_ROUTES
    expected_ledger = [("one", 0, 0, 2, 0), ("one", 0, 2, 4, 1), ("two", 0, 0, 2, 0)]
    columns = ["topic", "partition", "from_offset", "until_offset", "batch_id"]
    assert sorted(tuple(r) for r in spark.read.parquet(ledger).select(columns).collect()) == expected_ledger
    assert forget_last_commit(checkpoint) == 1
    run()
    assert routes(spark, path) == EXPECTED_ROUTES
    assert sorted(tuple(r) for r in spark.read.parquet(ledger).select(columns).collect()) == expected_ledger
    topic.arrive(("k", value(6), "two", 2, 6))
    run()
    assert routes(spark, path) == [*EXPECTED_ROUTES, ("two", 2, "asyncout", "A6", 2)]
    if files:
        assert all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in glob.glob(f"{path}/*/*/*/*/batch_id=*"))


def test_arrival_date_of_a_batch_stays_when_it_is_replayed(spark, topic, tmp_path):
    """The date comes from the offset log, so a replay on another day replaces the same folder."""
    two_batches(topic)
    path, checkpoint = str(tmp_path / "out"), tmp_path / "checkpoint"
    finish(route_and_append(routed(topic.stream(), FIELDS), path), checkpoint)
    last = forget_last_commit(checkpoint)
    log = checkpoint / "offsets" / str(last)
    text = log.read_text().splitlines()
    meta = json.loads(text[1])
    meta["batchTimestampMs"] = 1_000_000_000_000
    log.write_text("\n".join([text[0], json.dumps(meta), *text[2:]]))
    os.replace(checkpoint / "offsets" / f".{last}.crc", checkpoint / "offsets-crc")
    finish(route_and_append(routed(topic.stream(), FIELDS), path), checkpoint)
    dates = {str(r.extract_date) for r in spark.read.parquet(path).filter(F.col("batch_id") == last).collect()}
    assert "2001-09-09" in dates


def test_batches_without_records_write_nothing(spark, topic, tmp_path):
    topic.arrive()
    two_batches(topic)
    path, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    finish(route_and_append(routed(topic.stream(), FIELDS), path, ledger_path=ledger), tmp_path / "checkpoint")
    assert {row.batch_id for row in spark.read.parquet(path).collect()} == {1, 2}


def test_raw_landing_is_one_line_per_record_and_replay_safe(spark, topic, tmp_path):
    topic.arrive(("k", "two\nlines", "one", 0, 0), (None, "x", "two", 0, 1))
    topic.arrive(("k", "y", "one", 1, 2))
    path, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    for _ in range(2):
        finish(land_raw(topic.stream(), path), checkpoint)
        lines = spark.read.text(path).collect()
        assert sorted((r.topic, json.loads(r.value)["value"]) for r in lines) == [
            ("one", "two\nlines"),
            ("one", "y"),
            ("two", "x"),
        ]
        forget_last_commit(checkpoint)


def test_each_record_is_in_two_windows(spark, topic, tmp_path):
    topic.arrive(("k", "a", "one", 0, 30), ("k", "b", "one", 1, 90))
    path = str(tmp_path / "windows")
    finish(land_windows(topic.stream(), path), tmp_path / "checkpoint")
    rows = sorted((r.window_start, r.value) for r in spark.read.text(path).collect())
    assert rows == [
        ("2020-05-04_11-59-00", "a"),
        ("2020-05-04_12-00-00", "a"),
        ("2020-05-04_12-00-00", "b"),
        ("2020-05-04_12-01-00", "b"),
    ]
    finish(land_windowed_rows(topic.stream(), str(tmp_path / "rows")), tmp_path / "checkpoint-rows")
    kept = spark.read.parquet(str(tmp_path / "rows"))
    assert sorted((f"{r.window_start:%Y-%m-%d_%H-%M-%S}", r.value) for r in kept.collect()) == rows
    batch = spark.read.schema(RECORD_SCHEMA).json(str(topic.folder))
    assert in_windows(batch, "3 minutes", "1 minute").count() == 6


def test_window_counts_over_batches_and_replay(spark, topic, tmp_path):
    topic.arrive(("k", "a", "one", 0, 30), ("k", "b", "two", 0, 30))
    topic.arrive(("k", "c", "one", 1, 31), ("k", "d", "one", 2, 100))
    topic.arrive(("k", "far ahead", "one", 3, 7200))
    topic.arrive(("k", "in time", "one", 4, 7100))
    topic.arrive(("k", "very late", "one", 5, 30))
    path, checkpoint = str(tmp_path / "counts"), str(tmp_path / "checkpoint")

    def counts():
        finish(keep_counts(topic.stream(), path), checkpoint)
        rows = current_counts(spark.read.parquet(path)).collect()
        return {(f"{r.window_start:%H:%M}", r.topic): r.records for r in rows}

    expected = {
        ("11:59", "one"): 3,
        ("12:00", "one"): 4,
        ("12:01", "one"): 1,
        ("11:59", "two"): 1,
        ("12:00", "two"): 1,
        ("13:57", "one"): 1,
        ("13:58", "one"): 1,
        ("13:59", "one"): 1,
        ("14:00", "one"): 1,
    }
    assert counts() == expected
    forget_last_commit(checkpoint)
    assert counts() == expected


def test_replayed_records_are_kept_once_however_late(spark, topic, tmp_path):
    topic.arrive(("e1", "x", "one", 0, 0), ("e1", "x", "one", 0, 0), ("e2", "y", "one", 1, 1))
    topic.arrive(("far ahead", "t", "one", 9, 500_000))
    topic.arrive(("e2", "y", "one", 1, 1), ("e3", "late and new", "one", 2, 2), (None, "n", "one", 4, 2), (None, "n", "one", 4, 2))
    topic.arrive((None, "n", "one", 4, 2), ("e3", "late and new", "one", 2, 2))
    path, checkpoint = str(tmp_path / "kept"), str(tmp_path / "checkpoint")
    for _ in range(2):
        finish(land_without_replays(topic.stream(), path, "key"), checkpoint)
        keys = sorted(str(row.key) for row in spark.read.parquet(path).collect())
        assert keys == ["None", "None", "None", "e1", "e2", "e3", "far ahead"]  # without a key nothing is a copy
        forget_last_commit(checkpoint)


def test_a_new_checkpoint_adds_to_what_landed(spark, topic, tmp_path):
    two_batches(topic)
    path, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    stream = topic.stream()
    for name, part in (("a", stream.where("offset < 2")), ("b", stream.where("offset >= 2"))):
        finish(route_and_append(routed(part, FIELDS), path, ledger_path=ledger), tmp_path / name)
    assert [r[:4] for r in routes(spark, path)] == [r[:4] for r in EXPECTED_ROUTES]
    assert spark.read.parquet(path).select("run_id").distinct().count() == 2
    assert spark.read.parquet(ledger).count() == 3


def test_preview_prints_batches(topic, tmp_path):
    two_batches(topic)
    query = finish(preview(topic.stream().select("topic", "offset"), rows=3), tmp_path / "checkpoint")
    assert "Console" in query.lastProgress["sink"]["description"]


def test_interval_trigger(spark, topic, tmp_path):
    two_batches(topic)
    writer = land_raw(topic.stream(), str(tmp_path / "raw"))
    query = start(writer, str(tmp_path / "checkpoint"), name="landing", every_seconds=1)
    query.processAllAvailable()
    assert query.name == "landing"
    query.stop()
    assert spark.read.text(str(tmp_path / "raw")).count() == 6


def test_a_stateful_stream_can_be_routed(spark, topic, tmp_path):
    """State turns AQE off, and with it the rebalancing of the output."""
    two_batches(topic)
    topic.arrive(("k", value(4, chargebackId="CB", fraudTransactionId="FR"), "one", 2, 4))
    kept = topic.stream().dropDuplicates(["value"])
    path = str(tmp_path / "out")
    finish(route_and_append(routed(kept, FIELDS), path), tmp_path / "checkpoint")
    assert routes(spark, path) == EXPECTED_ROUTES


def test_a_topic_with_most_records_is_split_over_tasks(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 6).selectExpr(
        "case when id % 3 = 0 then 'quiet' else 'hot' end as topic", "id", "sha2(cast(id as string), 256) as value"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_batch(rows, 0, str(tmp_path / "out"), ["topic"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 60_000
    assert len(glob.glob(str(tmp_path / "out" / "topic=hot" / "*" / "*" / "*.parquet"))) > 1


def destroyed(pattern):
    """Make files unreadable; a job that succeeds has not read them."""
    files = [f for f in glob.glob(pattern) if f.endswith(".parquet")]
    for file in files:
        size = os.path.getsize(file)
        with open(file, "wb") as out:
            out.write(b"x" * size)
    return files


def test_new_records_are_landed_without_reading_landed_ones(spark, topic, tmp_path):
    path, checkpoint = str(tmp_path / "kept"), str(tmp_path / "checkpoint")
    for batch in range(4):
        topic.arrive(*[(f"k{batch}-{i}", "v" * 500, "one", 100 * batch + i, i) for i in range(100)])
    finish(land_without_replays(topic.stream(), path, "key"), checkpoint)
    index = sum(os.path.getsize(f) for f in glob.glob(f"{path}/_keys/*/*/*/*.parquet"))
    assert index < 4 * (100 * 9 + 1000)  # eight bytes a key and a footer a batch
    assert destroyed(f"{path}/event_date=*/*/batch_id=[02]/*")
    topic.arrive(*[(f"k9-{i}", "v", "one", 900 + i, i) for i in range(50)])
    topic.arrive(*[(f"k{batch}-7", "again", "one", 7, 1) for batch in (1, 3)], ("k10", "v", "one", 1000, 2))
    finish(land_without_replays(topic.stream(), path, "key"), checkpoint)
    added = spark.read.schema("key string, batch_id int").parquet(*glob.glob(f"{path}/event_date=*/*/batch_id=[45]"))
    assert sorted(r.key for r in added.collect()) == sorted(["k10", *[f"k9-{i}" for i in range(50)]])


def test_keys_that_landed_before_the_index_are_indexed(spark, topic, tmp_path):
    path = str(tmp_path / "kept")
    topic.arrive(("a", "x", "one", 0, 0), ("b", "x", "one", 1, 0), (None, "x", "one", 2, 0))
    finish(land_without_replays(topic.stream(), path, "key"), tmp_path / "first")
    os.rename(f"{path}/_keys", tmp_path / "index-gone")
    topic.arrive(("c", "x", "one", 3, 0))
    finish(land_without_replays(topic.stream(), path, "key"), tmp_path / "second")
    assert sorted(str(r.key) for r in read_committed(spark, path).collect()) == ["None", "None", "a", "b", "c"]


def test_equal_hashes_of_different_keys_lose_no_record(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(1).cast("bigint"))
    path = str(tmp_path / "kept")
    topic.arrive(("a", "x", "one", 0, 0))
    topic.arrive(("b", "x", "one", 1, 0), ("a", "x", "one", 0, 0))
    finish(land_without_replays(topic.stream(), path, "key", files=None), tmp_path / "checkpoint")
    assert sorted(r.key for r in read_committed(spark, path).collect()) == ["a", "b"]


def test_records_without_event_time_are_compared_with_each_other(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", None, 3)], "key string, timestamp timestamp, n int")
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for number in (1, 2):
        rows.where(f"n >= {number}").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
        finish(land_without_replays(stream, path, "key"), tmp_path / "checkpoint")
    assert sorted(r.key for r in read_committed(spark, path).collect()) == ["a", "b"]


def test_a_batch_counts_from_its_commit_on(spark, topic, tmp_path):
    two_batches(topic)
    path, ledger, checkpoint = (str(tmp_path / name) for name in ("out", "ledger", "checkpoint"))

    def run():
        finish(route_and_append(routed(topic.stream(), FIELDS), path, ledger_path=ledger), checkpoint)

    def batches():
        rows, ranges = read_committed(spark, path), read_committed(spark, ledger, commits_of=path)
        return tuple(sorted(r.batch_id for r in df.select("batch_id").distinct().collect()) for df in (rows, ranges))

    run()
    assert batches() == ([0, 1], [0, 1])
    (run_id,) = {r.run_id for r in spark.read.parquet(path).select("run_id").distinct().collect()}
    begin(spark, path, run_id, 1)
    assert batches() == ([0], [0])
    forget_last_commit(checkpoint)
    run()
    assert batches() == ([0, 1], [0, 1])
    assert len([f for f in os.listdir(f"{path}/_commits") if f.endswith(".json")]) == 1


def test_commits_of_batches_handed_over_by_hand(spark, tmp_path):
    path, rows = str(tmp_path / "out"), spark.createDataFrame([("a", 1)], "topic string, n int")
    for number in (5, 0, 3):
        write_batch(rows, number, path, ["topic"])
    write_batch(rows, 7, path, ["topic"], commits=False)
    assert sorted(r.batch_id for r in read_committed(spark, path).collect()) == [0, 3, 5]
    begin(spark, path, "direct", 3)
    assert sorted(r.batch_id for r in read_committed(spark, path).collect()) == [0, 5]
    commit(spark, path, "direct", 3)
    assert sorted(r.batch_id for r in read_committed(spark, path, "topic string, n int, run_id string, batch_id int").collect()) == [0, 3, 5]


def test_a_path_without_commits_is_read_whole(spark, tmp_path):
    spark.createDataFrame([(1,)], "n int").write.parquet(str(tmp_path / "plain"))
    assert read_committed(spark, str(tmp_path / "plain")).count() == 1


def test_a_record_is_counted_in_one_pane(spark, topic, tmp_path):
    topic.arrive(*[("k", "v", "one", i, 7 * i) for i in range(100)])
    path = str(tmp_path / "panes")
    finish(keep_counts(topic.stream(), path, length="10 minutes", slide="1 minute"), tmp_path / "checkpoint")
    panes = spark.read.parquet(path)
    assert panes.agg(F.sum("records")).first()[0] == 100 and panes.count() == 12
    records = spark.read.schema(RECORD_SCHEMA).json(str(topic.folder))
    direct = in_windows(records, "10 minutes", "1 minute").groupBy("window_start", "window_end", "topic").count()
    assert sorted(current_counts(panes, "10 minutes", "1 minute").collect()) == sorted(direct.collect())


def test_panes_fit_into_length_and_slide(spark, topic, tmp_path):
    """45 seconds every 30: panes of 15 seconds."""
    topic.arrive(*[("k", "v", "one", i, 4 * i) for i in range(50)])
    path = str(tmp_path / "panes")
    finish(keep_counts(topic.stream(), path, length="45 seconds", slide="30 seconds"), tmp_path / "checkpoint")
    records = spark.read.schema(RECORD_SCHEMA).json(str(topic.folder))
    direct = in_windows(records, "45 seconds", "30 seconds").groupBy("window_start", "window_end", "topic").count()
    assert sorted(current_counts(spark.read.parquet(path), "45 seconds", "30 seconds").collect()) == sorted(direct.collect())


def test_files_of_a_batch_follow_the_rows(spark, tmp_path, monkeypatch):
    """A file is the work of one task, so a larger table arrives in more of them, in the same batches."""
    monkeypatch.setattr(inputs, "ROWS_PER_FILE", 100)
    spark.range(3000).select(F.col("id").alias("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    found = []

    def look(batch, batch_id):
        found.append(tuple(batch.agg(F.min("event_id"), F.max("event_id"), F.count("*")).first()))

    stream = inputs.arrivals(spark, str(tmp_path), "events", "event_id")
    start(stream.writeStream.foreachBatch(look), str(tmp_path / "checkpoint")).awaitTermination()
    assert found == [(0, 999, 1000), (1000, 1999, 1000), (2000, 2999, 1000), (None, None, 0)]
    path, files = inputs._landed(spark, str(tmp_path), "events", "event_id", False)
    assert files == 10 and all(len(glob.glob(f"{path}/chunk={n}/*.parquet")) == 10 for n in range(3))


def test_no_batch_has_more_files_than_rows_for_them():
    assert inputs._files([30, 30, 30]) == inputs._files([0, 10**8, 10**8]) == inputs.FILES
    assert inputs._files([10**8, 1000, 10**8]) == 10
    assert inputs._files([10**7] * 3) == 200
