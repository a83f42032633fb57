"""Progress of streams as a ledger."""

import json
import time

import pytest

from shoreline.operators.offsets import islands
from shoreline.streaming.progress import ProgressLedger, read_progress, topic_ranges
from shoreline.streaming.sinks import start, write_batch


@pytest.fixture
def listening(spark, tmp_path):
    ledger = ProgressLedger(spark, str(tmp_path / "progress"), {"heard"})
    spark.streams.addListener(ledger)
    yield str(tmp_path / "progress")
    spark.streams.removeListener(ledger)


def told(spark, path, batches):
    """Listeners hear a little later than the query ends."""
    for _ in range(100):
        try:
            rows = read_progress(spark, path).collect()
        except Exception:
            rows = []
        if len({r.batch_id for r in rows}) >= batches:
            return sorted(rows, key=lambda r: r.batch_id)
        time.sleep(0.1)
    raise AssertionError("no progress was told")


def test_batches_are_told_with_their_rows(spark, tmp_path, listening):
    for number, rows in enumerate((3, 5, 1)):
        spark.range(rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
    for name in ("heard", "other"):
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        writer = stream.writeStream.foreachBatch(lambda batch, n, name=name: write_batch(batch, n, str(tmp_path / name), []))
        start(writer, str(tmp_path / f"checkpoint-{name}"), name=name).awaitTermination()
    rows = told(spark, listening, 3)
    assert [(r.batch_id, r.rows) for r in rows] == [(0, 3), (1, 5), (2, 1)]
    assert len({r.run_id for r in rows}) == 1 and all(r.seconds >= 0 and r.at for r in rows)
    assert json.loads(rows[1].start_position) != json.loads(rows[1].end_position)


def test_positions_of_topics(spark):
    def row(run, batch, start, end):
        return (run, batch, 0, start and json.dumps(start), json.dumps(end))

    rows = [
        row("a", 0, None, {"t": {"0": 5, "1": 0}, "u": {"0": 9}}),
        row("a", 1, {"t": {"0": 5, "1": 0}, "u": {"0": 9}}, {"t": {"0": 8, "1": 4, "2": 1}, "u": {"0": 9}}),
        row("b", 0, {"t": {"0": 8}}, {"t": {"0": 8}}),
        ("c", 0, 0, '{"logOffset":0}', '{"logOffset":1}'),
    ]
    progress = spark.createDataFrame(rows, "run_id string, batch_id bigint, source_no int, start_position string, end_position string")
    ledger = topic_ranges(progress)
    found = sorted((r.topic, r.partition, r.from_offset, r.until_offset, r.batch_id) for r in ledger.collect())
    assert found == [("t", 0, 0, 5, 0), ("t", 0, 5, 8, 1), ("t", 1, 0, 4, 1), ("t", 2, 0, 1, 1), ("u", 0, 0, 9, 0)]
    assert sorted((r.topic, r.partition, r.until_offset) for r in islands(ledger).collect()) == [("t", 0, 8), ("t", 1, 4), ("t", 2, 1), ("u", 0, 9)]


def test_a_ledger_that_cannot_be_written_stops_no_stream(spark, tmp_path):
    (tmp_path / "file").write_text("")
    spark.range(2).write.parquet(str(tmp_path / "in"))
    ledger = ProgressLedger(spark, str(tmp_path / "file" / "below"))
    spark.streams.addListener(ledger)
    try:
        stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
        writer = stream.writeStream.foreachBatch(lambda batch, n: write_batch(batch, n, str(tmp_path / "out"), []))
        start(writer, str(tmp_path / "checkpoint")).awaitTermination()
    finally:
        spark.streams.removeListener(ledger)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
