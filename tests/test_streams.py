import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from waybill import fixtures
from waybill.operators import events as ev
from waybill.plans.serving import latest_positions
from waybill.schemas import LATEST_POSITIONS, RECORD
from waybill.sources import sinks, streams
from waybill.streaming import jobs

ONCE = {"availableNow": True}


def event(vehicle, second, **changes):
    clock = f"2024-01-01T10:{second // 60:02d}:{second % 60:02d}+00:00"
    return {
        "event_version": 1, "event_type": "vehicle_position", "vehicle_id": vehicle, "route_id": "R", "trip_id": None,
        "latitude": 28.0 + second / 1e4, "longitude": 77.0, "vehicle_timestamp": clock,
        "ingestion_timestamp": clock, **changes,
    }


class Topic:
    """Records as files, one file per call, read back as a stream in that order."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, path, 0
        path.mkdir()

    def send(self, *values):
        rows = []
        for value in values:
            text = value if isinstance(value, str) else json.dumps(value)
            rows.append((bytearray(b"k"), bytearray(text.encode()), 0, self.offset, None))
            self.offset += 1
        df = self.spark.createDataFrame(rows, RECORD).withColumn("timestamp", F.timestamp_seconds(F.lit(1_704_103_200)))
        df.coalesce(1).write.mode("append").parquet(str(self.path))

    def stream(self):
        return streams.event_source(self.spark, "parquet", path=str(self.path), maxFilesPerTrigger="1")

    def table(self):
        return self.spark.read.schema(RECORD).parquet(str(self.path))


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def values(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


MIXED = [event("a", 0), event("b", 5), event("a", 9, latitude=95.0), "{bad", event("c", 1, vehicle_timestamp="never"),
         event("a", 20)]


def test_silver_stream_equals_batch(spark, topic, tmp_path):
    topic.send(*MIXED[:3])
    topic.send(*MIXED[3:])
    out = str(tmp_path / "silver")
    finish(jobs.silver_stream(topic.stream(), out, str(tmp_path / "ck"), ONCE))
    batch = ev.streaming_silver(ev.parse_events(ev.kafka_decode(topic.table())))
    stored = spark.read.parquet(out)
    assert values(stored, *batch.columns) == values(batch, *batch.columns)
    assert {str(r.event_date) for r in stored.collect()} == {"2024-01-01"}
    # restart: only what is new is read
    topic.send(event("z", 30))
    finish(jobs.silver_stream(topic.stream(), out, str(tmp_path / "ck"), ONCE))
    assert spark.read.parquet(out).count() == batch.count() + 1 == 4


def test_quality_stream_splits_without_loss(spark, topic, tmp_path):
    topic.send(*MIXED)
    silver, refused = str(tmp_path / "silver"), str(tmp_path / "refused")
    finish(jobs.quality_stream(topic.stream(), silver, refused, str(tmp_path / "ck"), ONCE))
    assert sinks.read_batches(spark, silver).count() == 3
    codes = values(sinks.read_batches(spark, refused), "validation_error")
    assert codes == [("invalid_latitude",), ("missing_or_invalid_event_version",), ("missing_vehicle_timestamp",)]
    assert "{bad" in {r.raw_event for r in sinks.read_batches(spark, refused).collect()}


def test_bronze_keeps_unknown_fields_and_broken_text(spark, topic, tmp_path):
    topic.send(event("a", 0, extra={"deep": [1, 2]}, kafka_offset=999), "{bad", "[1]")
    out = str(tmp_path / "bronze")
    finish(jobs.bronze_stream(topic.stream(), out, str(tmp_path / "ck"), ONCE))
    stored = spark.read.text(out)
    assert {"year", "month", "day"} <= set(stored.columns)
    lines = sorted((json.loads(r.value) for r in stored.collect()), key=lambda e: e["kafka_offset"])
    assert lines[0]["extra"] == {"deep": [1, 2]} and lines[0]["kafka_offset"] == 0  # transport field wins
    assert lines[0]["event_version"] == 1 and lines[0]["latitude"] == 28.0
    assert lines[1]["raw_value"] == "{bad" and lines[2]["raw_value"] == "[1]"
    assert all("bronze_ingestion_timestamp" in line for line in lines)


def test_late_rows_do_not_move_the_latest_state_back(spark, topic, tmp_path):
    topic.send(event("a", 50), event("b", 10))
    topic.send(event("a", 20, latitude=1.0))             # late, in a batch of its own
    topic.send(event("b", 10, latitude=2.0), event("c", 0))  # equal time, later offset
    parsed = ev.parse_events(ev.kafka_decode(topic.stream()))
    out = str(tmp_path / "state")
    finish(jobs.keyed_stream(jobs.latest_vehicle_state(parsed), out, str(tmp_path / "ck"), ONCE))
    written = sinks.read_batches(spark, out)
    last = {}
    for r in sorted(written.collect(), key=lambda r: r.write):
        last[r.vehicle_id] = r.latitude
    assert last == {"a": 28.005, "b": 2.0, "c": 28.0}
    twin = jobs.latest_vehicle_state(ev.parse_events(ev.kafka_decode(topic.table())))
    assert {r.vehicle_id: r.latitude for r in twin.collect()} == last


def test_latest_stream_equals_batch_and_survives_replay(spark, topic, tmp_path):
    topic.send(event("a", 50), event("b", 10), event("a", 30))
    topic.send(event("a", 20), event("b", 10, latitude=2.0), event("bad", 1, latitude=99))
    topic.send(event("a", 55))
    topic.send("{bad")  # nothing valid: no new version
    out = str(tmp_path / "latest")
    finish(jobs.latest_stream(topic.stream(), out, str(tmp_path / "ck"), ONCE))
    columns = [c for c in LATEST_POSITIONS.fieldNames() if c != "updated_at"]
    twin = latest_positions(ev.streaming_silver(ev.parse_events(ev.kafka_decode(topic.table()))))
    stored = sinks.read_merged(spark, out, LATEST_POSITIONS)
    assert values(stored, *columns) == values(twin, *columns)
    assert sinks.versions(spark, out) == [0, 1, 2]


def test_history_stream_replaces_a_replayed_batch(spark, topic, tmp_path):
    topic.send(*MIXED)
    out = str(tmp_path / "history")
    write = jobs.folder_writer(out)

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    finish(jobs.history_stream(topic.stream(), twice, str(tmp_path / "ck"), ONCE))
    stored = sinks.read_batches(spark, out)
    assert stored.count() == 3 and "event_version" not in stored.columns


def test_new_checkpoint_on_existing_output_loses_nothing(spark, topic, tmp_path):
    """Batch numbers start again at 0; what the first query wrote stays."""
    topic.send(event("a", 50), event("b", 10))
    topic.send(event("c", 5), "{bad")
    latest, history, minutes, silver, refused = (str(tmp_path / n) for n in ("latest", "history", "minutes", "silver", "refused"))

    def run(name):
        ck = lambda kind: str(tmp_path / f"{kind}-{name}")
        stream = topic.stream()
        finish(jobs.latest_stream(stream, latest, ck("latest"), ONCE))
        finish(jobs.history_stream(topic.stream(), jobs.folder_writer(history), ck("history"), ONCE))
        finish(jobs.quality_stream(topic.stream(), silver, refused, ck("quality"), ONCE))
        parsed = ev.parse_events(ev.kafka_decode(topic.stream()))
        finish(jobs.keyed_stream(jobs.latest_vehicle_state(parsed), minutes, ck("keyed"), ONCE))

    run("first")
    topic.path = tmp_path / "second"
    topic.path.mkdir()
    topic.send(event("a", 55), event("d", 1), event("b", 3), "{bad")
    run("second")
    state = sinks.read_merged(spark, latest, LATEST_POSITIONS)
    assert values(state, "vehicle_id", "latitude") == [("a", 28.0055), ("b", 28.001), ("c", 28.0005), ("d", 28.0001)]
    assert values(sinks.read_batches(spark, history), "vehicle_id") == [(v,) for v in "aabbcd"]
    assert sinks.read_batches(spark, silver).count() == 6 and sinks.read_batches(spark, refused).count() == 2
    newest = {}
    for r in sorted(sinks.read_batches(spark, minutes).collect(), key=lambda r: r.write):
        newest[r.vehicle_id] = r.latitude
    assert newest == {"a": 28.0055, "b": 28.0003, "c": 28.0005, "d": 28.0001}  # the second query's own state


def test_events_per_minute_drops_rows_beyond_the_watermark(spark, topic, tmp_path):
    topic.send(event("a", 0), event("a", 30), event("b", 61))
    topic.send(event("a", 600))
    topic.send(event("a", 605))  # the watermark of a batch refuses rows from the batch after next on
    topic.send(event("late", 5), event("a", 610))
    parsed = ev.parse_events(ev.kafka_decode(topic.stream()))
    out = str(tmp_path / "minutes")
    finish(jobs.keyed_stream(jobs.events_per_minute(parsed), out, str(tmp_path / "ck"), ONCE))
    last = {}
    for r in sorted(sinks.read_batches(spark, out).collect(), key=lambda r: r.write):
        last[r.window_start.minute] = r.vehicle_events
    assert last == {0: 2, 1: 1, 10: 3}
    twin = jobs.events_per_minute(ev.parse_events(ev.kafka_decode(topic.table())))
    assert {r.window_start.minute: r.vehicle_events for r in twin.collect()} == {0: 3, 1: 1, 10: 3}


def test_publish_checks_the_contract(spark, tmp_path):
    rows = [("a", 28.0), ("", 28.0), (None, 28.0), ("b", 95.0), ("c", None)]
    df = spark.createDataFrame(rows, "vehicle_id string, latitude double").withColumns({
        "route_id": F.lit("R"), "trip_id": F.lit(None).cast("string"), "longitude": F.lit(77.0),
        "vehicle_timestamp": F.timestamp_seconds(F.lit(1)), "ingestion_timestamp": F.timestamp_seconds(F.lit(2)),
    })
    out = str(tmp_path / "out")
    jobs.publish_events(ev.build_event(df), "json", path=out)
    assert sorted(r.key for r in spark.read.json(out).collect()) == ["a", "c"]


def test_console_runner(spark, topic, tmp_path):
    topic.send(event("a", 0))
    finish(jobs.console(ev.kafka_decode(topic.stream()), str(tmp_path / "ck"), trigger=ONCE))


def numbered(spark, counts):
    """Records of which ``counts[n]`` have the file number n."""
    numbers = [n for n, count in enumerate(counts) for _ in range(count)]
    rows = [(b"k", b"v%d" % at, at % 3, at, datetime(2024, 1, 1, tzinfo=timezone.utc), n) for at, n in enumerate(numbers)]
    return spark.createDataFrame(rows, StructType([*RECORD.fields, StructField("file_no", IntegerType())]))


def test_a_batch_of_a_numbered_stream_comes_in_files_of_bounded_size(spark, tmp_path):
    counts = [3, 1000, 0, 240]
    path, seen = str(tmp_path / "numbered"), {}
    files = fixtures.write_in_order(numbered(spark, counts), path, rows_per_file=100)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert files == 10 and sum(sizes) == sum(counts) and max(sizes) <= 200

    def look(batch, batch_id):
        seen[batch_id] = sorted(r.offset for r in batch.select("offset").collect())

    stream = streams.event_source(spark, "parquet", path=path, maxFilesPerTrigger=str(files))
    finish(jobs.history_of(stream.select(*RECORD.fieldNames()), look, str(tmp_path / "ck"), ONCE))
    assert [seen[k] for k in sorted(seen)] == [[*range(3)], [*range(3, 1003)], [*range(1003, 1243)]]


def test_small_numbers_of_records_are_one_file_a_batch(spark, tmp_path):
    assert fixtures.write_in_order(numbered(spark, [3, 2]), str(tmp_path / "few")) == 1
    assert fixtures.write_in_order(numbered(spark, [0]), str(tmp_path / "none")) == 1
