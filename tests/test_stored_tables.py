"""Manifests, append logs, bucketed tables, gold brought up to date, profiles gathered while writing."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from waybill.operators import merge
from waybill.plans import gold, incremental
from waybill.sources import appends, buckets, manifests, sinks, snapshots
from waybill.streaming import jobs

STATE = "k string, t int, v int"


def one(spark, *rows, schema="n int, day string"):
    return spark.createDataFrame(rows, schema).coalesce(1)


def files_below(path, ending=".parquet"):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(ending)}


# -- append logs ------------------------------------------------------------------------

@pytest.mark.parametrize("partition_by", [(), ("day",)])
def test_many_appends_leave_few_folders(spark, tmp_path, monkeypatch, partition_by):
    monkeypatch.setattr(appends, "FAN", 3)
    path, most = str(tmp_path / "log"), 0
    for n in range(60):
        assert appends.append(one(spark, (n, "2024-01-0%d" % (n % 2 + 1))), path, f"q.{n}", partition_by)
        most = max(most, len(appends.live_folders(spark, path)))
        if n == 20:
            early = appends.read(spark, path)
    assert most <= 2 * 4 + 1  # at most FAN - 1 on each of log3(60) levels, and the newest
    assert sorted((r.n, r.write) for r in appends.read(spark, path).collect()) == [(n, n) for n in range(60)]
    assert len(os.listdir(tmp_path / "log" / "_manifests")) <= 2 * manifests.KEPT  # with their checksums
    live = {f"folder={name.rpartition('=')[2]}" for name in appends.live_folders(spark, path)}
    assert len(set(os.listdir(tmp_path / "log" / "data"))) <= len(live) + 4 * manifests.KEPT
    assert early.columns[0] == "n"


def test_readers_see_rows_once_on_either_side_of_a_merge(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    monkeypatch.setattr(appends, "FAN", 100)
    for n in range(4):
        appends.append(one(spark, (n, "d")), path)
    before = appends.read(spark, path)
    monkeypatch.setattr(appends, "FAN", 4)
    seen = []
    real = manifests.commit
    monkeypatch.setattr(manifests, "commit", lambda *a, **b: seen.append(appends.read(spark, path).count()) or real(*a, **b))
    assert appends.merge_full_levels(spark, path) == 1
    assert seen == [4] and before.count() == 4 and appends.read(spark, path).count() == 4  # while, by an old reader, after
    assert len(appends.live_folders(spark, path)) == 1 and appends.merge_full_levels(spark, path) == 0


def test_a_merge_by_date_sorts_few_rows_in_a_task(spark, tmp_path, monkeypatch):
    """One date holds nearly all rows, in files that compress to almost nothing."""
    path = str(tmp_path / "log")
    monkeypatch.setattr(appends, "FAN", 4)
    monkeypatch.setattr(appends, "SORTED_ROWS", 500, raising=False)
    for n in range(4):
        rows = spark.range(n * 1000, n * 1000 + 1000, numPartitions=1).select(
            F.col("id").alias("n"), F.when(F.col("id") % 100 == 0, "2024-01-02").otherwise("2024-01-01").alias("day"))
        appends.append(rows, path, f"q.{n}", ("day",))
    merged = spark.read.parquet(f"{path}/{appends.live_folders(spark, path)[0]}")
    tasks = merged.groupBy(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task")).count().collect()
    assert len(appends.live_folders(spark, path)) == 1 and len(tasks) > 2 and max(r["count"] for r in tasks) < 2000
    assert sorted(r.n for r in appends.read(spark, path).collect()) == [*range(4000)]


def test_replays_and_other_queries(spark, tmp_path):
    path = str(tmp_path / "log")
    assert appends.append(one(spark, (1, "d")), path, "a.0")
    assert not appends.append(one(spark, (1, "d")), path, "a.0")
    assert appends.append(one(spark, (2, "d")), path, "b.0") and appends.append(one(spark, (3, "d")), path, "a.1")
    assert not appends.append(one(spark, (1, "d")), path, "a.0")
    assert sorted(r.n for r in appends.read(spark, path).collect()) == [1, 2, 3]


def test_a_slower_writer_commits_on_top(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    appends.append(one(spark, (0, "d")), path, "a.0")
    real, done = manifests.newest, []

    def newest(*args):
        found = real(*args)
        if len(done) == 1:  # between this writer's look and its commit
            done.append(True)
            appends.append(one(spark, (1, "d")), path, "b.0")
        done.append(True) if not done else None
        return found

    monkeypatch.setattr(manifests, "newest", newest)
    appends.append(one(spark, (2, "d")), path, "a.1")
    monkeypatch.undo()
    assert sorted(r.n for r in appends.read(spark, path).collect()) == [0, 1, 2]


def test_empty_appends_and_schemas(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = one(spark, (1, "2024-01-01"))
    assert appends.read(spark, path, rows.schema).count() == 0
    with pytest.raises(ValueError, match="nothing is stored"):
        appends.read(spark, path)
    appends.append(rows.filter("false"), path, partition_by=("day",))
    assert appends.read(spark, path, rows.schema).columns == ["n", "day", "write"] and appends.read(spark, path, rows.schema).count() == 0
    appends.append(rows, path, partition_by=("day",))
    assert [(r.n, r.day) for r in appends.read(spark, path, rows.schema).collect()] == [(1, "2024-01-01")]


def test_metrics_of_a_run_replace_themselves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(appends, "FAN", 3)
    path = str(tmp_path / "metrics")
    for n, run in ((1, "x"), (2, "y"), (3, "x"), (4, None), (5, "x"), (6, None)):
        sinks.append_metrics(one(spark, (n, "t"), (n, "u")), path, run)
    assert sorted((r.n, r.day) for r in sinks.read_metrics(spark, path).collect()) == [(n, d) for n in (2, 4, 5, 6) for d in "tu"]


# -- buckets ----------------------------------------------------------------------------

def test_an_update_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "state")
    schema = spark.createDataFrame([], STATE).schema
    upsert = lambda rows, source: buckets.upsert(
        spark.createDataFrame(rows, STATE), path, ["k"], schema, merge.NOT_OLDER, source, 8, time="t")
    assert len(upsert([(f"k{i}", 1, i) for i in range(100)], "q.0")) == 8
    first = files_below(path)
    assert len(first) == 8
    old = buckets.read(spark, path, schema)
    touched = upsert([("k1", 2, -1), ("k2", 0, -2), ("new", 1, 7)], "q.1")
    assert 1 <= len(touched) <= 3 and len(files_below(path) - first) == len(touched)
    assert upsert([("k1", 9, 0)], "q.1") == []  # a replay
    state = {r.k: r.v for r in buckets.read(spark, path, schema).collect()}
    assert len(state) == 101 and state["k1"] == -1 and state["k2"] == 2 and state["new"] == 7
    assert old.count() == 100  # an old reader's files are there
    for n in range(2, 30):
        upsert([("k1", n + 1, n)], f"q.{n}")
    assert len(files_below(path)) <= 8 + manifests.KEPT + len(touched)
    assert {r.k: r.v for r in buckets.read(spark, path, schema).collect()}["k1"] == 29


def test_two_writers_of_a_bucketed_table_are_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    schema = spark.createDataFrame([], STATE).schema
    rows = spark.createDataFrame([("a", 1, 1)], STATE)
    real = buckets.keyed_merge
    monkeypatch.setattr(buckets, "keyed_merge", lambda *a, **b: monkeypatch.undo() or buckets.upsert(rows, path, ["k"], schema) and real(*a, **b))
    with pytest.raises(RuntimeError, match="another writer"):
        buckets.upsert(rows, path, ["k"], schema)
    assert buckets.read(spark, path, schema).count() == 1


# -- streams ----------------------------------------------------------------------------

def test_a_batch_that_fails_between_its_two_writes_is_complete_once(spark, tmp_path, monkeypatch):
    from test_streams import MIXED, ONCE, Topic, event

    topic = Topic(spark, tmp_path / "topic")
    topic.send(*MIXED)
    topic.send(event("z", 9), "{worse")
    silver, refused, ck = (str(tmp_path / n) for n in ("silver", "refused", "ck"))
    real, calls = appends.append, []

    def failing(df, path, *args):
        calls.append(path)
        if len(calls) in (2, 5):  # the second write of each batch, once
            raise OSError("the disk is gone")
        return real(df, path, *args)

    monkeypatch.setattr(appends, "append", failing)
    for _ in range(3):
        query = jobs.quality_stream(topic.stream(), silver, refused, ck, ONCE)
        try:
            query.awaitTermination()
        except Exception as error:
            assert "the disk is gone" in str(error)
    assert query.exception() is None and calls.count(silver) == 4
    assert sorted(r.vehicle_id for r in sinks.read_batches(spark, silver).collect()) == ["a", "a", "b", "z"]
    assert sinks.read_batches(spark, refused).count() == 4


def test_state_is_recovered_in_the_middle_of_the_input(spark, tmp_path):
    from test_streams import ONCE, Topic, event, finish
    from waybill.operators import events as ev

    topic, out, ck = Topic(spark, tmp_path / "topic"), str(tmp_path / "out"), str(tmp_path / "ck")
    run = lambda: finish(jobs.keyed_stream(
        jobs.latest_vehicle_state(ev.parse_events(ev.kafka_decode(topic.stream()))), out, ck, ONCE))
    topic.send(event("a", 50), event("b", 10))
    topic.send(event("c", 5))
    run()
    topic.send(event("a", 20, latitude=1.0))  # late: only the recovered state knows
    topic.send(event("b", 10, latitude=2.0))
    run()
    last = {}
    for r in sorted(sinks.read_batches(spark, out).collect(), key=lambda r: r.write):
        last[r.vehicle_id] = r.latitude
    assert last == {"a": 28.005, "b": 2.0, "c": 28.0005}


def test_file_sinks_write_a_file_a_day_and_are_read_by_their_log(spark, tmp_path):
    from test_streams import ONCE, Topic, event, finish

    topic = Topic(spark, tmp_path / "topic")
    for batch in range(3):
        topic.send(*(event(f"v{k}", k, vehicle_timestamp=f"2024-01-0{1 + k % 3}T0{batch}:00:0{k}+00:00") for k in range(9)))
    out = str(tmp_path / "silver")
    finish(jobs.silver_stream(topic.stream(), out, str(tmp_path / "ck"), ONCE))
    assert len(files_below(out)) == 3 * 3  # three batches over three days
    stray = tmp_path / "silver" / "event_date=2024-01-01" / "part-stray.parquet"
    stray.write_bytes(next(iter(open(f, "rb").read() for f in sorted(files_below(out)))))
    assert spark.read.parquet(out).count() == 27  # the sink's log doesn't name the stray file


def test_snapshots_are_decoded_once(spark, tmp_path, monkeypatch):
    from test_streams import ONCE, finish

    def snapshot(minute, vehicles):
        feed = snapshots.feed_message()()
        feed.header.gtfs_realtime_version = "2.0"
        for v in vehicles:
            entity = feed.entity.add(id=v)
            entity.vehicle.vehicle.id = v
        (tmp_path / "raw" / f"vehicle_positions_20240101_00{minute:02d}00.bin").write_bytes(feed.SerializeToString())

    (tmp_path / "raw").mkdir()
    raw, out, ck = (str(tmp_path / n) for n in ("raw", "out", "ck"))

    def run():
        query = jobs.snapshot_history(snapshots.snapshot_stream(spark, raw), out, ck, ONCE)
        finish(query)
        return sum(p["numInputRows"] for p in query.recentProgress)

    snapshot(0, ["a", "b"])
    snapshot(1, ["c"])
    assert run() == 2
    snapshot(2, ["d"])
    assert run() == 1 and run() == 0
    stored = sinks.read_batches(spark, out).drop("write")
    whole = snapshots.decode_snapshots(snapshots.snapshot_scan(spark, raw))
    assert sorted(map(str, stored.collect())) == sorted(map(str, whole.select(*stored.columns).collect())) and stored.count() == 4


# -- gold -------------------------------------------------------------------------------

def positions(spark, rows):
    at = lambda hour, second: datetime(2024, 1, 1 + hour // 24, hour % 24, 0, second, tzinfo=timezone.utc)
    full = [(v, "R", "T", 28.0, 77.0, at(h, s), at(h, s + 1), f"vehicle_positions_202401{1 + h // 24:02d}_{h % 24:02d}0000.bin", 0, s) for v, h, s in rows]
    return spark.createDataFrame(full, "vehicle_id string, route_id string, trip_id string, latitude double, longitude double, "
                                       "vehicle_timestamp timestamp, ingestion_timestamp timestamp, source_file string, kafka_partition int, kafka_offset long")


@pytest.mark.parametrize("update, whole, key", [
    (incremental.update_hourly_activity, gold.hourly_vehicle_activity, "hour"),
    (incremental.update_snapshot_metrics, gold.snapshot_metrics, "source_file"),
])
def test_only_touched_parts_are_written_again(spark, tmp_path, update, whole, key):
    silver, out = str(tmp_path / "silver"), str(tmp_path / "gold")
    old = positions(spark, [("a", 1, 0), ("b", 1, 5), ("a", 2, 0), ("a", 26, 0)])
    new = positions(spark, [("c", 2, 9), ("c", 3, 0)])
    for rows in (old, new):
        before = files_below(out)
        incremental.append_silver(rows, silver)
        update(rows, spark.read.parquet(silver), out)
    after = files_below(out)
    assert len(before) == 3 and len(before & after) == 2 and len(after - before) == 2
    both = whole(old.unionByName(new))
    assert sorted(map(str, incremental.read_parts(spark, out, both.schema).collect())) == sorted(map(str, both.collect()))
    update(new.filter("false"), spark.read.parquet(silver), out)
    assert files_below(out) == after


def test_profiles_are_gathered_while_writing(spark, tmp_path):
    raw = positions(spark, [("a", 1, 0), ("a", 1, 0), ("b", 2, 5), (None, 3, 0)])
    raw.write.parquet(str(tmp_path / "raw"))
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        scans.add(1)
        yield from batches

    read = spark.read.parquet(str(tmp_path / "raw")).coalesce(1)
    got = gold.silver_with_profile(read.mapInArrow(counted, read.schema), str(tmp_path / "silver"))
    from waybill.operators.silver import historical_silver
    assert got.columns == gold.silver_profile(raw, historical_silver(raw)).columns
    assert got.collect() == gold.silver_profile(raw, historical_silver(raw)).collect() and scans.value == 1
    moved = spark.createDataFrame([("a", 1.0, 2.0, True), ("b", None, 4.0, False)], "vehicle_id string, distance_km double, speed_kmh double, is_speed_anomaly boolean")
    from waybill.operators.movement import movement_profile
    assert gold.movement_with_profile(moved, str(tmp_path / "moved")).collect() == movement_profile(moved).collect()
    assert spark.read.parquet(str(tmp_path / "moved")).count() == 2
    none = gold.movement_with_profile(moved.filter("false"), str(tmp_path / "none")).collect()
    assert none == movement_profile(moved.filter("false")).collect()
