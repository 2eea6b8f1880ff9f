import os
import struct

import pytest

from waybill.plans.gold import snapshot_metrics
from waybill.sources import snapshots


def encode(*entities):
    feed = snapshots.feed_message()()
    feed.header.gtfs_realtime_version = "2.0"
    for at, fill in enumerate(entities):
        entity = feed.entity.add(id=str(at))
        if fill is not None:
            entity.vehicle.SetInParent()
            fill(entity.vehicle)
    return feed.SerializeToString()


def full(v):
    v.vehicle.id = "V1"
    v.trip.trip_id, v.trip.route_id = "T1", "R1"
    v.position.latitude, v.position.longitude = 28.60894, 77.2
    v.timestamp, v.current_status = 1_704_100_000, 2


def no_trip(v):
    v.vehicle.SetInParent()  # present, id unset


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "vehicle_positions_20240101_100000.bin").write_bytes(encode(full, None, no_trip))
    (tmp_path / "vehicle_positions_20240101_100100.bin").write_bytes(encode(lambda v: None))
    (tmp_path / "vehicle_positions_20240101_100200.bin").write_bytes(encode(None))
    (tmp_path / "notes.txt").write_text("x")
    for at, name in enumerate(sorted(os.listdir(tmp_path))):
        os.utime(tmp_path / name, (1_700_000_000 - at, 1_700_000_000 - at))
    return str(tmp_path)


def test_decode(spark, folder):
    rows = snapshots.decode_snapshots(snapshots.snapshot_scan(spark, folder)).collect()
    assert len(rows) == 3  # entities without a vehicle are skipped
    known = next(r for r in rows if r.vehicle_id == "V1")
    assert (known.route_id, known.trip_id, known.vehicle_status) == ("R1", "T1", "2")
    assert known.latitude == struct.unpack("f", struct.pack("f", 28.60894))[0]  # 32-bit precision kept
    assert known.vehicle_timestamp.timestamp() == 1_704_100_000
    assert known.ingestion_timestamp.strftime("%H:%M:%S") == "10:00:00"
    unset = next(r for r in rows if r.vehicle_id == "")
    assert unset.route_id is None and unset.latitude is None and unset.vehicle_timestamp is None
    bare = next(r for r in rows if r.vehicle_id is None)
    assert bare.source_file == "vehicle_positions_20240101_100100.bin" and bare.vehicle_status is None


def test_metrics_cover_files_without_positions(spark, folder):
    files = snapshots.snapshot_scan(spark, folder)
    got = {r.source_file: r.total_records for r in snapshot_metrics(snapshots.decode_snapshots(files), files).collect()}
    assert sorted(got.values()) == [0, 1, 2]


def test_latest_is_by_modification_time(spark, folder):
    newest = snapshots.latest_snapshot_scan(spark, folder).first()
    assert newest.path.endswith("vehicle_positions_20240101_100000.bin")


def test_no_snapshots(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshots.snapshot_scan(spark, str(tmp_path))


def test_broken_snapshot_fails_the_job(spark, tmp_path):
    (tmp_path / "vehicle_positions_20240101_100000.bin").write_bytes(b"\xff\xff\xff")
    with pytest.raises(Exception):
        snapshots.decode_snapshots(snapshots.snapshot_scan(spark, str(tmp_path))).collect()
