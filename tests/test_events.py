import json

import pytest
from pyspark.sql import functions as F

from waybill.operators import events as ev

GOOD = {
    "event_version": 1, "event_type": "vehicle_position", "vehicle_id": "V1", "route_id": "R1", "trip_id": None,
    "latitude": 28.6, "longitude": 77.2, "vehicle_timestamp": "2024-01-01T10:00:00+00:00",
    "ingestion_timestamp": "2024-01-01T10:00:05.250000+00:00",
}


def text(**changes):
    return json.dumps({**GOOD, **changes})


def without(*names):
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


def records(spark, values):
    rows = [(b"k", None if v is None else v.encode(), 1, n) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "key binary, value binary, partition int, offset bigint").withColumn(
        "timestamp", F.timestamp_seconds(F.lit(1_704_100_000)))


def codes(spark, values, **options):
    events = ev.parse_events(ev.kafka_decode(records(spark, values)), keep_raw=True, **options)
    rows = ev.with_validation_error(events).orderBy("kafka_offset").collect()
    return [r.validation_error for r in rows]


CASES = [
    (text(), None),
    ("{bad", "missing_or_invalid_event_version"),
    ("[]", "missing_or_invalid_event_version"),
    ("", "missing_or_invalid_event_version"),
    (None, "missing_or_invalid_event_version"),
    (text(event_version=1.0), "missing_or_invalid_event_version"),
    (text(event_version=2), "unsupported_event_version"),
    (text(event_type=None), "missing_event_type"),
    (text(event_type="x"), "invalid_event_type"),
    (text(vehicle_id=None), "missing_vehicle_id"),
    (text(vehicle_id=7), None),
    (text(vehicle_id=""), None),
    (text(latitude=None), "missing_latitude"),
    (text(latitude="28.6"), "missing_latitude"),
    (text(latitude=90.5), "invalid_latitude"),
    (text(longitude=None), "missing_longitude"),
    (text(longitude=-181), "invalid_longitude"),
    (without("vehicle_timestamp"), "missing_vehicle_timestamp"),
    (text(vehicle_timestamp="not a date"), "missing_vehicle_timestamp"),
    (text(ingestion_timestamp=None), "missing_ingestion_timestamp"),
    (text(latitude=-90, longitude=180), None),
]


@pytest.mark.parametrize("parse_times", [True, False])
def test_first_broken_rule(spark, parse_times):
    values, expected = zip(*CASES)
    assert codes(spark, values, parse_times=parse_times) == list(expected)


def test_presence_only_validation_lets_an_unreadable_time_pass(spark):
    events = ev.parse_events(
        ev.kafka_decode(records(spark, [text(vehicle_timestamp="not a date")])), parse_times=False)
    assert ev.with_validation_error(events, parsed=False).first().validation_error is None


def test_split_keeps_raw_text_of_refused_events_only(spark):
    values = [v for v, _ in CASES]
    events = ev.with_validation_error(ev.parse_events(ev.kafka_decode(records(spark, values)), keep_raw=True))
    valid, refused = ev.split_valid(events)
    assert "raw_event" not in valid.columns and "validation_error" not in valid.columns
    assert valid.count() + refused.count() == len(values)
    assert {r.raw_event for r in refused.collect()} == {v for v, code in CASES if code}
    assert valid.count() == ev.streaming_silver(events).count()


def test_parsed_times_and_json_round_trip(spark):
    row = ev.parse_events(ev.kafka_decode(records(spark, [text()]))).first()
    assert row.ingestion_timestamp.microsecond == 250000
    event = ev.parse_events(ev.kafka_decode(records(spark, [text()])))
    assert json.loads(event.select(ev.event_json().alias("j")).first().j) == GOOD


def test_json_is_parsed_once(spark):
    plan = ev.streaming_silver(ev.parse_events(ev.kafka_decode(records(spark, [text()])))) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("value, ok", [
    (text(), True),
    (text(event_version=1.0), True),
    (text(event_version=2), False),
    (text(event_version="1"), False),
    (text(event_version=True), False),
    (text(event_type="bus"), False),
    (text(vehicle_id=""), False),
    (text(vehicle_id=7), False),
    (text(vehicle_id=None), False),
    (text(route_id=None, latitude=None, longitude=None, vehicle_timestamp=None), True),
    (text(route_id=5), False),
    (text(latitude=91), False),
    (text(latitude="28.6"), False),
    (text(longitude=-180), True),
    (text(ingestion_timestamp=None), False),
    (text(vehicle_timestamp="not a date"), True),
    (text(extra=1), False),
    (without("trip_id"), False),
    ("{bad", False), ("[]", False), ("null", False), ("", False), (None, False),
    (text() + " x", False), (text() + text(), False), (text() + "," + text(), False), ("  " + text() + "\n", True),
    (text().replace("{", '{"event_version": 2, ', 1), True), (text()[:-1] + ', "event_version": 2}', False),
])
def test_contract(spark, value, ok):
    df = spark.createDataFrame([(value,)], "value string")
    assert ev.contract_check(df).first().contract_ok is ok


def test_build_event_drops_rows_without_id(spark, at):
    rows = [("V", None), ("", "x"), (None, "x")]
    df = spark.createDataFrame(rows, "vehicle_id string, route_id string").withColumns({
        "trip_id": F.lit(None).cast("string"), "latitude": F.lit(1.0), "longitude": F.lit(2.0),
        "vehicle_timestamp": F.lit(at(0)), "ingestion_timestamp": F.lit(at(1)),
    })
    built = ev.build_event(df).collect()
    assert [(r.vehicle_id, r.event_version, r.event_type) for r in built] == [("V", 1, "vehicle_position")]
    # explicit nulls keep the contract's required keys in place
    assert '"route_id":null' in ev.to_records(ev.build_event(df)).first().value
