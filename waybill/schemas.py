"""Row shapes shared by the batch and the streaming side."""

from pyspark.sql.types import (
    BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType, TimestampType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


# Fixed values of the event contract.
EVENT_VERSION = 1
EVENT_TYPE = "vehicle_position"
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)

EVENT = _schema(
    event_version=IntegerType, event_type=StringType, vehicle_id=StringType,
    route_id=StringType, trip_id=StringType, latitude=DoubleType, longitude=DoubleType,
    vehicle_timestamp=StringType, ingestion_timestamp=StringType,
)
EVENT_FIELDS = EVENT.fieldNames()

RECORD = _schema(
    key=BinaryType, value=BinaryType, partition=IntegerType, offset=LongType,
    timestamp=TimestampType,
)

SNAPSHOT_POSITION = _schema(
    vehicle_id=StringType, route_id=StringType, trip_id=StringType, latitude=DoubleType,
    longitude=DoubleType, vehicle_timestamp=TimestampType, ingestion_timestamp=TimestampType,
    vehicle_status=StringType, source_file=StringType,
)

HISTORICAL_SILVER = SNAPSHOT_POSITION

STREAMING_SILVER = _schema(
    event_version=IntegerType, event_type=StringType, vehicle_id=StringType,
    route_id=StringType, trip_id=StringType, latitude=DoubleType, longitude=DoubleType,
    vehicle_timestamp=TimestampType, ingestion_timestamp=TimestampType,
    kafka_partition=IntegerType, kafka_offset=LongType, kafka_timestamp=TimestampType,
)

QUARANTINE = StructType(
    [StructField("raw_event", StringType(), True)]
    + STREAMING_SILVER.fields
    + [StructField("validation_error", StringType(), True)]
)

MOVEMENT = _schema(
    vehicle_id=StringType, route_id=StringType, trip_id=StringType, latitude=DoubleType,
    longitude=DoubleType, vehicle_timestamp=TimestampType, distance_km=DoubleType,
    time_difference_minutes=DoubleType, speed_kmh=DoubleType, is_speed_anomaly=BooleanType,
)

LATEST_POSITIONS = _schema(
    vehicle_id=StringType, route_id=StringType, trip_id=StringType, latitude=DoubleType,
    longitude=DoubleType, vehicle_timestamp=TimestampType, ingestion_timestamp=TimestampType,
    kafka_partition=IntegerType, kafka_offset=LongType, updated_at=TimestampType,
)

ROUTE_SUMMARY = _schema(
    route_id=StringType, active_vehicle_count=LongType, active_trip_count=LongType,
    last_observed_at=TimestampType, updated_at=TimestampType,
)

ROUTE_REGISTRY = _schema(
    route_id=StringType, first_seen_at=TimestampType, last_seen_at=TimestampType,
    active_vehicle_count=LongType, active_trip_count=LongType,
)
