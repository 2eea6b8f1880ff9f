"""From transport records to typed events: parse, validate, split, build."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from waybill import schemas
from waybill.functions.times import iso_text, parse_iso

TRANSPORT = ["kafka_partition", "kafka_offset", "kafka_timestamp"]
TIMES = ["vehicle_timestamp", "ingestion_timestamp"]


def kafka_decode(records: DataFrame) -> DataFrame:
    """Key and value bytes to text; the transport fields keep their values."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse_events(decoded: DataFrame, parse_times: bool = True, keep_raw: bool = False) -> DataFrame:
    """Flatten the JSON value into the nine event fields plus transport fields.

    A field of the wrong type, and every field of broken JSON, becomes null. With
    ``parse_times`` the two times are timestamps, otherwise the text as received.
    ``keep_raw`` keeps the value as ``raw_event``.
    """
    carried = (["value"] if keep_raw else []) + TRANSPORT
    # As a generator the JSON is parsed once per row. As plain columns, every later filter
    # on a field would be pushed below the projection and parse it again.
    parsed = decoded.select(*carried, F.inline(F.array(F.from_json("value", schemas.EVENT))))
    fields = [
        parse_iso(F.col(name)).alias(name) if parse_times and name in TIMES else F.col(name)
        for name in schemas.EVENT_FIELDS
    ]
    raw = [F.col("value").alias("raw_event")] if keep_raw else []
    return parsed.select(*raw, *fields, *TRANSPORT)


def _in_range(name: str, bounds: tuple[int, int]) -> Column:
    return F.col(name).between(*bounds)


def streaming_silver(events: DataFrame) -> DataFrame:
    """Events of the supported version and type with an id, coordinates in range and both times."""
    return events.filter(
        (F.col("event_version") == schemas.EVENT_VERSION)
        & (F.col("event_type") == schemas.EVENT_TYPE)
        & F.col("vehicle_id").isNotNull()
        & _in_range("latitude", schemas.LATITUDE_RANGE)
        & _in_range("longitude", schemas.LONGITUDE_RANGE)
        & F.col("vehicle_timestamp").isNotNull()
        & F.col("ingestion_timestamp").isNotNull()
    )


def event_time_filter(events: DataFrame) -> DataFrame:
    """Rows that can be placed on a vehicle's time line."""
    return events.filter(F.col("vehicle_id").isNotNull() & F.col("vehicle_timestamp").isNotNull())


def with_validation_error(events: DataFrame, parsed: bool = True) -> DataFrame:
    """Adds the code of the first rule an event breaks, null for a valid event.

    With ``parsed`` a text that is not a timestamp counts as missing; without it only the
    presence of the text is tested.
    """
    kinds = dict(events.dtypes)

    def absent(name: str) -> Column:
        column = F.col(name)
        return (parse_iso(column) if parsed and kinds[name] == "string" else column).isNull()

    # fixed codes, in the order in which the rules apply
    rules = [
        ("missing_or_invalid_event_version", F.col("event_version").isNull()),
        ("unsupported_event_version", F.col("event_version") != schemas.EVENT_VERSION),
        ("missing_event_type", F.col("event_type").isNull()),
        ("invalid_event_type", F.col("event_type") != schemas.EVENT_TYPE),
        ("missing_vehicle_id", F.col("vehicle_id").isNull()),
        ("missing_latitude", F.col("latitude").isNull()),
        ("invalid_latitude", ~_in_range("latitude", schemas.LATITUDE_RANGE)),
        ("missing_longitude", F.col("longitude").isNull()),
        ("invalid_longitude", ~_in_range("longitude", schemas.LONGITUDE_RANGE)),
        ("missing_vehicle_timestamp", absent("vehicle_timestamp")),
        ("missing_ingestion_timestamp", absent("ingestion_timestamp")),
    ]
    first_broken = F.coalesce(*(F.when(broken, F.lit(code)) for code, broken in rules))
    return events.withColumn("validation_error", first_broken)


def valid_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("validation_error").isNull()).drop("validation_error", "raw_event")


def quarantine(validated: DataFrame) -> DataFrame:
    """Refused events with the reason, raw text included."""
    return validated.filter(F.col("validation_error").isNotNull())


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return valid_events(validated), quarantine(validated)


def contract_check(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``contract_ok``: whether a JSON text obeys the published event contract.

    Works on the JSON types themselves: ``from_json`` would turn a numeric id into text and
    so hide the breach.
    """
    # generator for the same reason as in parse_events: one parse per row
    # as the one element of an array the object can't be followed by other text
    kinds = ", ".join(f"{name}: variant" for name in schemas.EVENT_FIELDS)
    whole = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), f"array<struct<{kinds}>>")
    event = F.when(F.size(whole) == 1, F.try_element_at(whole, F.lit(1)))
    names = F.size(F.array_distinct(F.json_object_keys(value)))
    parsed = df.select("*", F.explode(F.array(F.struct(event.alias("event"), names.alias("names")))).alias("_read"))
    return parsed.withColumn("contract_ok", _contract(F.col("_read")["event"], F.col("_read")["names"])).drop("_read")


def _contract(event: Column, names: Column) -> Column:
    """Whether the fields of an event (of a repeated key the last value) obey; ``names`` counts its different keys."""
    fields = {name: event[name] for name in schemas.EVENT_FIELDS}
    kinds = {name: F.schema_of_variant(value) for name, value in fields.items()}

    def text(name: str, nullable: bool = False) -> Column:
        # a missing field has no kind at all, so it fails either way
        return kinds[name].isin("STRING", "VOID") if nullable else kinds[name] == "STRING"

    def number(name: str, holds) -> Column:
        return kinds[name].rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & holds(fields[name].try_cast("double"))

    def coordinate(name: str, bounds: tuple[int, int]) -> Column:
        return (kinds[name] == "VOID") | number(name, lambda x: x.between(*bounds))

    rules = [
        names == len(schemas.EVENT_FIELDS),
        number("event_version", lambda x: x == schemas.EVENT_VERSION),
        text("event_type") & (fields["event_type"].try_cast("string") == schemas.EVENT_TYPE),
        text("vehicle_id") & (F.length(fields["vehicle_id"].try_cast("string")) >= 1),
        text("route_id", nullable=True),
        text("trip_id", nullable=True),
        coordinate("latitude", schemas.LATITUDE_RANGE),
        coordinate("longitude", schemas.LONGITUDE_RANGE),
        text("vehicle_timestamp", nullable=True),
        text("ingestion_timestamp"),
    ]
    return F.coalesce(reduce(and_, rules), F.lit(False))


def build_event(positions: DataFrame, ingestion_ts: Column | None = None) -> DataFrame:
    """Position rows as versioned events; rows without an id are dropped."""
    ingestion = F.col("ingestion_timestamp") if ingestion_ts is None else ingestion_ts
    return positions.filter(F.col("vehicle_id") != "").select(
        F.lit(schemas.EVENT_VERSION).alias("event_version"),
        F.lit(schemas.EVENT_TYPE).alias("event_type"),
        "vehicle_id", "route_id", "trip_id", "latitude", "longitude", "vehicle_timestamp",
        ingestion.alias("ingestion_timestamp"),
    )


def event_json(extra: tuple[str, ...] = ()) -> Column:
    """The nine event fields as one JSON object; null fields stay as explicit nulls."""
    fields = [
        iso_text(F.col(name)).alias(name) if name in TIMES else F.col(name)
        for name in schemas.EVENT_FIELDS
    ]
    return F.to_json(F.struct(*fields, *extra), {"ignoreNullFields": "false"})


def to_records(events: DataFrame) -> DataFrame:
    """Events keyed by vehicle, as key and value columns for a topic."""
    return events.select(F.col("vehicle_id").alias("key"), event_json().alias("value"))
