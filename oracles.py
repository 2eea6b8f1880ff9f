"""The SQL each registered query is compared with, in DuckDB's dialect.

``vp`` derives the vehicle positions from ``events`` by the same rules as
``waybill.fixtures``; the other common tables build on it.
"""

from __future__ import annotations

VP = """
seen AS (
  SELECT event_id, user_id,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 24 AS us,
         unnest(list_concat([0],
                CASE WHEN event_id % 50 = 0 THEN [0] ELSE CAST([] AS INTEGER[]) END,
                CASE WHEN event_id % 70 = 0 THEN [1] ELSE CAST([] AS INTEGER[]) END)) AS copy
  FROM events
),
vp AS (
  SELECT
    CASE WHEN event_id % 131 = 0 THEN 2 ELSE 1 END AS event_version,
    CASE WHEN event_id % 137 = 0 THEN 'heartbeat' ELSE 'vehicle_position' END AS event_type,
    CASE WHEN event_id % 211 = 0 THEN NULL WHEN event_id % 223 = 0 THEN ''
         ELSE concat('V', user_id) END AS vehicle_id,
    CASE WHEN event_id % 23 = 0 THEN NULL
         ELSE concat('R', (user_id + event_id % 2) % 12) END AS route_id,
    CASE WHEN event_id % 29 = 0 THEN NULL
         ELSE concat('T', user_id, '_', event_id % 5) END AS trip_id,
    CASE WHEN event_id % 97 = 0 THEN 95.0::DOUBLE WHEN event_id % 101 = 0 THEN NULL
         ELSE 28.6::DOUBLE + ((event_id * 7919) % 200)::DOUBLE / 10000::DOUBLE END AS latitude,
    CASE WHEN event_id % 103 = 0 THEN (-190.0)::DOUBLE WHEN event_id % 107 = 0 THEN NULL
         ELSE 77.2::DOUBLE + ((event_id * 104729) % 40)::DOUBLE / 10000::DOUBLE END AS longitude,
    CASE WHEN event_id % 109 = 0 THEN NULL ELSE make_timestamp(us) END AS vehicle_timestamp,
    make_timestamp(us + (1 + event_id % 90) * 1000000 + copy * 3600000000) AS ingestion_timestamp,
    concat('vehicle_positions_',
           strftime(date_trunc('hour', make_timestamp(us + (1 + event_id % 90) * 1000000 + copy * 3600000000)),
                    '%Y%m%d_%H%M%S'), '.bin') AS source_file,
    (event_id % 3)::INTEGER AS kafka_partition,
    event_id + copy * 1000000000 AS kafka_offset
  FROM seen
)"""

SILVER = """
silver AS (
  SELECT DISTINCT * FROM vp
  WHERE vehicle_id IS NOT NULL AND vehicle_timestamp IS NOT NULL
    AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
)"""

MOVEMENT = """
steps AS (
  SELECT *,
    lag(latitude) OVER line AS lat0, lag(longitude) OVER line AS lon0,
    lag(vehicle_timestamp) OVER line AS t0
  FROM silver WHERE route_id IS NOT NULL
  WINDOW line AS (PARTITION BY vehicle_id ORDER BY vehicle_timestamp, kafka_offset)
),
gaps AS (
  SELECT *, epoch_us(vehicle_timestamp) - epoch_us(t0) AS gap,
    pow(sin(radians(latitude - lat0) / 2), 2)
      + cos(radians(lat0)) * cos(radians(latitude)) * pow(sin(radians(longitude - lon0) / 2), 2) AS chord
  FROM steps WHERE t0 IS NOT NULL
),
paced AS (
  SELECT *, 12742.0::DOUBLE * atan2(sqrt(chord), sqrt(1 - chord)) AS distance_km,
    CASE WHEN gap > 0 THEN gap::DOUBLE / 1e6 / 60 END AS time_difference_minutes
  FROM gaps WHERE gap <= 300000000
),
fast AS (SELECT *, distance_km / (time_difference_minutes / 60) AS raw_speed FROM paced),
movement AS (
  SELECT vehicle_id, route_id, trip_id, latitude, longitude, vehicle_timestamp, distance_km,
    time_difference_minutes, CASE WHEN raw_speed > 120 THEN NULL ELSE raw_speed END AS speed_kmh,
    coalesce(raw_speed > 120, false) AS is_speed_anomaly
  FROM fast
)"""

PERFORMANCE = """
performance AS (
  SELECT route_id, count(speed_kmh) AS movement_records,
    sum(CASE WHEN speed_kmh IS NOT NULL THEN distance_km END) AS total_distance_km,
    avg(speed_kmh) AS average_speed_kmh, median(speed_kmh) AS median_speed_kmh,
    min(speed_kmh) AS minimum_speed_kmh, max(speed_kmh) AS maximum_speed_kmh,
    count(DISTINCT vehicle_id) AS active_vehicles
  FROM movement GROUP BY route_id HAVING count(speed_kmh) >= 5
)"""

ROUTE_SUMMARY = """
newest AS (
  SELECT * FROM silver WHERE route_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY vehicle_timestamp DESC, kafka_offset DESC) = 1
),
route_vehicles AS (
  SELECT route_id, count(DISTINCT vehicle_id) AS active_vehicles, count(DISTINCT trip_id) AS unique_trips
  FROM newest GROUP BY route_id
)"""

HOURLY = """
hourly AS (
  SELECT date_trunc('hour', vehicle_timestamp)::TIMESTAMP AS hour, count(DISTINCT vehicle_id) AS active_vehicles,
    count(DISTINCT route_id) AS active_routes, count(*) AS total_records
  FROM silver GROUP BY 1
)"""

EVENTS = """
streamed AS (
  SELECT event_version, event_type, vehicle_id, route_id, trip_id, latitude, longitude,
    vehicle_timestamp, ingestion_timestamp, kafka_partition, kafka_offset,
    ingestion_timestamp AS kafka_timestamp
  FROM vp
),
valid AS (
  SELECT * FROM streamed
  WHERE event_version = 1 AND event_type = 'vehicle_position' AND vehicle_id IS NOT NULL
    AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
    AND vehicle_timestamp IS NOT NULL AND ingestion_timestamp IS NOT NULL
)"""

CODES = """
coded AS (
  SELECT *, CASE
    WHEN event_version IS NULL THEN 'missing_or_invalid_event_version'
    WHEN event_version <> 1 THEN 'unsupported_event_version'
    WHEN event_type IS NULL THEN 'missing_event_type'
    WHEN event_type <> 'vehicle_position' THEN 'invalid_event_type'
    WHEN vehicle_id IS NULL THEN 'missing_vehicle_id'
    WHEN latitude IS NULL THEN 'missing_latitude'
    WHEN latitude NOT BETWEEN -90 AND 90 THEN 'invalid_latitude'
    WHEN longitude IS NULL THEN 'missing_longitude'
    WHEN longitude NOT BETWEEN -180 AND 180 THEN 'invalid_longitude'
    WHEN vehicle_timestamp IS NULL THEN 'missing_vehicle_timestamp'
    WHEN ingestion_timestamp IS NULL THEN 'missing_ingestion_timestamp' END AS validation_error
  FROM streamed
)"""


# what the damages by offset do to the parsed fields; text after the object and further keys do nothing
DAMAGED = """
streamed AS (
  SELECT CASE WHEN d IN (11, 13, 15, 17) THEN NULL ELSE event_version END AS event_version,
    CASE WHEN d IN (11, 13, 19) THEN NULL ELSE event_type END AS event_type,
    CASE WHEN d IN (11, 13) THEN NULL ELSE vehicle_id END AS vehicle_id,
    CASE WHEN d IN (7, 11, 13) THEN NULL ELSE latitude END AS latitude,
    CASE WHEN d IN (11, 13) THEN NULL ELSE longitude END AS longitude,
    CASE WHEN d IN (11, 13) THEN NULL ELSE vehicle_timestamp END AS vehicle_timestamp,
    CASE WHEN d IN (11, 13, 21) THEN NULL ELSE ingestion_timestamp END AS ingestion_timestamp,
    kafka_partition, kafka_offset
  FROM (SELECT *, kafka_offset % 40 AS d FROM vp)
)"""


def _latest(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT vehicle_id, route_id, trip_id, latitude, longitude, vehicle_timestamp, ingestion_timestamp,
    kafka_partition, kafka_offset, ingestion_timestamp AS updated_at
  FROM {source}
  QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY vehicle_timestamp DESC, kafka_offset DESC) = 1
)"""


NOW = "TIMESTAMP '2024-01-02 08:00:00'"
SPLIT = "TIMESTAMP '2024-01-01 15:00:00'"
BEFORE = f"vehicle_timestamp < {SPLIT}"
SINCE = f"vehicle_timestamp >= {SPLIT}"


def _summary(name: str, source: str, at: str = NOW) -> str:
    return f"""
{name} AS (
  SELECT route_id, count(DISTINCT vehicle_id) AS active_vehicle_count,
    count(DISTINCT trip_id) AS active_trip_count, max(vehicle_timestamp) AS last_observed_at,
    {at} AS updated_at
  FROM {source} WHERE route_id IS NOT NULL GROUP BY route_id
)"""


def _registry(name: str, where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT route_id, min(vehicle_timestamp) AS first_seen_at, max(vehicle_timestamp) AS last_seen_at,
    count(DISTINCT vehicle_id) AS active_vehicle_count, count(DISTINCT trip_id) AS active_trip_count
  FROM silver WHERE route_id IS NOT NULL AND {where} GROUP BY route_id
)"""


def _stops(name: str, where: str = "true") -> str:
    return f"""
{name} AS (
  SELECT concat('INF_', la, '_', lo) AS stop_id,
    concat('Inferred Mobility Point INF_', la, '_', lo) AS stop_name,
    la AS latitude, lo AS longitude, 0 AS location_type, 'realtime_inferred' AS source,
    count(vehicle_id) AS observation_count,
    min(vehicle_timestamp) AS first_seen_at, max(vehicle_timestamp) AS last_seen_at
  FROM (SELECT *, round_even(latitude * 1000, 0) / 1000 AS la, round_even(longitude * 1000, 0) / 1000 AS lo
        FROM silver WHERE {where})
  GROUP BY la, lo HAVING count(vehicle_id) >= 10
)"""


ANOMALIES = """
route_hours AS (
  SELECT route_id, date_trunc('hour', vehicle_timestamp)::TIMESTAMP AS hour,
    count(DISTINCT vehicle_id) AS active_vehicles
  FROM silver WHERE route_id IS NOT NULL GROUP BY 1, 2
),
route_means AS (
  SELECT *, avg(active_vehicles) OVER (PARTITION BY route_id) AS avg_active_vehicles FROM route_hours
),
deviations AS (
  SELECT *, 100 * (active_vehicles - avg_active_vehicles) / avg_active_vehicles AS deviation_percent
  FROM route_means
),
anomalies AS (
  SELECT *, CASE WHEN deviation_percent >= 10 THEN 'HIGH_ACTIVITY'
                 WHEN deviation_percent <= -10 THEN 'LOW_ACTIVITY' ELSE 'NORMAL' END AS anomaly_status
  FROM deviations
)"""

ALERTS = """
alerts AS (
  SELECT row_number() OVER (ORDER BY hour, route_id) AS alert_id, route_id, hour AS alert_time,
    anomaly_status AS alert_type, deviation_percent,
    format('Route {}: {} at {} ({} vehicles)', route_id, anomaly_status,
           strftime(hour, '%Y-%m-%d %H:%M'), active_vehicles) AS message
  FROM anomalies WHERE anomaly_status <> 'NORMAL'
)"""

# per snapshot, from positions as the feed carries them
SNAPSHOT_METRICS = """
SELECT max({time}) AS snapshot_time,
  strptime(regexp_extract(source_file, '(\\d{{8}}_\\d{{6}})', 1), '%Y%m%d_%H%M%S') AS ingestion_timestamp,
  source_file, count(DISTINCT nullif(vehicle_id, '')) AS active_vehicles,
  count(DISTINCT nullif(route_id, '')) AS active_routes, count(*) AS total_records
FROM vp GROUP BY source_file"""

SECONDS = "date_trunc('second', vehicle_timestamp)::TIMESTAMP"

EVENT_COLUMNS = (
    "event_version, event_type, vehicle_id, route_id, trip_id, latitude, longitude, "
    "vehicle_timestamp, ingestion_timestamp"
)
LATEST_COLUMNS = (
    "vehicle_id, route_id, trip_id, latitude, longitude, vehicle_timestamp, ingestion_timestamp, "
    "kafka_partition, kafka_offset"
)
STATE_COLUMNS = "vehicle_id, route_id, trip_id, latitude, longitude, vehicle_timestamp"
PER_MINUTE = """
SELECT date_trunc('minute', vehicle_timestamp)::TIMESTAMP AS window_start,
  date_trunc('minute', vehicle_timestamp)::TIMESTAMP + INTERVAL 1 MINUTE AS window_end, count(*) AS vehicle_events
FROM vp WHERE vehicle_id IS NOT NULL AND vehicle_timestamp IS NOT NULL GROUP BY 1, 2"""

PER_MINUTE_LATE = """
span AS (SELECT min(epoch_us(vehicle_timestamp)) AS low, max(epoch_us(vehicle_timestamp)) AS high FROM vp),
parts AS (
  SELECT vehicle_id, vehicle_timestamp AS event_at, date_trunc('minute', vehicle_timestamp)::TIMESTAMP AS minute, least(
    coalesce((epoch_us(vehicle_timestamp) - low) * 8 // (high - low + 1), 0)
      + CASE WHEN kafka_offset % 13 = 5 THEN 2 + kafka_offset % 3 ELSE 0 END, 7) AS file_no
  FROM vp, span),
batches AS (SELECT *, dense_rank() OVER (ORDER BY file_no) AS batch FROM parts),
timed AS (SELECT * FROM batches WHERE vehicle_id IS NOT NULL AND event_at IS NOT NULL),
newest AS (SELECT batch, max(epoch_ms(event_at)) AS newest_ms FROM timed GROUP BY batch),
marks AS (
  SELECT b.batch, max(n.newest_ms) - 120000 AS mark FROM (SELECT DISTINCT batch FROM batches) b
  LEFT JOIN newest n ON n.batch <= b.batch - 2 GROUP BY b.batch)"""


def _iso(column: str) -> str:
    return (f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({column}) % 1000000 = 0 THEN '' "
            f"ELSE strftime({column}, '.%f') END || '+00:00'")


def _r(*names: str) -> str:
    """Six decimals by the same arithmetic as the Spark side, as a REPLACE list."""
    return ", ".join(f"floor({n} * 1e6 + 0.5) / 1e6 AS {n}" for n in names)


def _json(column: str) -> str:
    quoted = f"'\"' || {column} || '\"'"
    return f"coalesce({quoted}, 'null')"


VALUE_LENGTH = " || ',' || ".join([
    "'{\"event_version\":' || event_version",
    f"'\"event_type\":' || {_json('event_type')}",
    f"'\"vehicle_id\":' || {_json('vehicle_id')}",
    f"'\"route_id\":' || {_json('route_id')}",
    f"'\"trip_id\":' || {_json('trip_id')}",
    "'\"latitude\":' || coalesce(latitude::VARCHAR, 'null')",
    "'\"longitude\":' || coalesce(longitude::VARCHAR, 'null')",
    f"'\"vehicle_timestamp\":' || {_json('(' + _iso('vehicle_timestamp') + ')')}",
    f"'\"ingestion_timestamp\":' || {_json('(' + _iso('ingestion_timestamp') + ')')} || '}}'",
])

CONTRACT = """event_version = 1 AND event_type = 'vehicle_position'
  AND vehicle_id IS NOT NULL AND vehicle_id <> ''
  AND (latitude IS NULL OR latitude BETWEEN -90 AND 90)
  AND (longitude IS NULL OR longitude BETWEEN -180 AND 180) AND ingestion_timestamp IS NOT NULL"""

OBSERVED = """
SELECT {name} AS table_name, sum(n)::BIGINT AS row_count, sum(missing)::BIGINT AS null_count,
  count(*) FILTER (WHERE n > 1) AS duplicate_count
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE vehicle_id IS NULL OR ingestion_timestamp IS NULL) AS missing
      FROM vp WHERE {where} GROUP BY vehicle_id, vehicle_timestamp)"""


def _check(name: str, failed: str, message: str) -> str:
    return (f"SELECT '{name}' AS check_name, ({failed}) = 0 AS passed, ({failed})::BIGINT AS failed_count, "
            f"{message} AS message FROM vp")


def _message(*reasons: tuple[str, str]) -> str:
    cases = " ".join(f"WHEN count(*) FILTER (WHERE {when}) > 0 THEN '{text}'" for when, text in reasons)
    return f"CASE {cases} ELSE '' END"


def _failed(*conditions: str) -> str:
    return f"count(*) FILTER (WHERE {' OR '.join(conditions)})"


CHECKS = " UNION ALL ".join([
    _check("vehicle_id_not_empty", _failed("vehicle_id IS NULL", "trim(vehicle_id) = ''"),
           _message(("vehicle_id IS NULL", "vehicle_id is null"), ("trim(vehicle_id) = ''", "vehicle_id is empty"))),
    _check("route_id_not_empty", _failed("route_id IS NULL", "trim(route_id) = ''"),
           _message(("route_id IS NULL", "route_id is null"), ("trim(route_id) = ''", "route_id is empty"))),
    _check("kafka_offset_non_negative", _failed("kafka_offset IS NULL", "kafka_offset < 0"),
           _message(("kafka_offset IS NULL", "kafka_offset is null"),
                    ("kafka_offset < 0", "kafka_offset must be non-negative"))),
    _check("latitude_in_range", _failed("latitude IS NULL", "latitude NOT BETWEEN -90 AND 90"),
           _message(("latitude IS NULL", "latitude is null"),
                    ("latitude NOT BETWEEN -90 AND 90", "latitude must be between -90 and 90"))),
    _check("longitude_in_range", _failed("longitude IS NULL", "longitude NOT BETWEEN -180 AND 180"),
           _message(("longitude IS NULL", "longitude is null"),
                    ("longitude NOT BETWEEN -180 AND 180", "longitude must be between -180 and 180"))),
    "SELECT 'required_columns', true, 0::BIGINT, ''",
    "SELECT 'bearing_present', false, 0::BIGINT, 'Missing columns: bearing'",
    _check("kafka_partition_not_empty", _failed("kafka_partition IS NULL"),
           _message(("kafka_partition IS NULL", "kafka_partition is null"))),
])


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(part.strip() for part in parts) + "\n" + select.strip()


def sql() -> dict[str, str]:
    silver = [VP, SILVER]
    moved = [*silver, MOVEMENT]
    performed = [*moved, PERFORMANCE]
    events = [VP, EVENTS]
    coded = [*events, CODES]
    latest = [*events, _latest("latest", "valid")]
    summary = [*latest, _summary("summary", "latest")]
    anomalies = [*silver, ANOMALIES]
    alerts = [*anomalies, ALERTS]
    routed = [*silver, ROUTE_SUMMARY]
    hourly = [*silver, HOURLY]
    widened = [*silver, _registry("stored", BEFORE), _registry("fresh", SINCE)]
    speeds = _r("total_distance_km", "average_speed_kmh", "median_speed_kmh", "minimum_speed_kmh", "maximum_speed_kmh")
    movement = f"SELECT * REPLACE ({_r('distance_km', 'time_difference_minutes', 'speed_kmh')}) FROM movement"
    performance = f"SELECT * REPLACE ({speeds}) FROM performance"
    widen = """
SELECT coalesce(s.route_id, f.route_id) AS route_id, least(s.first_seen_at, f.first_seen_at) AS first_seen_at,
  greatest(s.last_seen_at, f.last_seen_at) AS last_seen_at,
  CASE WHEN f.route_id IS NOT NULL THEN f.active_vehicle_count ELSE s.active_vehicle_count END AS active_vehicle_count,
  CASE WHEN f.route_id IS NOT NULL THEN f.active_trip_count ELSE s.active_trip_count END AS active_trip_count
FROM stored s FULL JOIN fresh f ON s.route_id = f.route_id"""
    overwrite = """
SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE {key} NOT IN (SELECT {key} FROM fresh)"""
    deviation = _r("avg_active_vehicles", "deviation_percent")
    unusual = """FROM anomalies WHERE anomaly_status <> 'NORMAL'
ORDER BY abs(deviation_percent) DESC, hour, route_id LIMIT 20"""
    state = f"""
SELECT {STATE_COLUMNS} FROM vp WHERE vehicle_id IS NOT NULL AND vehicle_timestamp IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY vehicle_timestamp DESC, kafka_offset DESC) = 1"""
    decoded = f"""
SELECT vehicle_id, CASE WHEN route_id IS NULL AND trip_id IS NOT NULL THEN '' ELSE route_id END AS route_id,
  CASE WHEN trip_id IS NULL AND route_id IS NOT NULL THEN '' ELSE trip_id END AS trip_id,
  CASE WHEN longitude IS NOT NULL THEN latitude::FLOAT::DOUBLE END AS latitude,
  CASE WHEN latitude IS NOT NULL THEN longitude::FLOAT::DOUBLE END AS longitude,
  {SECONDS} AS vehicle_timestamp,
  strptime(regexp_extract(source_file, '(\\d{{8}}_\\d{{6}})', 1), '%Y%m%d_%H%M%S') AS ingestion_timestamp,
  (kafka_offset % 3)::VARCHAR AS vehicle_status, source_file FROM vp"""
    validated = f"SELECT {EVENT_COLUMNS}, kafka_partition, kafka_offset, kafka_timestamp FROM coded WHERE validation_error IS NULL"

    known = {
        "event_source": _with([VP], f"""
SELECT vehicle_id AS key, kafka_partition, kafka_offset, ingestion_timestamp AS kafka_timestamp,
  length({VALUE_LENGTH})::INTEGER AS value_length FROM vp"""),
        "kafka_decode": _with([VP], f"""
SELECT vehicle_id AS key, {VALUE_LENGTH} AS value, kafka_partition, kafka_offset,
  ingestion_timestamp AS kafka_timestamp FROM vp"""),
        "parse_events": _with(events, "SELECT * FROM streamed"),
        "streaming_silver": _with(events, "SELECT * FROM valid"),
        "event_time_filter": _with([VP], """
SELECT vehicle_id, vehicle_timestamp, kafka_partition, kafka_offset FROM vp
WHERE vehicle_id IS NOT NULL AND vehicle_timestamp IS NOT NULL"""),
        "validation_error": _with(coded, "SELECT kafka_partition, kafka_offset, validation_error FROM coded"),
        "valid_events": _with(coded, validated),
        "quarantine": _with(coded, """
SELECT event_version, event_type, vehicle_id, route_id, trip_id, latitude, longitude, kafka_partition,
  kafka_offset, kafka_timestamp, validation_error FROM coded WHERE validation_error IS NOT NULL"""),
        "contract_check": _with([VP], f"""
SELECT kafka_partition, kafka_offset, coalesce({CONTRACT}, false) AS contract_ok FROM vp"""),
        "contract_breaches": _with([VP], f"""
SELECT kafka_partition, kafka_offset,
  coalesce({CONTRACT}, false) AND kafka_offset % 40 NOT IN (3, 5, 9, 11, 13, 15, 17, 19, 21)
    AND NOT (kafka_offset % 40 = 7 AND latitude IS NOT NULL) AS contract_ok FROM vp"""),
        "every_validation_error": _with(
            [VP, DAMAGED, CODES], "SELECT kafka_partition, kafka_offset, validation_error FROM coded"),
        "build_event": _with([VP], """
SELECT 1 AS event_version, 'vehicle_position' AS event_type, vehicle_id, route_id, trip_id, latitude,
  longitude, vehicle_timestamp, ingestion_timestamp FROM vp WHERE vehicle_id <> ''"""),
        "publish_events": _with([VP], f"""
SELECT vehicle_id AS key, 1 AS event_version, 'vehicle_position' AS event_type, vehicle_id, route_id, trip_id,
  latitude, longitude, {_iso('vehicle_timestamp')} AS vehicle_timestamp,
  {_iso('ingestion_timestamp')} AS ingestion_timestamp
FROM vp WHERE vehicle_id <> '' AND (latitude IS NULL OR latitude BETWEEN -90 AND 90)
  AND (longitude IS NULL OR longitude BETWEEN -180 AND 180)"""),
        "snapshot_scan": _with([VP], """
SELECT DISTINCT source_file,
  strptime(regexp_extract(source_file, '(\\d{8}_\\d{6})', 1), '%Y%m%d_%H%M%S') AS ingestion_timestamp FROM vp"""),
        "latest_snapshot_scan": _with([VP], "SELECT max(source_file) AS source_file, 1::BIGINT AS files FROM vp"),
        "decode_snapshots": _with([VP], decoded),
        "exact_dedupe": _with([VP], "SELECT DISTINCT * FROM vp"),
        "historical_silver": _with(silver, "SELECT * FROM silver"),
        "snapshot_silver": _with(silver, "SELECT DISTINCT * EXCLUDE (source_file) FROM silver"),
        "silver_profile": _with(silver, """
SELECT (SELECT count(*) FROM vp) AS raw_records, count(*) AS clean_records,
  count(DISTINCT vehicle_id) AS unique_vehicles, count(DISTINCT route_id) AS unique_routes,
  min(vehicle_timestamp) AS first_time, max(vehicle_timestamp) AS last_time FROM silver"""),
        "table_scan": _with(silver, """
SELECT vehicle_id, route_id, trip_id, latitude, longitude, vehicle_timestamp, ingestion_timestamp,
  source_file FROM silver"""),
        "vehicle_movement": _with(moved, movement),
        "vehicle_movement_hot_slices": _with(moved, movement),
        "movement_profile": _with(moved, """
SELECT count(*) AS movement_records, count(*) FILTER (WHERE is_speed_anomaly) AS speed_anomalies,
  floor(sum(distance_km) * 1e6 + 0.5) / 1e6 AS total_distance_km,
  floor(avg(speed_kmh) * 1e6 + 0.5) / 1e6 AS average_speed_kmh FROM movement"""),
        "route_performance": _with(performed, performance),
        "route_performance_by_rank": _with(performed, performance),
        "slowest_routes": _with(performed, f"{performance} ORDER BY performance.average_speed_kmh, route_id LIMIT 10"),
        "fastest_routes": _with(performed, f"{performance} ORDER BY performance.average_speed_kmh DESC, route_id LIMIT 10"),
        "route_vehicle_summary": _with(routed, "SELECT * FROM route_vehicles"),
        "busiest_routes": _with(routed, "SELECT * FROM route_vehicles ORDER BY active_vehicles DESC, route_id LIMIT 10"),
        "summary_totals": _with(routed, """
SELECT sum(active_vehicles)::BIGINT AS total_active_vehicles, count(*) AS total_routes FROM route_vehicles"""),
        "hourly_vehicle_activity": _with(hourly, "SELECT * FROM hourly"),
        "hourly_chronological": _with(hourly, "SELECT *, row_number() OVER (ORDER BY hour) - 1 AS place FROM hourly"),
        "snapshots_chronological": _with([VP], f"""
SELECT *, row_number() OVER (ORDER BY snapshot_time NULLS FIRST, source_file) - 1 AS place
FROM ({SNAPSHOT_METRICS.format(time="vehicle_timestamp")})"""),
        "hourly_comparison": _with(hourly, """
SELECT h.hour, h.active_vehicles, p.active_vehicles AS previous_active_vehicles,
  h.active_vehicles - p.active_vehicles AS difference
FROM hourly h LEFT JOIN hourly p ON p.hour = h.hour - INTERVAL 1 DAY"""),
        "snapshot_metrics": _with([VP], SNAPSHOT_METRICS.format(time="vehicle_timestamp")),
        "snapshot_metrics_from_files": _with([VP], SNAPSHOT_METRICS.format(time=SECONDS)),
        "inferred_stops": _with([*silver, _stops("stops")], "SELECT * FROM stops"),
        "inferred_stops_merge": _with(
            [*silver, _stops("stored", BEFORE), _stops("fresh", SINCE)], overwrite.format(key="stop_id")),
        "route_registry": _with([*silver, _registry("routes")], "SELECT * FROM routes"),
        "route_registry_merge": _with(widened, widen),
        "write_merged": _with(widened, widen),
        "route_activity_anomalies": _with(anomalies, f"SELECT * REPLACE ({deviation}) FROM anomalies"),
        "mobility_alerts": _with(alerts, f"SELECT * REPLACE ({_r('deviation_percent')}) FROM alerts"),
        "top_anomalies": _with(
            anomalies, f"SELECT * REPLACE ({deviation}) FROM (SELECT * {unusual})"),
        "anomaly_labels": _with(anomalies, f"""
SELECT route_id, hour, CASE anomaly_status WHEN 'HIGH_ACTIVITY' THEN 'High Activity' ELSE 'Low Activity' END AS label
FROM (SELECT * {unusual})"""),
        "recent_alerts": _with(alerts, f"""
SELECT * REPLACE ({_r('deviation_percent')}) FROM alerts ORDER BY alert_id DESC LIMIT 20"""),
        "latest_positions": _with(latest, "SELECT * FROM latest"),
        "latest_positions_from_json": _with(latest, "SELECT * FROM latest"),
        # the later part is newer for every vehicle it holds, so the late arrival changes nothing there
        "latest_positions_merge": _with(
            [*events, f"earlier AS (SELECT * FROM valid WHERE {BEFORE})", f"later AS (SELECT * FROM valid WHERE {SINCE})",
             _latest("stored", "later"), _latest("late", "earlier")],
            "SELECT * FROM stored UNION ALL SELECT * FROM late WHERE vehicle_id NOT IN (SELECT vehicle_id FROM stored)"),
        "route_activity_summary": _with(summary, "SELECT * FROM summary"),
        "route_summary_merge": _with(
            [*events, f"earlier AS (SELECT * FROM valid WHERE {BEFORE})", f"later AS (SELECT * FROM valid WHERE {SINCE})",
             _latest("latest0", "earlier"), _latest("latest1", "later"),
             _summary("stored", "latest0", SPLIT), _summary("fresh", "latest1")],
            overwrite.format(key="route_id")),
        "metrics_overview": _with(latest, """
SELECT count(*) AS total_vehicles, count(DISTINCT route_id) AS active_routes,
  count(DISTINCT trip_id) AS active_trips, max(vehicle_timestamp) AS latest_vehicle_timestamp FROM latest"""),
        "vehicles_latest": _with(latest, "SELECT * FROM latest ORDER BY updated_at DESC, vehicle_id LIMIT 100"),
        "vehicles_live": _with(latest, """
SELECT vehicle_id, route_id, trip_id, latitude, longitude, vehicle_timestamp, ingestion_timestamp
FROM latest ORDER BY updated_at DESC, vehicle_id"""),
        "as_answer": _with(latest, f"""
SELECT vehicle_id, route_id, trip_id, latitude, longitude, {_iso('vehicle_timestamp')} AS vehicle_timestamp,
  {_iso('ingestion_timestamp')} AS ingestion_timestamp FROM latest"""),
        "routes_activity": _with(summary, "SELECT * FROM summary ORDER BY active_vehicle_count DESC, route_id LIMIT 20"),
        "refresh": _with(summary, "SELECT * FROM summary"),
        "table_observability": _with([VP], OBSERVED.format(name="'vehicle_positions'", where="true")),
        "append_metrics": _with(
            [VP], OBSERVED.format(name="'before'", where=BEFORE) + " UNION ALL "
            + OBSERVED.format(name="'since'", where=SINCE)),
        "duplicate_keys": _with([VP], """
SELECT vehicle_id, vehicle_timestamp, count(*) AS row_count FROM vp
GROUP BY vehicle_id, vehicle_timestamp HAVING count(*) > 1"""),
        "freshness": _with([VP], f"""
SELECT latest_ingestion_timestamp, floor(age * 1e6 + 0.5) / 1e6 AS age_minutes,
  CASE WHEN age IS NULL THEN 'no_data' WHEN age > 10 THEN 'stale' ELSE 'fresh' END AS status
FROM (SELECT max(ingestion_timestamp) AS latest_ingestion_timestamp,
        (epoch_us({NOW}) - epoch_us(max(ingestion_timestamp)))::DOUBLE / 1e6 / 60 AS age FROM vp)"""),
        "freshness_outcomes": """
SELECT * FROM (VALUES ('now', 'fresh'), ('later', 'stale'), ('none', 'no_data')) t("case", status)""",
        "failed_run_record": _with(summary, f"""
SELECT 'route_activity_refresh' AS pipeline_name, 'FAILED' AS status,
  TIMESTAMP '2024-01-02 07:59:50' AS start_time, {NOW} AS end_time, 10.0::DOUBLE AS duration_seconds,
  count(*) AS records_processed, 'FAILED' AS data_quality_status FROM summary"""),
        "not_empty_check": _with(summary, """
SELECT 'route_activity_summary' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM summary"""),
        "run_record": _with(summary, f"""
SELECT 'route_activity_refresh' AS pipeline_name, 'SUCCESS' AS status,
  TIMESTAMP '2024-01-02 07:59:50' AS start_time, {NOW} AS end_time, 10.0::DOUBLE AS duration_seconds,
  count(*) AS records_processed, 'PASSED' AS data_quality_status FROM summary"""),
        "run_checks": _with([VP], CHECKS),
        "all_checks_passed": _with(
            [VP, f"checks AS ({CHECKS})"], "SELECT bool_and(passed) AS all_passed, count(*) AS checks FROM checks"),
        "validate_route_ids": _with(summary, """
SELECT 'route_id_not_empty' AS check_name, count(*) FILTER (WHERE trim(route_id) = '') = 0 AS passed,
  count(*) FILTER (WHERE trim(route_id) = '') AS failed_count,
  CASE WHEN count(*) FILTER (WHERE trim(route_id) = '') > 0 THEN 'route_id is empty' ELSE '' END AS message
FROM summary"""),
        "events_per_minute": _with([VP], PER_MINUTE),
        "events_per_minute_stream": _with([VP], PER_MINUTE),
        "latest_vehicle_state": _with([VP], state),
        "latest_vehicle_state_stream": _with([VP], state),
        "silver_stream": _with(events, "SELECT * FROM valid"),
        "quality_stream": _with(events, "SELECT * FROM valid"),
        "quality_stream_quarantine": _with(coded, """
SELECT kafka_partition, kafka_offset, validation_error FROM coded WHERE validation_error IS NOT NULL"""),
        "bronze_stream": _with([VP], """
SELECT event_version, vehicle_id, latitude, kafka_partition, kafka_offset, true AS has_arrival FROM vp"""),
        "history_stream": _with(events, f"SELECT {LATEST_COLUMNS} FROM valid"),
        "latest_stream": _with(latest, f"SELECT {LATEST_COLUMNS} FROM latest"),
        "history_stream_restart": _with(events, f"SELECT {LATEST_COLUMNS} FROM valid"),
        "latest_stream_restart": _with(latest, f"SELECT {LATEST_COLUMNS} FROM latest"),
        "latest_stream_bucketed": _with(latest, f"SELECT {LATEST_COLUMNS} FROM latest"),
        # rows whose window the watermark had closed when their batch was read are dropped
        "events_per_minute_late": _with([VP, PER_MINUTE_LATE], """
SELECT minute AS window_start, minute + INTERVAL 1 MINUTE AS window_end, count(*) AS vehicle_events
FROM timed JOIN marks USING (batch) WHERE mark IS NULL OR epoch_ms(minute) + 60000 > mark GROUP BY 1, 2"""),
        "latest_vehicle_state_restart": _with([VP], state),
        "silver_stream_batches": _with(events, "SELECT * FROM valid"),
        "quality_stream_batches": _with(events, "SELECT * FROM valid"),
        "quality_stream_batches_quarantine": _with(coded, """
SELECT kafka_partition, kafka_offset, validation_error FROM coded WHERE validation_error IS NOT NULL"""),
        "snapshot_stream": _with([VP], decoded),
        "hourly_activity_incremental": _with(hourly, "SELECT * FROM hourly"),
        "snapshot_metrics_incremental": _with(silver, SNAPSHOT_METRICS.format(time="vehicle_timestamp").replace("FROM vp", "FROM silver")),
    }
    same = {"silver_write_profile": "silver_profile", "movement_write_profile": "movement_profile", "bronze_stream_batches": "bronze_stream"}
    return known | {name: known[other] for name, other in same.items()}
