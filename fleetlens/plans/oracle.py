"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement starts from the raw driver tables (``events`` is a pre-registered view) and
re-derives the telemetry fixture with the same recipe as ``fleetlens.sources.fixtures``.
Doubles are quantised with the same rule as the Spark side (half-even at 1e-4).
"""

from __future__ import annotations

TRIP_EVENT = """trip_event AS (
  SELECT 1 + user_id % 5 AS CompanyID, concat('V', cast(user_id AS varchar)) AS VehicleID,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE concat('D', cast(user_id % 40 AS varchar)) END AS DriverID,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE user_id * 100 + event_id % 7 END AS TripID,
    concat(format('{:08x}', EventID::bigint & 4294967295), '_', cast(event_id AS varchar)) AS TripEventID,
    concat('g', cast(event_id AS varchar)) AS TripEventGuid,
    EventID, event_id AS n, date_trunc('second', ts) AS Timestamp, ts + INTERVAL 90 SECOND AS CreatedDate,
    event_id % 4 = 0 AS SevereEvent, cast(60 + (event_id * 37) % 90 AS double) AS Speed,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 0.0e0
         ELSE cast(40 + (event_id * 17) % 90 AS double) END AS SpeedLimit
  FROM (SELECT event_id, user_id, cast(ts AS timestamp) AS ts,
          CASE event_type WHEN 'click' THEN -1879048190 WHEN 'view' THEN 1048576 WHEN 'purchase' THEN 1
            WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 32 WHEN 1 THEN 1024 ELSE 4096 END
            ELSE CASE event_id % 2 WHEN 0 THEN 32768 ELSE 131072 END END AS EventID
        FROM events) e)"""

PRE_POST_EVENT = """pre_post_event AS (
  SELECT CompanyID, VehicleID, n, cast(k % 4 + 1 AS integer) AS SequenceID,
    Timestamp + to_seconds(cast(floor((k - 40) / 4.0) AS integer)) AS Timestamp,
    cast(CASE WHEN n % 10 = 3 THEN 80 ELSE greatest(0, 90 + (n * 7 + k * 13) % 23
         + CASE WHEN n % 9 = 4 THEN 40 ELSE 0 END - CASE WHEN k >= 40 THEN (k - 40) * (n % 4) ELSE 0 END) END AS double) AS Speed,
    cast(CASE WHEN n % 7 = 6 THEN 10 WHEN n % 14 = 5 THEN 80 WHEN (n + k) % 5 < 3 THEN 0
         ELSE (n * 31 + k * 17) % 100 - 50 END AS double) / 200 AS BrakingForce,
    cast((n * 19 + k * 23) % 100 - 50 AS double) / 100 AS TurningForce,
    cast((n * 11 + k * 5) % 60 - 30 AS double) / 10 AS Curvature,
    cast(CASE WHEN n % 8 = 2 AND k % 41 = 5 THEN 200 WHEN (n + k) % 17 < 3 THEN 0 WHEN (n + k) % 29 = 0 THEN 255
         ELSE 80 + (n * 3 + k * 7) % 31 END AS double) AS SpeedForwardVehicle,
    cast(CASE WHEN n % 8 = 2 AND k % 41 = 5 THEN 120 WHEN (n + k) % 17 < 4 THEN 0
         WHEN n % 6 = 1 THEN CASE WHEN k % 20 = 7 THEN 75 ELSE 2 + (n + k) % 5 END
         WHEN n % 6 = 5 THEN 70 + (n + k) % 5 ELSE 15 + (n * 5 + k * 3) % 40 END AS double) AS DistanceForwardVehicle,
    CASE WHEN (n * 3 + k) % 19 < 4 THEN 1 ELSE 0 END AS Abs,
    cast((n + k * 3) % 100 AS double) AS BrakePercentage
  FROM (SELECT t.*, k FROM trip_event t CROSS JOIN range(0, 84) r(k)) x)"""

EVENT_DIM = """event_dim AS (SELECT DISTINCT EventID, concat('E', cast(EventID AS varchar)) AS EventName FROM trip_event)"""

TRIP_EVENT_EXTRA = """trip_event_extra AS (
  SELECT CompanyID, VehicleID, TripEventID, TripEventGuid, CreatedDate,
    CASE WHEN n % 10 = 0 THEN NULL WHEN n % 20 = 1 THEN 0.0e0 ELSE cast(n % 100 AS double) / 100 END AS ImportanceScore
  FROM trip_event WHERE n % 10 IN (0, 1))"""

EVENT_CLASSIFICATION_TYPE = """event_classification_type AS (
  SELECT c.CompanyID, t.Type, t.Name FROM (SELECT DISTINCT CompanyID FROM trip_event) c,
    (VALUES (1, 'Pre-Grouped (Low)'), (2, 'Pre-Grouped (Mid)'), (3, 'Pre-Grouped (High)')) t(Type, Name))"""

EVENT_CLASSIFICATION = """event_classification AS (
  SELECT CompanyID, VehicleID, DriverID, TripEventID, cast(1 + n % 3 AS integer) AS Classification,
    CreatedDate AS Timestamp, 'AER Classification' AS "By" FROM trip_event WHERE n % 4 <> 3)"""

COMPANY = """company AS (SELECT DISTINCT CompanyID, cast(60 + CompanyID AS integer) AS ReportShardID FROM trip_event)"""

COMPANY_SETTINGS = """company_settings AS (SELECT DISTINCT CompanyID, 'AutoEventClassification' AS Name,
    CASE WHEN CompanyID = 5 THEN '{"enabled": false}' ELSE '{"enabled": true}' END AS Data FROM trip_event)"""

SHARD_SERVER = """shard_server AS (SELECT ReportShardID AS ShardID,
    CASE WHEN ReportShardID % 2 = 0 THEN 'server-b' ELSE 'server-a' END AS Server FROM company WHERE CompanyID <> 4)"""

BATCH = "time_bucket(INTERVAL 30 MINUTE, {c})"


def q4(expr: str) -> str:
    """Half-even quantisation at 1e-4 (same rule as ``fleetlens.functions.quantize``)."""
    return f"(round_even(({expr}) * 10000, 0) / 10000 + 0.0e0)"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def interval_join_sql(name: str, event_where: str, event_cols: str, sample_cols: str,
                      lo: int, hi: int, inclusive: bool = False, from_events: str = "trip_event") -> str:
    """A CTE joining events with samples by vehicle and time range (same columns as the Spark source)."""
    lt = "<=" if inclusive else "<"
    return f"""{name} AS (
  SELECT t.CompanyID, t.VehicleID, t.TripID, t.CreatedDate, t.TripEventID, t.TripEventGuid, t.DriverID, t.EventID,
    t.SevereEvent, t.Timestamp AS EventTimeStamp, t.n, {BATCH.format(c='t.CreatedDate')} AS batch_start, {event_cols},
    p.Timestamp AS ppeTimeStamp, p.SequenceID, p.n AS ppe_n, {sample_cols},
    concat(cast(date_diff('second', t.Timestamp, p.Timestamp) AS varchar), '.', cast(p.SequenceID AS varchar)) AS TimeSegment,
    cast(date_diff('second', t.Timestamp, p.Timestamp) AS double) + (p.SequenceID - 1) * 0.25e0 AS SecTimeSegment
  FROM {from_events} t JOIN pre_post_event p ON t.CompanyID = p.CompanyID AND t.VehicleID = p.VehicleID
  WHERE {event_where}
    AND p.Timestamp {'>=' if inclusive else '>'} t.Timestamp + to_seconds({lo})
    AND p.Timestamp {lt} t.Timestamp + to_seconds({hi}))"""
