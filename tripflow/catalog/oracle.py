"""The queries of :mod:`tripflow.catalog.queries` as SQL over the test tables.

Written for DuckDB, independently of the DataFrame code. Columns with at most
three decimals are summed as decimals, which is exact in both engines.
"""

from __future__ import annotations

_RAW_TRIPS = """
  SELECT event_id AS trip_id, event_id % 2 + 1 AS VendorID, ts AS tpep_pickup_datetime,
    ts + to_seconds(CAST((event_id * 37 + user_id * 11) % 12000 - 120 AS bigint))
      AS tpep_dropoff_datetime,
    CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_id % 10 END AS passenger_count,
    CAST(event_id * 13 % 400 AS double) / 10 AS trip_distance,
    event_id % 6 + 1 AS RatecodeID,
    CASE WHEN event_id % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id % 265 + 1 END AS int) AS PULocationID,
    CAST(CASE WHEN event_id % 89 = 0 THEN NULL
         ELSE (user_id * 7 + event_id) % 265 + 1 END AS int) AS DOLocationID,
    CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
         WHEN 'signup' THEN 4 ELSE 5 END AS bigint) AS payment_type,
    CASE WHEN event_id % 53 = 0 THEN -value ELSE value + 3 END AS fare_amount,
    CAST(event_id % 3 AS double) AS extra, CAST(0.5 AS double) AS mta_tax,
    (value + 3) * (event_id % 7) / 10 AS tip_amount,
    CAST(0 AS double) AS tolls_amount, CAST(1 AS double) AS improvement_surcharge,
    CASE WHEN event_id % 61 = 0 THEN CAST(0 AS double)
         ELSE value + 4 + (event_id % 4) END AS total_amount,
    CAST(2.5 AS double) AS congestion_surcharge,
    CASE WHEN event_id % 5 = 0 THEN CAST(NULL AS double) ELSE CAST(0 AS double) END AS airport_fee
  FROM events"""

_TRIPS = f"trips AS ({_RAW_TRIPS})"

_MONTHS = f"""trips AS (
  SELECT * REPLACE (
    tpep_pickup_datetime + to_days(CAST(trip_id % 3 * 31 AS int)) AS tpep_pickup_datetime,
    tpep_dropoff_datetime + to_days(CAST(trip_id % 3 * 31 AS int)) AS tpep_dropoff_datetime)
  FROM ({_RAW_TRIPS}))"""

_SECONDS = "(floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime)))"

_INPUT_OK = """tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
    AND trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
    AND passenger_count BETWEEN 1 AND 8
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"""

_FEATURED = f"""timed AS (
  SELECT *, {_SECONDS} / 60 AS trip_duration_minutes,
    CAST(hour(tpep_pickup_datetime) AS int) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS int) AS pickup_day_of_week,
    CAST(month(tpep_pickup_datetime) AS int) AS pickup_month,
    CAST(year(tpep_pickup_datetime) AS int) AS pickup_year
  FROM trips),
featured AS (
  SELECT *,
    CASE WHEN trip_duration_minutes > 0
         THEN trip_distance / (trip_duration_minutes / 60) ELSE 0.0 END AS speed_mph,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0 END AS tip_percentage
  FROM timed)"""

_SCORE = """CASE WHEN trip_distance > 0 AND trip_duration_minutes > 0 AND fare_amount > 0
         THEN CAST(1.0 AS double) ELSE CAST(0.5 AS double) END"""

_CLEAN = f"""{_FEATURED},
silver AS (
  SELECT *, {_SCORE} AS quality_score
  FROM featured
  WHERE {_INPUT_OK}
    AND trip_duration_minutes BETWEEN 1 AND 180 AND speed_mph < 100 AND tip_percentage <= 50)"""

_FEATURE_COLUMNS = """trip_duration_minutes, pickup_hour, pickup_day_of_week, pickup_month,
  pickup_year, speed_mph, tip_percentage"""

_TRIP_COLUMNS = (
    "trip_id VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance"
    " RatecodeID store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra"
    " mta_tax tip_amount tolls_amount improvement_surcharge total_amount congestion_surcharge"
    " airport_fee"
).split()


def _sum(column: str) -> str:
    return f"CAST(sum(CAST({column} AS decimal(18, 3))) AS double)"


def _mean(column: str) -> str:
    return f"{_sum(column)} / count({column})"


def _mean_minutes(column: str = "trip_duration_minutes") -> str:
    return f"CAST(sum(CAST(round({column} * 60) AS bigint)) AS double) / 60 / count({column})"


# --- gold --------------------------------------------------------------------

_GOLD = {
    "hourly": f"""SELECT pickup_year, pickup_month, pickup_hour, count(*) AS total_trips,
  {_mean("fare_amount")} AS avg_fare, {_mean("tip_amount")} AS avg_tip,
  {_mean("trip_distance")} AS avg_distance, {_mean_minutes()} AS avg_duration,
  {_mean("passenger_count")} AS avg_passengers, {_sum("total_amount")} AS total_revenue,
  max(total_amount) AS max_fare, min(total_amount) AS min_fare
FROM silver GROUP BY pickup_year, pickup_month, pickup_hour""",
    "location": f"""SELECT *,
  CAST(dense_rank() OVER (PARTITION BY pickup_hour ORDER BY pickup_count DESC) AS int)
    AS pickup_density_rank
FROM (SELECT PULocationID, pickup_hour, count(*) AS pickup_count,
    {_mean("fare_amount")} AS avg_fare_from_location,
    {_mean("trip_distance")} AS avg_trip_distance,
    {_mean("tip_amount")} AS avg_tip_from_location,
    {_mean_minutes()} AS avg_duration_from_location
  FROM silver GROUP BY PULocationID, pickup_hour)""",
    "payment": f"""SELECT payment_type, pickup_year, pickup_month, count(*) AS payment_count,
  {_mean("total_amount")} AS avg_total_amount, {_mean("tip_amount")} AS avg_tip_amount,
  {_sum("total_amount")} AS total_revenue,
  ({_mean("tip_amount")}) / ({_mean("fare_amount")}) * 100 AS avg_tip_percentage
FROM silver GROUP BY payment_type, pickup_year, pickup_month""",
    "vendor": f"""SELECT VendorID, pickup_year, pickup_month, count(*) AS vendor_trip_count,
  {_mean("trip_distance")} AS avg_trip_distance, round(avg(speed_mph), 6) AS avg_speed,
  {_mean("quality_score")} AS avg_quality_score, {_mean_minutes()} AS avg_trip_duration,
  {_sum("total_amount")} AS vendor_total_revenue
FROM silver GROUP BY VendorID, pickup_year, pickup_month""",
}


def _from_silver(select: str, *more: str) -> str:
    parts = ",\n".join([_MONTHS, _CLEAN, *more])
    return f"WITH {parts}\n{select}"


def _with_layer(select: str) -> str:
    return f"SELECT *, 'gold' AS layer FROM ({select})"


_HOURLY = f"hourly AS ({_GOLD['hourly']})"
_LOCATION = f"location AS ({_GOLD['location']})"
_PAYMENT = f"payment AS ({_GOLD['payment']})"

_GOLD_COUNTS = """SELECT 'hourly_trip_analytics' AS table_name, count(*) AS row_count FROM
  (SELECT DISTINCT pickup_year, pickup_month, pickup_hour FROM silver)
UNION ALL SELECT 'location_hotspots', count(*) FROM
  (SELECT DISTINCT PULocationID, pickup_hour FROM silver)
UNION ALL SELECT 'payment_analytics', count(*) FROM
  (SELECT DISTINCT payment_type, pickup_year, pickup_month FROM silver)
UNION ALL SELECT 'vendor_performance', count(*) FROM
  (SELECT DISTINCT VendorID, pickup_year, pickup_month FROM silver)"""

# --- data quality ------------------------------------------------------------

_VALID = """trip_distance > 0 AND fare_amount > 0 AND trip_duration_minutes > 0
    AND passenger_count BETWEEN 1 AND 8"""
_CONSISTENT = "total_amount >= fare_amount + extra + mta_tax"


def _rate(metric: str, condition: str, table: str) -> str:
    return (
        f"SELECT '{metric}' AS metric, CAST(count(*) FILTER ({condition}) AS double) / count(*)"
        f" AS score FROM {table}"
    )


def _completeness(columns: list[str], table: str) -> list[str]:
    return [_rate(f"{name}_completeness", f"{name} IS NOT NULL", table) for name in columns]


def _uniqueness(columns: str, table: str) -> str:
    return (
        "SELECT 'uniqueness' AS metric, CAST((SELECT count(*) FROM"
        f" (SELECT DISTINCT {columns} FROM {table})) AS double) / count(*) AS score FROM {table}"
    )


def _graded(rates: list[str]) -> str:
    return f"""SELECT metric, score,
  CASE WHEN score >= 0.95 THEN 'PASS' WHEN score >= 0.8 THEN 'WARN' ELSE 'FAIL' END AS status
FROM ({" UNION ALL ".join(rates)})"""


_FEATURE_NAMES = (
    "trip_duration_minutes pickup_hour pickup_day_of_week pickup_month pickup_year"
    " tip_percentage speed_mph"
).split()


def _rates(table: str, columns: list[str], unique_over: str) -> list[str]:
    return [
        *_completeness(columns, table),
        _rate("business_rule_validity", _VALID, table),
        _rate("amount_consistency", _CONSISTENT, table),
        _uniqueness(unique_over, table),
    ]


# --- profile -----------------------------------------------------------------

_PROFILED = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]


def _described(column: str, quartiles: bool) -> str:
    extra = "".join(
        f", round(quantile_cont(CAST({column} AS double), {p}), 6) AS {name}"
        for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    )
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS value_count,"
        f" {_mean(column)} AS mean, round(stddev_samp({column}), 6) AS stddev,"
        f" CAST(min({column}) AS double) AS min, CAST(max({column}) AS double) AS max"
        f"{extra if quartiles else ''} FROM trips"
    )


_NUMERIC = [
    name
    for name in _TRIP_COLUMNS
    if name
    not in ("trip_id", "store_and_fwd_flag", "tpep_pickup_datetime", "tpep_dropoff_datetime")
]

# --- streaming ---------------------------------------------------------------

# A window is emitted once the watermark, ten minutes behind the latest pickup,
# has passed its end.
_STREAM = f"""{_TRIPS},
moving AS (
  SELECT *, {_SECONDS} / 60 AS trip_duration_minutes
  FROM trips
  WHERE fare_amount > 0 AND trip_distance > 0
    AND tpep_dropoff_datetime > tpep_pickup_datetime),
streamed AS (
  SELECT *, CASE WHEN trip_duration_minutes > 0
                 THEN trip_distance / (trip_duration_minutes / 60) END AS speed_mph
  FROM moving),
watermark AS (
  SELECT max(tpep_pickup_datetime) - INTERVAL 10 MINUTE AS reached FROM streamed),
sliding AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, tpep_pickup_datetime) AS window_start FROM streamed
  UNION ALL
  SELECT *, time_bucket(INTERVAL 5 MINUTE, tpep_pickup_datetime) - INTERVAL 5 MINUTE
  FROM streamed),
tumbling AS (
  SELECT *, time_bucket(INTERVAL 15 MINUTE, tpep_pickup_datetime) AS window_start FROM streamed),
time_metrics AS (
  SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end,
    count(*) AS trip_count, {_sum("total_amount")} AS total_revenue,
    {_mean("trip_distance")} AS avg_distance, {_mean_minutes()} AS avg_duration,
    avg(speed_mph) AS avg_speed
  FROM sliding GROUP BY window_start
  HAVING window_start + INTERVAL 10 MINUTE <= (SELECT reached FROM watermark)),
location_metrics AS (
  SELECT PULocationID, window_start, window_start + INTERVAL 15 MINUTE AS window_end,
    count(*) AS pickup_count, {_sum("total_amount")} AS zone_revenue
  FROM tumbling GROUP BY PULocationID, window_start
  HAVING window_start + INTERVAL 15 MINUTE <= (SELECT reached FROM watermark)),
payment_metrics AS (
  SELECT payment_type, window_start, window_start + INTERVAL 15 MINUTE AS window_end,
    count(*) AS payment_count, {_sum("total_amount")} AS payment_revenue,
    {_mean("tip_amount")} AS avg_tip
  FROM tumbling GROUP BY payment_type, window_start
  HAVING window_start + INTERVAL 15 MINUTE <= (SELECT reached FROM watermark))"""

_BY_END = f"""ends AS (
  SELECT window_end, CAST(sum(trip_count) AS bigint) AS trips,
    {_sum("total_revenue")} AS revenue, avg(avg_distance) AS distance,
    avg(avg_duration) AS duration, avg(avg_speed) AS speed
  FROM time_metrics GROUP BY window_end)"""

ORACLE: dict[str, str] = {
    "bronze_partition_columns": f"""WITH {_MONTHS}
SELECT trip_id, CAST(year(tpep_pickup_datetime) AS int) AS year,
  CAST(month(tpep_pickup_datetime) AS int) AS month FROM trips""",
    "bronze_rows_per_file": """SELECT 'events.parquet' AS file_name, count(*) AS row_count
FROM events""",
    "bronze_roundtrip": f"""WITH {_MONTHS}
SELECT *, CAST(year(tpep_pickup_datetime) AS int) AS year,
  CAST(month(tpep_pickup_datetime) AS int) AS month FROM trips""",
    "bronze_schema_merge": f"""WITH {_TRIPS}
SELECT * REPLACE (CASE WHEN payment_type = 1 THEN NULL ELSE airport_fee END AS airport_fee)
FROM trips""",
    "silver_input_rules": f"WITH {_TRIPS} SELECT trip_id FROM trips WHERE {_INPUT_OK}",
    "silver_features": f"WITH {_MONTHS}, {_FEATURED}\nSELECT trip_id, {_FEATURE_COLUMNS} FROM featured",
    "silver_trips": _from_silver("SELECT * FROM silver"),
    "silver_roundtrip": _from_silver("SELECT * FROM silver"),
    "quality_score_raw": f"""WITH {_TRIPS}, {_FEATURED}
SELECT trip_id, {_SCORE} AS quality_score FROM featured""",
    "dq_completeness": f"WITH {_TRIPS}\n" + " UNION ALL ".join(_completeness(_TRIP_COLUMNS, "trips")),
    "dq_validity": f"WITH {_TRIPS}, {_FEATURED}\n"
    + _rate("business_rule_validity", _VALID, "featured"),
    "dq_consistency": f"WITH {_TRIPS}, {_FEATURED}\n"
    + _rate("amount_consistency", _CONSISTENT, "featured"),
    "dq_uniqueness": f"WITH {_TRIPS}\n"
    + _uniqueness("VendorID, PULocationID, payment_type", "trips"),
    "dq_uniqueness_whole_rows": f"WITH {_TRIPS}\n" + _uniqueness("*", "trips"),
    "dq_uniqueness_copies": f"""WITH {_TRIPS}, copied AS (
  SELECT * EXCLUDE (trip_id) FROM trips
  UNION ALL SELECT * EXCLUDE (trip_id) FROM trips WHERE trip_id % 10 = 0)
""" + _uniqueness("*", "copied"),
    "bronze_stamps": "SELECT count(*) AS stamped, count(*) AS with_file FROM events",
    "payment_labels": f"""WITH {_TRIPS} SELECT trip_id, CASE WHEN trip_id % 7 = 0 THEN 'Type None'
  WHEN trip_id % 7 = 1 THEN 'Type 9' ELSE ['Credit Card', 'Cash', 'No Charge', 'Dispute', 'Unknown',
  'Voided'][payment_type] END AS label FROM trips""",
    "dq_report": f"WITH {_TRIPS}, {_FEATURED}\n"
    + _graded(
        _rates(
            "featured", _TRIP_COLUMNS + _FEATURE_NAMES, "VendorID, PULocationID, payment_type"
        )
    ),
    "dq_report_silver": _from_silver(
        _graded(_rates("silver", _TRIP_COLUMNS + _FEATURE_NAMES + ["quality_score"], "*"))
    ),
    "gold_hourly": _from_silver(_GOLD["hourly"]),
    "gold_location_hotspots": _from_silver(_GOLD["location"]),
    "gold_payment": _from_silver(_GOLD["payment"]),
    "gold_vendor": _from_silver(_GOLD["vendor"]),
    **{f"gold_rollup_{key}": _from_silver(select) for key, select in _GOLD.items()},
    **{
        f"gold_roundtrip_{key}": _from_silver(_with_layer(select)) for key, select in _GOLD.items()
    },
    "gold_ensure_columns": f"""WITH {_TRIPS},
filled AS (
  SELECT *, CASE WHEN tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
                 THEN {_SECONDS} / 60 ELSE 0.0 END AS trip_duration_minutes
  FROM trips)
SELECT trip_id, trip_duration_minutes,
  CASE WHEN trip_duration_minutes > 0 AND trip_distance > 0
       THEN trip_distance / (trip_duration_minutes / 60) ELSE 0.0 END AS speed_mph,
  CASE WHEN trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
       THEN CAST(1.0 AS double) ELSE CAST(0.5 AS double) END AS quality_score
FROM filled""",
    "gold_summary": _from_silver(_GOLD_COUNTS),
    "medallion_counts": _from_silver(
        "SELECT 'bronze' AS table_name, count(*) AS row_count FROM trips\n"
        "UNION ALL SELECT 'silver', count(*) FROM silver\nUNION ALL " + _GOLD_COUNTS
    ),
    "export_csv_roundtrip": _from_silver(_with_layer(_GOLD["hourly"])),
    "kpi_business": _from_silver(
        """SELECT
  (SELECT pickup_hour FROM hourly
   ORDER BY total_trips DESC, pickup_year, pickup_month, pickup_hour LIMIT 1) AS peak_hour,
  CAST(sum(total_trips) AS bigint) AS total_daily_trips,
  """
        + _mean("total_revenue")
        + """ AS avg_daily_revenue,
  (SELECT payment_type FROM payment
   ORDER BY payment_count DESC, payment_type, pickup_year, pickup_month LIMIT 1)
    AS most_popular_payment
FROM hourly""",
        _HOURLY,
        _PAYMENT,
    ),
    "dash_avg_trips_by_hour": _from_silver(
        "SELECT pickup_hour, avg(total_trips) AS avg_trips FROM hourly GROUP BY pickup_hour",
        _HOURLY,
    ),
    "dash_revenue_by_hour": _from_silver(
        f"SELECT pickup_hour, {_sum('total_revenue')} AS revenue FROM hourly GROUP BY pickup_hour",
        _HOURLY,
    ),
    "dash_top_locations": _from_silver(
        """SELECT PULocationID, pickup_hour, pickup_count FROM location
ORDER BY pickup_count DESC, PULocationID, pickup_hour LIMIT 20""",
        _LOCATION,
    ),
    "dash_payment_share": _from_silver(
        """SELECT payment_type, CAST(sum(payment_count) AS bigint) AS trips,
  CAST(sum(payment_count) AS double) / (SELECT sum(payment_count) FROM payment) * 100
    AS share_percent
FROM payment GROUP BY payment_type""",
        _PAYMENT,
    ),
    "profile_describe": f"WITH {_TRIPS}\n"
    + " UNION ALL ".join(_described(column, quartiles=False) for column in _PROFILED),
    "profile_summary": f"WITH {_TRIPS}\n"
    + " UNION ALL ".join(_described(column, quartiles=True) for column in _NUMERIC),
    "profile_quartiles_updated": f"WITH {_MONTHS}\n"
    + " UNION ALL ".join(
        f"SELECT column_name, q25, q50, q75 FROM ({_described(column, quartiles=True)})"
        for column in _PROFILED
    ),
    "profile_first_rows": f"WITH {_TRIPS} SELECT * FROM trips ORDER BY trip_id LIMIT 5",
    "stream_features": f"""WITH {_STREAM}
SELECT trip_id, trip_duration_minutes, speed_mph, 'streaming' AS source FROM streamed""",
    "stream_time_metrics": f"WITH {_STREAM}\n"
    "SELECT * REPLACE (round(avg_speed, 6) AS avg_speed) FROM time_metrics",
    "stream_location_metrics": f"WITH {_STREAM}\nSELECT * FROM location_metrics",
    "stream_payment_metrics": f"WITH {_STREAM}\nSELECT * FROM payment_metrics",
    "stream_latest_window": f"""WITH {_STREAM}, {_BY_END}
SELECT window_end, trips AS total_trips, revenue AS total_revenue,
  distance AS avg_trip_distance, duration AS avg_trip_duration, round(speed, 6) AS avg_speed
FROM ends WHERE window_end = (SELECT max(window_end) FROM ends)""",
    "stream_trend": f"""WITH {_STREAM}, {_BY_END},
compared AS (
  SELECT window_end, trips, lag(trips) OVER by_time AS previous_trips,
    revenue, lag(revenue) OVER by_time AS previous_revenue
  FROM ends WINDOW by_time AS (ORDER BY window_end))
SELECT *, CAST(trips - previous_trips AS double) / previous_trips * 100 AS trip_change_percent,
  (revenue - previous_revenue) / previous_revenue * 100 AS revenue_change_percent
FROM compared WHERE window_end = (SELECT max(window_end) FROM ends)""",
    "stream_top_locations": f"""WITH {_STREAM}
SELECT PULocationID, CAST(sum(pickup_count) AS bigint) AS total_pickups,
  {_sum("zone_revenue")} AS total_revenue
FROM location_metrics GROUP BY PULocationID
ORDER BY total_pickups DESC, PULocationID LIMIT 5""",
    "stream_payment_distribution": f"""WITH {_STREAM}
SELECT payment_type, CAST(sum(payment_count) AS bigint) AS total_count,
  {_sum("payment_revenue")} AS total_revenue, round(avg(avg_tip), 6) AS overall_avg_tip,
  CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
    WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided'
    ELSE 'Type ' || payment_type END AS payment_name
FROM payment_metrics GROUP BY payment_type""",
    "stream_summary": f"""WITH {_STREAM}
SELECT 'time_metrics' AS table_name, count(*) AS row_count FROM time_metrics
UNION ALL SELECT 'location_metrics', count(*) FROM location_metrics
UNION ALL SELECT 'payment_metrics', count(*) FROM payment_metrics""",
    "stream_run_report": """SELECT name AS query, count(*) AS input_rows,
  CAST(0 AS bigint) AS late_groups_dropped
FROM events, (VALUES ('time_metrics'), ('location_metrics'), ('payment_metrics')) AS q(name)
GROUP BY name""",
    "stream_late_data": f"""WITH {_STREAM},
span AS (
  SELECT min(epoch_us(tpep_pickup_datetime)) AS lo, max(epoch_us(tpep_pickup_datetime)) AS hi,
    greatest(6, CAST(ceil(count(*) / 2000000) AS bigint)) AS n FROM trips),
dealt AS (
  SELECT t.*, least((epoch_us(tpep_pickup_datetime) - lo) * n // (hi - lo + 1)
    + CASE WHEN trip_id % 7 = 0 THEN 3 ELSE 0 END, n - 1) AS batch
  FROM tumbling t, span),
tops AS (SELECT batch, max(tpep_pickup_datetime) AS top FROM dealt GROUP BY batch),
marks AS (
  SELECT b.batch, max(t.top) - INTERVAL 10 MINUTE AS dropped_until
  FROM (SELECT DISTINCT batch FROM dealt) b JOIN tops t ON t.batch <= b.batch - 2 GROUP BY b.batch)
SELECT trip_id, batch, PULocationID, total_amount, window_start,
  window_start + INTERVAL 15 MINUTE AS window_end
FROM dealt JOIN marks USING (batch) WHERE window_start + INTERVAL 15 MINUTE <= dropped_until""",
    "stream_restart": f"WITH {_STREAM}\nSELECT *, 1::bigint AS copies FROM location_metrics",
    "stream_cut_runs": f"WITH {_STREAM}\nSELECT * FROM payment_metrics",
    "stream_one_scan_time": f"WITH {_STREAM}\n"
    "SELECT * REPLACE (round(avg_speed, 6) AS avg_speed) FROM time_metrics",
    "stream_one_scan_location": f"WITH {_STREAM}\nSELECT * FROM location_metrics",
    "stream_one_scan_payment": f"WITH {_STREAM}\nSELECT * FROM payment_metrics",
    "stream_job": f"""WITH {_STREAM}
SELECT PULocationID, CAST(sum(pickup_count) AS bigint) AS total_pickups,
  round({_sum("zone_revenue")}, 6) AS total_revenue
FROM location_metrics GROUP BY PULocationID
ORDER BY total_pickups DESC, PULocationID LIMIT 5""",
    "raw_file_rows": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "declared_schema_rows": f"WITH {_TRIPS}\n"
    "SELECT * REPLACE (NULL::double AS airport_fee) FROM trips",
    "gold_input_report": _from_silver(
        """SELECT severity, message, silver_rows FROM (SELECT count(*) AS silver_rows FROM silver),
  (VALUES ('error', 'column VendorID is missing'),
    ('warning', 'column quality_score will be derived')) AS issues(severity, message)"""
    ),
    "bronze_refused_values": f"""WITH {_TRIPS}
SELECT 1 AS generation, 'passenger_count' AS column_name, 'double' AS found_type,
  CAST(passenger_count + 0.5::double AS varchar) AS value
FROM trips WHERE trip_id % 3 = 1 AND trip_id % 101 = 0 AND passenger_count IS NOT NULL
UNION ALL
SELECT 1, 'PULocationID', 'bigint', CAST(3000000000 + trip_id AS varchar)
FROM trips WHERE trip_id % 3 = 1 AND trip_id % 103 = 0
UNION ALL
SELECT 2, 'trip_distance', 'string', 'n/a' FROM trips WHERE trip_id % 3 = 2 AND trip_id % 107 = 0""",
    "bronze_accepted_rows": f"""WITH {_TRIPS}
SELECT * FROM trips
WHERE NOT (trip_id % 3 = 1 AND trip_id % 101 = 0 AND passenger_count IS NOT NULL)
  AND NOT (trip_id % 3 = 1 AND trip_id % 103 = 0) AND NOT (trip_id % 3 = 2 AND trip_id % 107 = 0)""",
    "dq_report_updated": _from_silver(
        _graded(_rates("silver", _TRIP_COLUMNS + _FEATURE_NAMES + ["quality_score"], "*"))
    ),
    "dq_report_updated_zones": _from_silver(
        _graded(
            _rates(
                "silver",
                _TRIP_COLUMNS + _FEATURE_NAMES + ["quality_score"],
                "VendorID, PULocationID, payment_type",
            )
        )
    ),
    **{f"gold_updated_{key}": _from_silver(select) for key, select in _GOLD.items()},
}
