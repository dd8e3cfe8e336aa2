"""Independent DuckDB statements of every SQL-expressible query (the correctness oracle).

Written by hand against the same fixture tables, not generated from the Spark code.
``prefix()`` is one CTE chain (fixtures -> dedup -> tagging -> match -> features); each
oracle is ``WITH <chain> <final select>``. Double outputs are rounded exactly as the
Spark side's ``stable()`` does (6 decimals; 4 for large sums).
"""

from __future__ import annotations

from cabflow.sources.fixtures import duckdb_views

KEY = "medallion, hack_license, vendor_id, pickup_datetime"
TRIP_VALS = [
    "rate_code", "store_and_fwd_flag", "dropoff_datetime", "passenger_count", "trip_time_in_secs",
    "trip_distance", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
]
FARE_VALS = ["payment_type", "fare_amount", "surcharge", "mta_tax", "tip_amount", "tolls_amount", "total_amount"]
KEYS = ["medallion", "hack_license", "vendor_id", "pickup_datetime"]
TRIP_COLS = ["medallion", "hack_license", "vendor_id", "rate_code", "store_and_fwd_flag", "pickup_datetime",
             "dropoff_datetime", "passenger_count", "trip_time_in_secs", "trip_distance", "pickup_longitude",
             "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
FARE_COLS = ["medallion", "hack_license", "vendor_id", "pickup_datetime"] + FARE_VALS
MATCHED_COLS = KEYS + TRIP_VALS + FARE_VALS


def _dedup(src: str, vals: list[str]) -> str:
    order = ", ".join(f"{v} ASC NULLS FIRST" for v in vals)
    cols = ", ".join([c for c in (TRIP_COLS if src == "trips_raw" else FARE_COLS)])
    return (
        f"SELECT {cols}, _rows FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {order}) AS _rn, "
        f"count(*) OVER (PARTITION BY {KEY}) AS _rows FROM {src}) WHERE _rn = 1"
    )


# Fixed values (oracle side): trip rules in evaluation order.
TRIP_CASE = """CASE WHEN passenger_count <= 0 THEN 'invalid_passenger_count'
  WHEN passenger_count > 6 THEN 'excessive_passenger_count'
  WHEN trip_time_in_secs < 60 THEN 'trip_too_short'
  WHEN trip_time_in_secs > 43200 THEN 'trip_too_long'
  WHEN trip_distance <= 0 THEN 'zero_or_negative_distance'
  WHEN trip_distance > 200 THEN 'excessive_distance'
  WHEN pickup_datetime >= dropoff_datetime THEN 'invalid_trip_duration'
  ELSE 'VALID' END"""

# Fixed values (oracle side): fare rules in evaluation order.
FARE_CASE = """CASE WHEN total_amount < 2.5 THEN 'amount_too_low'
  WHEN total_amount > 1000 THEN 'amount_too_high'
  WHEN fare_amount < 0 THEN 'negative_fare_amount'
  ELSE 'VALID' END"""

# Fixed values (oracle side): region boxes, first match wins.
BOROUGH_CASE = """CASE
  WHEN pickup_longitude BETWEEN -74.03 AND -73.93 AND pickup_latitude BETWEEN 40.70 AND 40.88 THEN 'Manhattan'
  WHEN pickup_longitude BETWEEN -74.04 AND -73.85 AND pickup_latitude BETWEEN 40.57 AND 40.73 THEN 'Brooklyn'
  WHEN pickup_longitude BETWEEN -73.96 AND -73.70 AND pickup_latitude BETWEEN 40.54 AND 40.80 THEN 'Queens'
  WHEN pickup_longitude BETWEEN -73.93 AND -73.77 AND pickup_latitude BETWEEN 40.79 AND 40.91 THEN 'Bronx'
  WHEN pickup_longitude BETWEEN -74.26 AND -74.05 AND pickup_latitude BETWEEN 40.49 AND 40.65 THEN 'Staten Island'
  ELSE 'Unknown' END"""

# Fixed values (oracle side): US federal holidays; DuckDB dayofweek is 0 = Sunday.
HOLIDAY_NAME_CASE = """CASE
  WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day'
  WHEN month(d) = 1 AND dayofweek(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Martin Luther King Jr. Day'
  WHEN month(d) = 2 AND dayofweek(d) = 1 AND day(d) BETWEEN 15 AND 21 THEN 'Presidents'' Day'
  WHEN month(d) = 5 AND dayofweek(d) = 1 AND day(d) >= 25 THEN 'Memorial Day'
  WHEN month(d) = 7 AND day(d) = 4 THEN 'Independence Day'
  WHEN month(d) = 9 AND dayofweek(d) = 1 AND day(d) <= 7 THEN 'Labor Day'
  WHEN month(d) = 10 AND dayofweek(d) = 1 AND day(d) BETWEEN 8 AND 14 THEN 'Columbus Day'
  WHEN month(d) = 11 AND day(d) = 11 THEN 'Veterans Day'
  WHEN month(d) = 11 AND dayofweek(d) = 4 AND day(d) BETWEEN 22 AND 28 THEN 'Thanksgiving Day'
  WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day' END"""


def _joined() -> str:
    on = " AND ".join(f"t.{k} = f.{k}" for k in KEYS)
    sel = [f"coalesce(t.{k}, f.{k}) AS {k}" for k in KEYS]
    sel += [f"t.{k} AS t_{k}" for k in KEYS] + [f"f.{k} AS f_{k}" for k in KEYS]
    sel += [f"t.{c} AS {c}" for c in TRIP_VALS] + [f"f.{c} AS {c}" for c in FARE_VALS]
    return f"SELECT {', '.join(sel)} FROM trips_good t FULL OUTER JOIN fares_good f ON {on}"


def prefix() -> str:
    trip_tag_cols = ", ".join(
        "coalesce(rate_code, 'UNK') AS rate_code" if c == "rate_code"
        else "coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag" if c == "store_and_fwd_flag"
        else c
        for c in TRIP_COLS
    )
    fare_cols = ", ".join(FARE_COLS)
    trip_cols = ", ".join(TRIP_COLS)
    m = ", ".join(MATCHED_COLS)
    return f"""{duckdb_views()},
trips_dedup AS ({_dedup('trips_raw', TRIP_VALS)}),
fares_dedup AS ({_dedup('fares_raw', FARE_VALS)}),
trips_tagged AS (SELECT {trip_tag_cols}, _rows, {TRIP_CASE.replace(chr(10), ' ')} AS rejection_reason FROM trips_dedup),
fares_tagged AS (SELECT {fare_cols}, _rows, {FARE_CASE.replace(chr(10), ' ')} AS rejection_reason FROM fares_dedup),
trips_good AS (SELECT {trip_cols} FROM trips_tagged WHERE rejection_reason = 'VALID'),
fares_good AS (SELECT {fare_cols} FROM fares_tagged WHERE rejection_reason = 'VALID'),
joined AS ({_joined()}),
matched AS (SELECT {m} FROM joined WHERE dropoff_datetime IS NOT NULL AND total_amount IS NOT NULL),
trips_only AS (SELECT {', '.join(f't_{k} AS {k}' for k in KEYS)}, {', '.join(TRIP_VALS)} FROM joined
  WHERE dropoff_datetime IS NOT NULL AND total_amount IS NULL),
fares_only AS (SELECT {', '.join(f'f_{k} AS {k}' for k in KEYS)}, {', '.join(FARE_VALS)} FROM joined
  WHERE dropoff_datetime IS NULL AND total_amount IS NOT NULL),
days AS (SELECT CAST(g.d AS DATE) AS d FROM generate_series(TIMESTAMP '1970-01-01', TIMESTAMP '2100-12-31', INTERVAL 1 DAY) g(d)),
hol AS (SELECT d AS date, 1 AS is_holiday, {HOLIDAY_NAME_CASE.replace(chr(10), ' ')} AS holiday_name FROM days),
holidays AS (SELECT * FROM hol WHERE holiday_name IS NOT NULL),
abase AS (
  SELECT m.*, CAST(year(pickup_datetime) AS INT) AS year, CAST(month(pickup_datetime) AS INT) AS month,
         CAST(day(pickup_datetime) AS INT) AS day,
         CASE WHEN trip_time_in_secs > 0 THEN trip_time_in_secs / CAST(60 AS DOUBLE) END AS trip_duration_min,
         CASE WHEN trip_time_in_secs > 0 AND trip_time_in_secs / CAST(60 AS DOUBLE) > 0
              THEN trip_distance / ((trip_time_in_secs / CAST(60 AS DOUBLE)) / CAST(60 AS DOUBLE)) END AS avg_speed_kmh,
         CASE WHEN trip_distance > 0 THEN total_amount / trip_distance END AS cost_per_km,
         CASE WHEN trip_time_in_secs > 0 AND trip_time_in_secs / CAST(60 AS DOUBLE) > 0
              THEN total_amount / (trip_time_in_secs / CAST(60 AS DOUBLE)) END AS cost_per_min,
         CAST(hour(pickup_datetime) AS INT) AS pickup_hour,
         CAST(dayofweek(pickup_datetime) + 1 AS INT) AS pickup_dow
  FROM matched m),
qbase0 AS (
  SELECT a.*,
         CASE WHEN pickup_dow IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN pickup_hour BETWEEN 0 AND 5 THEN 'night' ELSE 'day' END AS day_part,
         CASE WHEN pickup_hour BETWEEN 16 AND 19 THEN 1 ELSE 0 END AS is_evening_peak,
         CAST(pickup_datetime AS DATE) AS pickup_date
  FROM abase a),
qbase1 AS (
  SELECT q.*, coalesce(h.is_holiday, 0) AS is_holiday, {BOROUGH_CASE.replace(chr(10), ' ')} AS pickup_borough,
         date_trunc('hour', timezone('UTC', timezone('America/New_York', q.pickup_datetime))) AS pickup_hour_utc
  FROM qbase0 q LEFT JOIN holidays h ON q.pickup_date = h.date),
weather AS (SELECT timestamp_hour_utc, temperature_C, dewpoint_C, wind_speed_ms, precip_mm_per_hr FROM weather_raw),
qbase AS (
  SELECT q.*, w.temperature_C, w.dewpoint_C, w.wind_speed_ms, w.precip_mm_per_hr,
    CASE WHEN w.precip_mm_per_hr IS NULL OR w.precip_mm_per_hr <= 0 THEN '0'
         WHEN w.precip_mm_per_hr <= 1 THEN '(0,1]' WHEN w.precip_mm_per_hr <= 4 THEN '(1,4]'
         WHEN w.precip_mm_per_hr <= 10 THEN '(4,10]' ELSE '>10' END AS precip_bin,
    CASE WHEN w.wind_speed_ms IS NULL OR w.wind_speed_ms < 3 THEN '[0,3)'
         WHEN w.wind_speed_ms < 7 THEN '[3,7)' WHEN w.wind_speed_ms < 12 THEN '[7,12)' ELSE '>=12' END AS wind_bin,
    CASE WHEN w.precip_mm_per_hr IS NULL THEN 'unknown' WHEN w.precip_mm_per_hr <= 0 THEN 'clear'
         WHEN w.temperature_C <= 0.5 AND w.precip_mm_per_hr > 0.2 THEN 'snow'
         WHEN w.precip_mm_per_hr <= 1 THEN 'drizzle' WHEN w.precip_mm_per_hr <= 4 THEN 'rain'
         ELSE 'heavy_rain' END AS weather_condition_5
  FROM qbase1 q LEFT JOIN weather w ON q.pickup_hour_utc = w.timestamp_hour_utc)"""


def r(expr: str, name: str, digits: int = 6) -> str:
    """Same rounding as the Spark side's ``stable``: integer-round ``x * 10^d``."""
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"round(({expr}) * {scale}) / {scale} AS {name}"


def q(body: str) -> str:
    return f"WITH {prefix()}\n{body}"
