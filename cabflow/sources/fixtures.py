"""Test inputs: the driver's star-schema tables mapped onto the trip, fare and weather feeds.

The mapping is plain SQL that runs unchanged in Spark SQL and DuckDB, so the Spark
queries and their DuckDB oracles start from identical rows. ``{lineitem}`` and
``{orders}`` are placeholders: Spark binds DataFrames to them, the oracle binds the
pre-registered views.

Every modulus below plants one case the pipeline must handle (see FIXTURES.md):
trips - 97 too long, 89 zero duration, 53 too many passengers, 61 zero distance,
67 excessive distance, quantity 1 too short, line 1 no passengers, 211 NULL dropoff,
199 NULL passengers, 23 exact duplicate, 29 near duplicate; fares - 59 negative fare,
71 too high, 73 NULL total, k % 10 = 3 trip without fare, 'X' prefix fare without
trip, 23 exact duplicate. On the fall-back dates hour 1 moves to 0 because the two
engines resolve the ambiguous New York hour differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The pickup-time expression shared by both feeds.
_PICKUP_EXPR = """l_shipdate
           + INTERVAL '1' HOUR * (CASE WHEN (l_orderkey * 7 + l_linenumber * 5 + l_partkey) % 24 = 1
               AND CAST(l_shipdate AS DATE) IN (DATE '1995-10-29', DATE '1996-10-27', DATE '1997-10-26',
                   DATE '1998-10-25', DATE '1999-10-31', DATE '2000-10-29', DATE '2001-10-28')
               THEN 0 ELSE CAST((l_orderkey * 7 + l_linenumber * 5 + l_partkey) % 24 AS INT) END)
           + INTERVAL '1' MINUTE * CAST(l_partkey % 60 AS INT)"""

TRIPS_RAW_SQL = f"""
WITH b AS (
  SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, l_partkey AS p,
         l_returnflag, l_linestatus, l_quantity, l_discount,
         CASE WHEN l_partkey % 97 = 0 THEN 50000 ELSE CAST(l_quantity * 60 AS INT) - 30 END AS secs,
         {_PICKUP_EXPR} AS pu
  FROM {{lineitem}}),
t AS (
  SELECT k, 'M' || CAST(s AS STRING) AS medallion, 'H' || CAST(k AS STRING) AS hack_license,
         CASE WHEN s % 2 = 0 THEN 'CMT' ELSE 'VTS' END AS vendor_id,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS rate_code,
         CASE WHEN l_linestatus = 'O' THEN NULL ELSE 'Y' END AS store_and_fwd_flag,
         pu AS pickup_datetime,
         CASE WHEN k % 211 = 0 THEN NULL WHEN p % 89 = 0 THEN pu ELSE pu + INTERVAL '1' SECOND * secs END AS dropoff_datetime,
         CASE WHEN k % 199 = 0 THEN NULL WHEN p % 53 = 0 THEN 7 ELSE n - 1 END AS passenger_count,
         secs AS trip_time_in_secs,
         CASE WHEN p % 61 = 0 THEN CAST(0 AS DOUBLE) WHEN p % 67 = 0 THEN CAST(250 AS DOUBLE)
              ELSE l_quantity * (CAST(0.1 AS DOUBLE) + l_discount * 6) END AS trip_distance,
         CAST(-74.30 AS DOUBLE) + (p % 70) * CAST(0.01 AS DOUBLE) AS pickup_longitude,
         CAST(40.48 AS DOUBLE) + (k % 50) * CAST(0.01 AS DOUBLE) AS pickup_latitude,
         CAST(-74.05 AS DOUBLE) + (s % 30) * CAST(0.01 AS DOUBLE) AS dropoff_longitude,
         CAST(40.60 AS DOUBLE) + n * CAST(0.03 AS DOUBLE) AS dropoff_latitude
  FROM b),
u AS (
  SELECT t.*, 0 AS extra FROM t
  UNION ALL SELECT t.*, 0 FROM t WHERE k % 23 = 0
  UNION ALL SELECT t.*, 1 FROM t WHERE k % 29 = 0)
SELECT medallion, hack_license, vendor_id, rate_code, store_and_fwd_flag, pickup_datetime, dropoff_datetime,
       passenger_count + extra AS passenger_count, trip_time_in_secs, trip_distance,
       pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude
FROM u
"""

FARES_RAW_SQL = f"""
WITH b AS (
  SELECT l_orderkey AS k, l_suppkey AS s, l_partkey AS p, l_extendedprice / 1000 AS x, l_discount, l_tax,
         {_PICKUP_EXPR} AS pu
  FROM {{lineitem}}),
f AS (
  SELECT k, 'M' || CAST(s AS STRING) AS medallion, 'H' || CAST(k AS STRING) AS hack_license,
         CASE WHEN s % 2 = 0 THEN 'CMT' ELSE 'VTS' END AS vendor_id, pu AS pickup_datetime,
         CASE k % 5 WHEN 0 THEN 'CRD' WHEN 1 THEN 'CSH' WHEN 2 THEN 'NOC' WHEN 3 THEN 'DIS' ELSE 'UNK' END AS payment_type,
         CASE WHEN p % 59 = 0 THEN CAST(-1 AS DOUBLE) ELSE x END AS fare_amount,
         CAST(0.5 AS DOUBLE) AS surcharge, CAST(0.5 AS DOUBLE) AS mta_tax,
         x * l_discount AS tip_amount, x * l_tax AS tolls_amount,
         CASE WHEN p % 71 = 0 THEN CAST(1500 AS DOUBLE) WHEN p % 73 = 0 THEN NULL
              ELSE x * (1 + l_discount + l_tax) + CAST(1 AS DOUBLE) END AS total_amount
  FROM b),
u AS (
  SELECT medallion AS m2, f.* FROM f WHERE k % 10 <> 3
  UNION ALL SELECT medallion, f.* FROM f WHERE k % 23 = 0 AND k % 10 <> 3
  UNION ALL SELECT 'X' || medallion, f.* FROM f WHERE k % 17 = 5)
SELECT m2 AS medallion, hack_license, vendor_id, pickup_datetime, payment_type, fare_amount, surcharge,
       mta_tax, tip_amount, tolls_amount, total_amount
FROM u
"""

WEATHER_RAW_SQL = """
SELECT date_trunc('hour', o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT)) AS timestamp_hour_utc,
       min(CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE (o_custkey % 40) - CAST(10 AS DOUBLE) END) AS temperature_C,
       min((o_custkey % 25) - CAST(12 AS DOUBLE)) AS dewpoint_C,
       min((o_custkey % 15) * CAST(1 AS DOUBLE)) AS wind_speed_ms,
       min(CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN CAST(0 AS DOUBLE)
                ELSE (o_custkey % 140) * CAST(0.1 AS DOUBLE) END) AS precip_mm_per_hr
FROM {orders} GROUP BY 1
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_to_timestamp(df: DataFrame) -> DataFrame:
    """Test data stores zone-less timestamps; the feeds are session-zone timestamps."""
    return df.select(
        [
            F.col(f.name).cast("timestamp").alias(f.name)
            if f.dataType.typeName() == "timestamp_ntz"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ts_to_timestamp(spark.sql(TRIPS_RAW_SQL, lineitem=table(spark, sf_dir, "lineitem")))


def fares_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ts_to_timestamp(spark.sql(FARES_RAW_SQL, lineitem=table(spark, sf_dir, "lineitem")))


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ts_to_timestamp(spark.sql(WEATHER_RAW_SQL, orders=table(spark, sf_dir, "orders")))


def weather_csv_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather fixture shaped like the raw hourly CSV (``DATE`` as UTC text)."""
    w = weather_raw(spark, sf_dir)
    return w.select(
        F.date_format("timestamp_hour_utc", "yyyy-MM-dd HH:mm:ss").alias("DATE"),
        "temperature_C",
        "dewpoint_C",
        "wind_speed_ms",
        "precip_mm_per_hr",
    )


def duckdb_views() -> str:
    """The three fixture tables as DuckDB CTE bodies (used by the oracle SQL)."""
    return (
        "trips_raw AS (" + TRIPS_RAW_SQL.format(lineitem="lineitem") + "),\n"
        "fares_raw AS (" + FARES_RAW_SQL.format(lineitem="lineitem") + "),\n"
        "weather_raw AS (" + WEATHER_RAW_SQL.format(orders="orders") + ")"
    )
