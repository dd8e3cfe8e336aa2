"""Fixed schemas of the two raw feeds and the dimensions, plus the match key."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Composite key shared by trips and fares (dedup and matching).
KEY = ["medallion", "hack_license", "vendor_id", "pickup_datetime"]

# The columns of the raw trip feed, in file order.
TRIP_SCHEMA = StructType(
    [
        StructField("medallion", StringType(), True),
        StructField("hack_license", StringType(), True),
        StructField("vendor_id", StringType(), True),
        StructField("rate_code", StringType(), True),
        StructField("store_and_fwd_flag", StringType(), True),
        StructField("pickup_datetime", TimestampType(), True),
        StructField("dropoff_datetime", TimestampType(), True),
        StructField("passenger_count", IntegerType(), True),
        StructField("trip_time_in_secs", IntegerType(), True),
        StructField("trip_distance", DoubleType(), True),
        StructField("pickup_longitude", DoubleType(), True),
        StructField("pickup_latitude", DoubleType(), True),
        StructField("dropoff_longitude", DoubleType(), True),
        StructField("dropoff_latitude", DoubleType(), True),
    ]
)

# The columns of the raw fare feed, in file order.
FARE_SCHEMA = StructType(
    [
        StructField("medallion", StringType(), True),
        StructField("hack_license", StringType(), True),
        StructField("vendor_id", StringType(), True),
        StructField("pickup_datetime", TimestampType(), True),
        StructField("payment_type", StringType(), True),
        StructField("fare_amount", DoubleType(), True),
        StructField("surcharge", DoubleType(), True),
        StructField("mta_tax", DoubleType(), True),
        StructField("tip_amount", DoubleType(), True),
        StructField("tolls_amount", DoubleType(), True),
        StructField("total_amount", DoubleType(), True),
    ]
)

TRIP_COLUMNS = [f.name for f in TRIP_SCHEMA.fields]
FARE_COLUMNS = [f.name for f in FARE_SCHEMA.fields]
TRIP_VALUE_COLUMNS = [c for c in TRIP_COLUMNS if c not in KEY]
FARE_VALUE_COLUMNS = [c for c in FARE_COLUMNS if c not in KEY]
# Column order of the matched table: key, then trip values, then fare values.
MATCHED_COLUMNS = KEY + TRIP_VALUE_COLUMNS + FARE_VALUE_COLUMNS

# Raw hourly weather CSV (DATE is UTC text) and its normalised form.
WEATHER_CSV_DDL = (
    "DATE string, temperature_C double, dewpoint_C double, "
    "wind_speed_ms double, precip_mm_per_hr double"
)
WEATHER_VALUE_COLUMNS = ["temperature_C", "dewpoint_C", "wind_speed_ms", "precip_mm_per_hr"]
