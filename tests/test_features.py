from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cabflow.functions import features as fx
from cabflow.operators import enrich
from cabflow.sources import dims


def one(spark, col, **values):
    cols = ", ".join(f"CAST({v!r} AS DOUBLE) AS {k}" if v is not None else f"CAST(NULL AS DOUBLE) AS {k}"
                     for k, v in values.items())
    return spark.sql(f"SELECT {cols}").select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("lon,lat,expected", [
    (-74.03, 40.70, "Manhattan"),       # corner, inclusive
    (-73.95, 40.72, "Manhattan"),       # overlap with Brooklyn and Queens: first box wins
    (-74.035, 40.60, "Brooklyn"),
    (-73.75, 40.60, "Queens"),
    (-73.80, 40.90, "Bronx"),
    (-74.20, 40.55, "Staten Island"),
    (-75.00, 40.00, "Unknown"),
    (None, 40.75, "Unknown"),
])
def test_region_boxes(spark, lon, lat, expected):
    assert one(spark, fx.region_of(F.col("lon"), F.col("lat")), lon=lon, lat=lat) == expected


@pytest.mark.parametrize("p,expected", [(None, "0"), (0.0, "0"), (0.5, "(0,1]"), (1.0, "(0,1]"), (4.0, "(1,4]"),
                                        (10.0, "(4,10]"), (10.01, ">10")])
def test_precip_bin(spark, p, expected):
    assert one(spark, fx.precip_bin(F.col("p")), p=p) == expected


@pytest.mark.parametrize("w,expected", [(None, "[0,3)"), (2.99, "[0,3)"), (3.0, "[3,7)"), (7.0, "[7,12)"), (12.0, ">=12")])
def test_wind_bin(spark, w, expected):
    assert one(spark, fx.wind_bin(F.col("w")), w=w) == expected


@pytest.mark.parametrize("p,t,expected", [(None, 5.0, "unknown"), (0.0, -5.0, "clear"), (0.3, 0.5, "snow"),
                                          (0.2, 0.0, "drizzle"), (3.0, 10.0, "rain"), (5.0, None, "heavy_rain")])
def test_weather_condition(spark, p, t, expected):
    assert one(spark, fx.weather_condition(F.col("p"), F.col("t")), p=p, t=t) == expected


def test_derived_metrics_guarded(spark):
    df = spark.createDataFrame([(0, 0.0, 10.0), (120, 3.0, 12.0)], "trip_time_in_secs int, trip_distance double, total_amount double")
    rows = enrich.add_derived_metrics(df).orderBy("trip_time_in_secs").collect()
    assert rows[0]["trip_duration_min"] is None and rows[0]["avg_speed_kmh"] is None and rows[0]["cost_per_km"] is None
    assert rows[1]["trip_duration_min"] == 2.0 and rows[1]["avg_speed_kmh"] == 90.0
    assert rows[1]["cost_per_km"] == 4.0 and rows[1]["cost_per_min"] == 6.0


def test_holidays_2013_rule(spark):
    got = {r["date"] for r in dims.us_federal_holidays(spark, 2013).collect()}
    assert got == {date(2013, m, d) for m, d in [(1, 1), (1, 21), (2, 18), (5, 27), (7, 4), (9, 2), (10, 14),
                                                 (11, 11), (11, 28), (12, 25)]}


def test_holiday_join_keeps_rows(spark):
    df = spark.createDataFrame([(datetime(2013, 7, 4, 12),), (datetime(2013, 7, 5, 12),)], "pickup_datetime timestamp")
    out = enrich.add_holidays(df).orderBy("pickup_datetime").collect()
    assert [r["is_holiday"] for r in out] == [1, 0]


def test_time_features_and_utc_hour(spark):
    df = spark.createDataFrame([(datetime(2013, 1, 6, 23, 30),), (datetime(2013, 7, 6, 1, 30),),
                                (datetime(2013, 3, 10, 2, 30),)], "pickup_datetime timestamp")
    out = enrich.add_time_flags(enrich.add_time_features(df)).withColumn("u", fx.pickup_hour_utc()).orderBy(
        "pickup_datetime").collect()
    assert out[0]["pickup_dow"] == 1 and out[0]["is_weekend"] == 1 and out[0]["day_part"] == "day"
    assert out[0]["u"] == datetime(2013, 1, 7, 4, 0)        # EST +5
    assert out[1]["u"] == datetime(2013, 3, 10, 7, 0)       # spring gap moves forward
    assert out[2]["u"] == datetime(2013, 7, 6, 5, 0)        # EDT +4
    assert out[2]["day_part"] == "night" and out[2]["is_evening_peak"] == 0


def test_weather_join_never_multiplies(spark):
    trips = spark.createDataFrame([(datetime(2013, 1, 7, 10, 15),)], "pickup_datetime timestamp")
    w = spark.createDataFrame([(datetime(2013, 1, 7, 15), 1.0, 0.0, 4.0, 2.0), (datetime(2013, 1, 7, 15), 3.0, 0.0, 4.0, 4.0)],
                              "timestamp_hour_utc timestamp, temperature_C double, dewpoint_C double, wind_speed_ms double, precip_mm_per_hr double")
    out = enrich.add_weather(trips, w).collect()
    assert len(out) == 1 and out[0]["precip_mm_per_hr"] == 3.0 and out[0]["weather_condition_5"] == "rain"
    assert len(enrich.add_weather(trips, w, dedupe_hours=False).collect()) == 2


def test_haversine(spark):
    from cabflow.operators.ml import with_haversine

    df = spark.createDataFrame([(40.0, -74.0, 41.0, -74.0)], "pickup_latitude double, pickup_longitude double, dropoff_latitude double, dropoff_longitude double")
    d = with_haversine(df).first()["haversine_distance"]
    assert abs(d - 111.19) < 0.01
