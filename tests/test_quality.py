from datetime import datetime

import pytest

from cabflow.operators import quality
from tests.helpers import T0, fare, fares_df, trip, trips_df


def reasons(df):
    return [r["rejection_reason"] for r in df.orderBy("hack_license").collect()]


@pytest.mark.parametrize(
    "kwargs,expected",
    [
        ({"pax": 0}, "invalid_passenger_count"),
        ({"pax": 1}, "VALID"),
        ({"pax": 6}, "VALID"),
        ({"pax": 7}, "excessive_passenger_count"),
        ({"secs": 59}, "trip_too_short"),
        ({"secs": 60}, "VALID"),
        ({"secs": 43200}, "VALID"),
        ({"secs": 43201}, "trip_too_long"),
        ({"dist": 0.0}, "zero_or_negative_distance"),
        ({"dist": 200.0}, "VALID"),
        ({"dist": 200.01}, "excessive_distance"),
        ({"dropoff": T0}, "invalid_trip_duration"),
        ({"pax": None, "secs": None, "dist": None, "dropoff": None}, "VALID"),  # NULL operands pass
        ({"pax": 0, "secs": 10, "dist": 0.0}, "invalid_passenger_count"),  # first match wins
    ],
)
def test_trip_rules(spark, kwargs, expected):
    df = quality.validated_trips(trips_df(spark, [trip(**kwargs)]))
    assert reasons(df) == [expected]


@pytest.mark.parametrize(
    "kwargs,expected",
    [
        ({"total": 2.49}, "amount_too_low"),
        ({"total": 2.5}, "VALID"),
        ({"total": 1000.0}, "VALID"),
        ({"total": 1000.01}, "amount_too_high"),
        ({"fare_amt": -0.01}, "negative_fare_amount"),
        ({"total": None}, "VALID"),
        ({"total": 1.0, "fare_amt": -1.0}, "amount_too_low"),
    ],
)
def test_fare_rules(spark, kwargs, expected):
    assert reasons(quality.validated_fares(fares_df(spark, [fare(**kwargs)]))) == [expected]


def test_defaults_filled_after_dedup(spark):
    df = quality.validated_trips(trips_df(spark, [trip(rate=None, flag=None)]))
    r = df.first()
    assert (r["rate_code"], r["store_and_fwd_flag"]) == ("UNK", "N")


def test_dedup_is_deterministic_and_null_first(spark):
    rows = [trip(pax=3), trip(pax=None), trip(pax=2), trip(hack=None), trip(hack=None, pax=5)]
    out = quality.dedup(trips_df(spark, rows), multiplicity="_rows").orderBy("hack_license").collect()
    assert len(out) == 2  # NULL keys group together
    by_hack = {r["hack_license"]: r for r in out}
    assert by_hack["H1"]["passenger_count"] is None  # NULL sorts first
    assert by_hack["H1"]["_rows"] == 3
    assert by_hack[None]["passenger_count"] == 1 and by_hack[None]["_rows"] == 2


def test_dedup_same_result_any_partitioning(spark):
    rows = [trip(hack=f"H{i % 7}", pax=(i * 5) % 6 + 1, secs=60 + i) for i in range(60)]
    df = trips_df(spark, rows)
    a = sorted(quality.dedup(df.repartition(1)).collect(), key=repr)
    b = sorted(quality.dedup(df.repartition(7)).collect(), key=repr)
    assert a == b and len(a) == 7


def test_split_and_stats_add_up(spark):
    rows = [trip(hack="H1"), trip(hack="H1"), trip(hack="H2", pax=0), trip(hack="H3", secs=10)]
    tagged = quality.validated_trips(trips_df(spark, rows), multiplicity=quality.MULTIPLICITY)
    good, bad = quality.split(tagged)
    assert good.count() + bad.count() == tagged.count() == 3
    assert "rejection_reason" not in good.columns and "_rows" not in bad.columns
    stats = {r["metric"]: r["value"] for r in quality.reject_stats(tagged, "trips").collect()}
    assert stats == {"total_records": 4, "rejected_records": 2, "invalid_passenger_count": 1, "trip_too_short": 1}


def test_stats_on_empty_input(spark):
    tagged = quality.validated_fares(fares_df(spark, []), multiplicity=quality.MULTIPLICITY)
    stats = {r["metric"]: r["value"] for r in quality.reject_stats(tagged, "fares").collect()}
    assert stats == {"total_records": 0, "rejected_records": 0}


def test_malformed_csv_cell_becomes_null(spark, tmp_out):
    from cabflow.sources.feeds import load_trips

    path = f"{tmp_out}/trips.csv"
    with open(path, "w") as f:
        f.write("medallion,hack_license,vendor_id,rate_code,store_and_fwd_flag,pickup_datetime,dropoff_datetime,"
                "passenger_count,trip_time_in_secs,trip_distance,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude\n")
        f.write("M1,H1,CMT,1,N,2013-01-01 15:11:48,2013-01-01 15:18:10,x,382,1.0,-73.97,40.75,-73.99,40.75\n")
    r = load_trips(spark, path).first()
    assert r["passenger_count"] is None and r["trip_time_in_secs"] == 382
    assert r["pickup_datetime"] == datetime(2013, 1, 1, 15, 11, 48)


def test_observed_stats_equal_aggregate_stats(spark, tmp_out):
    rows = [trip(hack="H1"), trip(hack="H1"), trip(hack="H2", pax=0), trip(hack="H3", secs=10), trip(hack="H4", pax=9)]
    tagged = quality.validated_trips(trips_df(spark, rows), multiplicity=quality.MULTIPLICITY)
    observed, obs = quality.observe_stats(tagged, "trips")
    observed.write.mode("overwrite").parquet(f"{tmp_out}/t")
    a = sorted(quality.stats_from_observation(spark, obs, "trips").collect())
    b = sorted(quality.reject_stats(tagged, "trips").collect())
    assert a == b


def test_hot_key_dedup_collapses_map_side(spark):
    from pyspark.sql import functions as F

    from cabflow.schemas import TRIP_SCHEMA

    n = 9000
    big = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("H"), F.col("id").cast("string"))).alias("hack_license"),
        (F.col("id") % 5).cast("int").alias("pax"),
    )
    df = big.select(
        F.lit("M1").alias("medallion"), "hack_license", F.lit("CMT").alias("vendor_id"), F.lit(None).cast("string").alias("rate_code"),
        F.lit(None).cast("string").alias("store_and_fwd_flag"), F.lit(T0).alias("pickup_datetime"),
        F.lit(datetime(2013, 1, 7, 10, 10)).alias("dropoff_datetime"), F.col("pax").alias("passenger_count"),
        F.lit(600).alias("trip_time_in_secs"), F.lit(2.0).alias("trip_distance"), F.lit(-73.98).alias("pickup_longitude"),
        F.lit(40.75).alias("pickup_latitude"), F.lit(-73.97).alias("dropoff_longitude"), F.lit(40.76).alias("dropoff_latitude"),
    )
    assert [f.name for f in df.schema.fields] == [f.name for f in TRIP_SCHEMA.fields]
    d = quality.dedup(df.repartition(6), multiplicity="_rows")
    assert "partial_min" in d._jdf.queryExecution().executedPlan().toString()
    hot = d.filter("hack_license = 'HOT'").collect()
    assert len(hot) == 1 and hot[0]["_rows"] == n // 3 and hot[0]["passenger_count"] == 0
    assert d.count() == 1 + (n - n // 3)
