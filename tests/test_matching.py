from datetime import datetime

from cabflow.operators import matching
from tests.helpers import fare, fares_df, trip, trips_df

P2 = datetime(2013, 1, 8, 9, 0)


def _sides(spark):
    trips = trips_df(spark, [
        trip(hack="A"),                      # matched
        trip(hack="B"),                      # trip only (no fare)
        trip(hack="C", dropoff=None),        # pair with NULL dropoff -> fare_only
        trip(hack="D"),                      # pair with NULL total -> trip_only
        trip(hack="E", dropoff=None),        # pair with both NULL -> incomplete
        trip(medallion=None, hack="F"),      # NULL key never matches
    ])
    fares = fares_df(spark, [
        fare(hack="A"), fare(hack="C"), fare(hack="D", total=None), fare(hack="E", total=None),
        fare(hack="G"),                      # fare only
        fare(medallion=None, hack="F"),      # NULL key never matches
    ])
    return trips, fares


def test_match_classes(spark):
    t, f = _sides(spark)
    out = matching.match(t, f)
    assert sorted(r["hack_license"] for r in out["matched"].collect()) == ["A"]
    assert sorted(r["hack_license"] for r in out["trip_only"].collect()) == ["B", "D", "F"]
    assert sorted(r["hack_license"] for r in out["fare_only"].collect()) == ["C", "F", "G"]
    assert sorted(r["hack_license"] for r in out["incomplete"].collect()) == ["E"]
    assert len(out["matched"].columns) == 21


def test_match_stats_sum_up(spark):
    t, f = _sides(spark)
    s = matching.match_stats(t, f).first().asDict()
    assert s["valid_trips_for_join"] == 6 and s["valid_fares_for_join"] == 6
    joined = matching.full_outer(t, f).count()
    assert s["matched_records"] + s["trips_without_fare"] + s["fares_without_trip"] + s["incomplete_records"] == joined


def test_outer_join_is_reduced_by_catalyst(spark):
    t, f = _sides(spark)
    out = matching.match(t, f)

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "Inner" in plan(out["matched"]) and "FullOuter" not in plan(out["matched"])
    assert "LeftOuter" in plan(out["trip_only"])
    assert "RightOuter" in plan(out["fare_only"])


def test_unmatched_union(spark):
    t, f = _sides(spark)
    out = matching.match(t, f)
    u = matching.unmatched_union(out["trip_only"], out["fare_only"])
    assert u.filter("source = 'trip_data'").count() == 3 and u.filter("source = 'fare_data'").count() == 3
    assert u.filter("source = 'trip_data'").filter("payment_type IS NOT NULL").count() == 0
    assert set(u.columns) >= {"source", "payment_type", "dropoff_datetime"}


def test_unmatched_single_pass_equals_union_and_stats(spark, tmp_path):
    t, f = _sides(spark)
    out = matching.match(t, f)
    union = matching.unmatched_union(out["trip_only"], out["fare_only"])
    single, obs = matching.unmatched_with_stats(t, f)
    assert single.columns == union.columns, (single.columns, union.columns)
    single.write.mode("overwrite").parquet(str(tmp_path / "u"))
    assert sorted(spark.read.parquet(str(tmp_path / "u")).collect(), key=repr) == sorted(union.collect(), key=repr)
    assert matching.stats_from_observation(spark, obs).first() == matching.match_stats(t, f).first()
