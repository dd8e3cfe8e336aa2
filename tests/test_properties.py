"""Property tests: Spark rule / region / bin columns against plain-Python statements of the
same definitions, on random rows with NULLs (one Spark job per generated batch)."""

from datetime import timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from cabflow.functions import features as fx
from cabflow.operators import quality
from tests.helpers import T0, trip, trips_df


def py_trip_reason(pax, secs, dist, pickup, dropoff):
    def lt(a, b):
        return a is not None and b is not None and a < b

    checks = [
        (pax is not None and pax <= 0, "invalid_passenger_count"),
        (pax is not None and pax > 6, "excessive_passenger_count"),
        (lt(secs, 60), "trip_too_short"),
        (secs is not None and secs > 43200, "trip_too_long"),
        (dist is not None and dist <= 0, "zero_or_negative_distance"),
        (dist is not None and dist > 200, "excessive_distance"),
        (pickup is not None and dropoff is not None and pickup >= dropoff, "invalid_trip_duration"),
    ]
    return next((r for hit, r in checks if hit), "VALID")


def py_region(lon, lat):
    if lon is None or lat is None:
        return "Unknown"
    for name, x0, x1, y0, y1 in fx.BOROUGH_BOXES:
        if x0 <= lon <= x1 and y0 <= lat <= y1:
            return name
    return "Unknown"


opt_int = lambda lo, hi: st.one_of(st.none(), st.integers(lo, hi))
opt_float = lambda lo, hi: st.one_of(st.none(), st.floats(lo, hi, allow_nan=False))

row = st.tuples(opt_int(-2, 9), opt_int(-10, 50000), opt_float(-5, 300), st.one_of(st.none(), st.integers(-3600, 7200)),
                opt_float(-74.4, -73.6), opt_float(40.4, 41.0))


@settings(max_examples=8, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_trip_rules_and_regions_match_python(spark, rows):
    data = []
    for i, (pax, secs, dist, off, lon, lat) in enumerate(rows):
        dropoff = None if off is None else T0 + timedelta(seconds=off)
        data.append(trip(hack=f"H{i}", pax=pax, secs=secs, dist=dist, dropoff=dropoff, plon=lon, plat=lat))
    df = quality.validated_trips(trips_df(spark, data)).withColumn("region", fx.pickup_borough())
    got = {r["hack_license"]: (r["rejection_reason"], r["region"]) for r in df.collect()}
    for i, (pax, secs, dist, off, lon, lat) in enumerate(rows):
        dropoff = None if off is None else T0 + timedelta(seconds=off)
        assert got[f"H{i}"] == (py_trip_reason(pax, secs, dist, T0, dropoff), py_region(lon, lat))


def py_precip_bin(p):
    if p is None or p <= 0:
        return "0"
    return "(0,1]" if p <= 1 else "(1,4]" if p <= 4 else "(4,10]" if p <= 10 else ">10"


@settings(max_examples=6, deadline=None)
@given(st.lists(opt_float(-1, 20), min_size=1, max_size=40))
def test_precip_bin_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, precip_mm_per_hr double")
    got = {r["i"]: r["b"] for r in df.select("i", fx.precip_bin().alias("b")).collect()}
    assert all(got[i] == py_precip_bin(v) for i, v in enumerate(values))
