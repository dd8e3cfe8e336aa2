import gzip
import os

import pytest
from pyspark.sql import functions as F

from cabflow.plans import job
from cabflow.schemas import FARE_SCHEMA, TRIP_SCHEMA
from cabflow.sinks import writers
from cabflow.sources import feeds, headers, malformed
from tests.helpers import T0, fare, fares_df, trip, trips_df

GOOD = "M1,H1,CMT,1,N,2013-01-07 10:00:00,2013-01-07 10:10:00,1,600,2.0,-73.98,40.75,-73.97,40.76"
NAMES = TRIP_SCHEMA.names


def cells(**changes):
    row = dict(zip(NAMES, GOOD.split(","), strict=True)) | changes
    return [row[n] for n in NAMES]


def write(path, lines, header=",".join(NAMES)):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if path.endswith(".gz") else open
    with opener(path, "wt") as f:
        f.write("\n".join([header, *lines]) + "\n")


LINES = {
    "good": GOOD,
    "empty cells": ",".join(cells(passenger_count="", rate_code="", trip_distance="")),
    "two bad": ",".join(cells(passenger_count="two", trip_distance="1,5".replace(",", ";"))),
    "bad time": ",".join(cells(pickup_datetime="2013-02-30 10:00:00")),
    "quoted comma": ",".join(cells(trip_distance='"1,5"')),
    "quoted good": ",".join(cells(rate_code='"a, b"')),
    "short": GOOD.rsplit(",", 2)[0],
    "long": GOOD + ",x",
    "short and bad": ",".join(cells(passenger_count="two")[:-1]),
    "one cell": "M9",
}
WANT = {"two bad": "bad_passenger_count|bad_trip_distance", "bad time": "bad_pickup_datetime", "quoted comma": "bad_trip_distance",
        "short": "short_row", "long": "long_row", "short and bad": "short_row", "one cell": "short_row"}
COUNTS = {"malformed_rows": 7, "short_row": 3, "long_row": 1, "bad_passenger_count": 1, "bad_trip_distance": 2, "bad_pickup_datetime": 1}


def test_faults_of_every_kind(spark, tmp_out):
    write(f"{tmp_out}/t.csv", LINES.values())
    checked = feeds.load_trips(spark, f"{tmp_out}/t.csv", checked=True)
    counts = {r.metric: r.value for r in malformed.fault_counts(checked, TRIP_SCHEMA, "trips").collect()}
    assert counts == COUNTS
    line = {v: k for k, v in LINES.items()}
    kept = {line[r[malformed.MALFORMED]]: r.faults for r in malformed.quarantine(checked, TRIP_SCHEMA).collect()}
    assert kept == WANT
    plain = feeds.load_trips(spark, f"{tmp_out}/t.csv")
    assert sorted(map(str, checked.drop(malformed.MALFORMED).collect())) == sorted(map(str, plain.collect()))  # values unchanged
    seen_df, seen = malformed.observe_faults(checked, TRIP_SCHEMA, "trips")
    assert seen_df.columns == NAMES
    seen_df.write.format("noop").mode("overwrite").save()
    assert {r.metric: r.value for r in malformed.faults_from_observation(spark, seen, "trips").collect()} == COUNTS


def test_clean_and_empty_feeds_have_no_faults(spark, tmp_out):
    for name, lines in (("clean", [GOOD, GOOD]), ("empty", [])):
        write(f"{tmp_out}/{name}.csv", lines)
        checked = feeds.load_trips(spark, f"{tmp_out}/{name}.csv", checked=True)
        rows = [tuple(r) for r in malformed.fault_counts(checked, TRIP_SCHEMA, "trips").collect()]
        assert rows == [("trips", "malformed_rows", 0)]
        assert malformed.with_faults(checked, TRIP_SCHEMA).collect() == []


def turned(line):
    return ",".join(line.split(",")[::-1])


def test_columns_bind_by_name(spark, tmp_out):
    """Files in the schema's order, in another, with blanks and capitals in the names, and compressed."""
    other = ", ".join(n.upper() for n in NAMES[::-1])
    write(f"{tmp_out}/d/one.csv", [GOOD])
    write(f"{tmp_out}/d/two.csv", [turned(GOOD), turned(",".join(cells(passenger_count="two"))), turned(GOOD) + ",x"], header=other)
    write(f"{tmp_out}/d/sub/three.csv.gz", [turned(GOOD)], header="\ufeff" + other)
    write(f"{tmp_out}/d/_hidden.csv", ["nothing"], header="a,b")
    rows = feeds.load_trips(spark, f"{tmp_out}/d", by_name=True).collect()
    plain = feeds.load_trips(spark, f"{tmp_out}/d/one.csv").first()
    assert len(rows) == 5 and sum(r == plain for r in rows) >= 3
    checked = feeds.load_trips(spark, f"{tmp_out}/d/*.csv", by_name=True, checked=True)
    counts = {r.metric: r.value for r in malformed.fault_counts(checked, TRIP_SCHEMA, "t").collect()}
    assert counts == {"malformed_rows": 2, "bad_passenger_count": 1, "long_row": 1}
    assert feeds.load_trips(spark, f"{tmp_out}/d/two.csv").filter("medallion = 'M1'").isEmpty()  # by position: silently wrong
    found = {(r.name, r.place, r.files) for r in headers.header_rows(spark, TRIP_SCHEMA, f"{tmp_out}/d").collect()}
    assert ("medallion", 0, 1) in found and ("medallion", 13, 2) in found and len(found) == 28


def test_turned_feed_is_written_by_many_tasks(spark, tmp_path):
    """No task of the queries on turned columns takes half of the feed; its parts count as the two files that they are."""
    from cabflow.plans import registry

    spark.createDataFrame([(k, n, 5, 7, "A", "F", 10.0, 0.05, T0) for k in range(50) for n in (1, 2)],
                          "l_orderkey long, l_linenumber long, l_suppkey long, l_partkey long, l_returnflag string, l_linestatus string, "
                          "l_quantity double, l_discount double, l_shipdate timestamp_ntz").repartition(4).write.option(
                              "maxRecordsPerFile", 5).parquet(f"{tmp_path}/lineitem.parquet")
    files = headers.data_files(spark, registry._turned_csv(spark, str(tmp_path)))
    assert len(files) > 4
    want = sorted(map(repr, registry.src_trips(spark, str(tmp_path)).collect()))
    assert sorted(map(repr, registry.src_trips_by_name(spark, str(tmp_path)).collect())) == want
    assert {(r.place, r.files) for r in registry.schema_check(spark, str(tmp_path)).collect()} == {(i, 1) for i in range(14)}


@pytest.mark.parametrize("header,message", [
    (",".join([*NAMES[:-1], "other"]), "unknown columns .'other'., missing .'dropoff_latitude'."),
    (",".join(NAMES[:-1]), "missing"),
    (",".join([*NAMES, "medallion"]), "repeated .'medallion'."),
])
def test_wrong_headers_raise(spark, tmp_out, header, message):
    write(f"{tmp_out}/t.csv", [GOOD], header=header)
    with pytest.raises(ValueError, match=message):
        feeds.load_trips(spark, f"{tmp_out}/t.csv", by_name=True)


def test_no_file_raises(spark, tmp_out):
    with pytest.raises(FileNotFoundError):
        feeds.load_trips(spark, f"{tmp_out}/none*.csv", by_name=True)


def test_job_reports_and_keeps_malformed_rows(spark, tmp_out):
    writers.write_csv(fares_df(spark, [fare(), fare(medallion="M2")]), f"{tmp_out}/fares")
    write(f"{tmp_out}/trips/t.csv", [GOOD, ",".join(cells(medallion="M2", passenger_count="two")), GOOD.replace("M1", "M3") + ",x"])
    trips = feeds.load_trips(spark, f"{tmp_out}/trips", by_name=True, checked=True)
    fares = feeds.load_fares(spark, f"{tmp_out}/fares", by_name=True, checked=True)
    res = job.run_etl(spark, trips, fares, f"{tmp_out}/out", analytics=False)
    report = {(r.source, r.metric): (int(r.value), r.pct) for r in res.report.collect()}
    assert report["trips", "malformed_rows"][0] == 2 and float(report["trips", "malformed_rows"][1]) == pytest.approx(200 / 3)
    assert report["trips", "bad_passenger_count"][0] == report["trips", "long_row"][0] == 1
    assert report["fares", "malformed_rows"][0] == 0 and report["trips", "total_records"][0] == 3
    kept = spark.read.option("header", True).csv(f"{tmp_out}/out/quarantine/malformed_trips.csv")
    assert sorted((r.medallion, r.faults) for r in kept.collect()) == [("M2", "bad_passenger_count"), ("M3", "long_row")]
    assert not os.path.exists(f"{tmp_out}/out/quarantine/malformed_fares.csv")
    plain = job.run_etl(spark, trips_df(spark, [trip()]), fares_df(spark, [fare()]), f"{tmp_out}/plain", analytics=False)
    assert plain.report.filter(F.col("metric") == "malformed_rows").isEmpty()  # feeds that were not checked


def test_fare_columns_are_checked_too(spark, tmp_out):
    writers.write_csv(fares_df(spark, [fare()]), f"{tmp_out}/f")
    checked = feeds.load_fares(spark, f"{tmp_out}/f", by_name=True, checked=True)
    assert checked.columns == [*FARE_SCHEMA.names, malformed.MALFORMED]
    assert malformed.with_faults(checked, FARE_SCHEMA).collect() == []
