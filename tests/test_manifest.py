import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cabflow.plans import job
from cabflow.sinks import manifest, writers
from cabflow.sources import feeds
from tests.helpers import fare, fares_df, trip, trips_df

DAYS = [date(2013, 5, 1) + timedelta(i) for i in range(4)]


def feeds_of(spark, tips=(1.0, 1.0, 1.0, 1.0), n=5):
    """Trips and fares of four days; ``tips``: the tip of every fare of a day."""
    trips, fares = [], []
    for d, tip in zip(DAYS, tips, strict=True):
        for i in range(n):
            at = datetime(d.year, d.month, d.day, 8, i)
            trips.append(trip(medallion=f"M{i}", pickup=at, dropoff=at + timedelta(minutes=9)))
            fares.append(fare(medallion=f"M{i}", pickup=at, tip=tip))
    return trips_df(spark, trips), fares_df(spark, fares)


def run(spark, root, tips=(1.0, 1.0, 1.0, 1.0)):
    job.run_etl(spark, *feeds_of(spark, tips), root, analytics=False, track_changes=True)
    return job.Paths(root).processed, f"{job.Paths(root).processed}/{feeds.PROCESSED_TABLE}"


def tips_by_day(df):
    return {r.d: (r.n, r.t) for r in df.groupBy(F.to_date("pickup_datetime").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("tip_amount").alias("t")).collect()}


def test_unchanged_days_are_skipped(spark, tmp_out, monkeypatch):
    processed, table = run(spark, tmp_out)
    first = manifest.current(spark, table)
    assert sorted(first) == DAYS and all(d.trips == 5 and d.files for d in first.values())
    assert tips_by_day(feeds.load_processed(spark, processed)) == dict.fromkeys(DAYS, (5, 5.0))
    written = []
    real = writers.write_processed
    monkeypatch.setattr(writers, "write_processed", lambda df, *a, **k: written.append(df.count()) or real(df, *a, **k))
    run(spark, tmp_out)
    assert written == [] and manifest.current(spark, table) == first
    run(spark, tmp_out, (1.0, 2.0, 1.0, 1.0))
    assert written == [5]
    second = manifest.current(spark, table)
    assert {d for d in DAYS if second[d] != first[d]} == {DAYS[1]}
    assert tips_by_day(feeds.load_processed(spark, processed))[DAYS[1]] == (5, 10.0)
    # the files of the old day have gone: a plain read sees the same rows
    assert tips_by_day(spark.read.parquet(table)) == tips_by_day(feeds.load_processed(spark, processed))
    assert [(r.day, r.trips, r.files) for r in manifest.summary(spark, table).collect()] == [
        (d, 5, len(second[d].files)) for d in DAYS]


@pytest.mark.parametrize("where", ["after files", "before marker"])
def test_a_run_that_dies_leaves_the_old_day(spark, tmp_out, monkeypatch, where):
    processed, table = run(spark, tmp_out)
    old = tips_by_day(feeds.load_processed(spark, processed))

    def dies(spark, table, days):
        if where == "before marker":  # the version's file is there, its success marker is not
            path = f"{manifest.manifest_root(table)}/version=2"
            rows = [(d, x.digest, x.trips, list(x.files)) for d, x in days.items()]
            spark.createDataFrame(rows, manifest.DDL).write.parquet(path)
            os.remove(f"{path}/_SUCCESS")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(manifest, "_commit", dies)
        with pytest.raises(RuntimeError):
            run(spark, tmp_out, (1.0, 2.0, 1.0, 1.0))
    torn = tips_by_day(spark.read.parquet(table))
    assert torn[DAYS[1]] == (10, 15.0)  # both copies are there
    assert tips_by_day(feeds.load_processed(spark, processed)) == old  # readers see the old day
    run(spark, tmp_out, (1.0, 2.0, 1.0, 1.0))
    new = old | {DAYS[1]: (5, 10.0)}
    assert tips_by_day(feeds.load_processed(spark, processed)) == tips_by_day(spark.read.parquet(table)) == new


def test_a_layout_from_before_the_manifest(spark, tmp_out):
    trips, fares = feeds_of(spark)
    job.run_etl(spark, trips, fares, tmp_out, analytics=False)
    processed, table = run(spark, tmp_out, (3.0, 1.0, 1.0, 1.0))  # every day is taken over
    want = dict.fromkeys(DAYS, (5, 5.0)) | {DAYS[0]: (5, 15.0)}
    assert tips_by_day(feeds.load_processed(spark, processed)) == tips_by_day(spark.read.parquet(table)) == want


def test_days_absent_from_a_run_stay(spark, tmp_out):
    processed, table = run(spark, tmp_out)
    trips, fares = (df.filter(F.to_date("pickup_datetime") == F.lit(DAYS[2])) for df in feeds_of(spark, (1.0, 1.0, 4.0, 1.0)))
    job.run_etl(spark, trips, fares, tmp_out, analytics=False, track_changes=True)
    assert tips_by_day(feeds.load_processed(spark, processed)) == dict.fromkeys(DAYS, (5, 5.0)) | {DAYS[2]: (5, 20.0)}


def test_days_without_a_match_have_no_files(spark, tmp_out):
    trips, fares = feeds_of(spark)
    fares = fares.withColumn("medallion", F.when(F.to_date("pickup_datetime") == F.lit(DAYS[3]), "Z").otherwise(F.col("medallion")))
    job.run_etl(spark, trips, fares, tmp_out, analytics=False, track_changes=True)
    table = f"{job.Paths(tmp_out).processed}/{feeds.PROCESSED_TABLE}"
    known = manifest.current(spark, table)
    assert known[DAYS[3]].files == () and known[DAYS[3]].trips == 0 and known[DAYS[0]].trips == 5


def test_digests_tell_changes_from_order(spark):
    trips, fares = feeds_of(spark)
    same = manifest.input_digests(trips.orderBy(F.rand(1)), fares.repartition(3))
    base = manifest.input_digests(trips, fares)
    assert base == same and sorted(base) == DAYS
    nulls = fares.withColumn("tip_amount", F.when(F.col("medallion") == "M1", None).otherwise(F.col("tip_amount")))
    twice = trips.unionByName(trips.filter(F.to_date("pickup_datetime") == F.lit(DAYS[0])))
    assert all(manifest.input_digests(trips, nulls)[d] != base[d] for d in DAYS)
    assert {d for d, x in manifest.input_digests(twice, fares).items() if x != base[d]} == {DAYS[0]}
    assert manifest.input_digests(trips.limit(0), fares.limit(0)) == {}
