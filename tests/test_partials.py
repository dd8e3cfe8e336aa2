import glob
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cabflow.operators import kpis, partials, profile
from cabflow.operators.enrich import add_ymd, analytics_base
from cabflow.plans import flow, job
from cabflow.sinks import writers
from cabflow.sources import feeds
from tests.conftest import SF001

MEASURES = [m for m in kpis.MEASURE_ORDER if not m.startswith("p")]


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    """Some hundred matched trips of five days."""
    m = flow.fixture_matched(spark, SF001)
    start = F.lit(datetime(2013, 3, 1))
    moved = F.timestamp_seconds(F.unix_timestamp(start) + F.pmod(F.unix_timestamp("pickup_datetime"), F.lit(5 * 86400)))
    path = str(tmp_path_factory.mktemp("trips") / "t")
    m.withColumn("pickup_datetime", moved).write.parquet(path)
    return spark.read.parquet(path)


def lay_out(trips, root):
    writers.write_processed(trips, f"{root}/{feeds.PROCESSED_TABLE}")


def on(df, *days):
    return df.filter(F.to_date("pickup_datetime").isin(list(days)))


def days_of(n):
    return [date(2013, 3, 1) + timedelta(i) for i in range(n)]


def assert_same_tables(spark, root, trips):
    """Merged tables equal those made from all rows, but for sketched quantiles (bounded by exact neighbours)."""
    base = analytics_base(add_ymd(trips))
    want = {r["column"]: r for r in profile.numeric_stats(base).collect()}
    got = {r["column"]: r for r in partials.numeric_stats(spark, root).collect()}
    assert list(got) == list(want) and partials.numeric_stats(spark, root).columns == profile.numeric_stats(base).columns
    for c, w in want.items():
        for name in ("count", "null_count", "min", "max"):
            assert got[c][name] == w[name], (c, name)
        for name in ("mean", "stddev", "sum"):
            assert got[c][name] == (None if w[name] is None else pytest.approx(w[name], rel=1e-9, abs=1e-12)), (c, name)
        values = sorted(r[0] for r in base.select(F.col(c).cast("double")).collect() if r[0] is not None)
        for name, p in zip(profile.QUANTILE_NAMES, profile.QUANTILE_PROBS, strict=True):
            lo, hi = (values[min(len(values) - 1, max(0, int((p + d) * len(values)) + e))] for d, e in ((-0.01, -1), (0.01, 1)))
            assert lo <= got[c][name] <= hi, (c, name)
    kpi, all_rows = partials.kpi_grouping_sets(spark, root), kpis.kpi_grouping_sets(base)
    assert kpi.columns == all_rows.columns and dict(kpi.dtypes) == dict(all_rows.dtypes)
    keys = [c for c in kpi.columns if c not in kpis.MEASURE_ORDER]
    rows = {tuple(r[k] for k in keys): r for r in kpi.collect()}
    for r in all_rows.collect():
        g = rows.pop(tuple(r[k] for k in keys))
        assert [g[m] for m in MEASURES] == [None if r[m] is None else pytest.approx(r[m], rel=1e-9) for m in MEASURES]
    assert not rows
    o = partials.overview(spark, root).first()
    w = profile.overview_document(base).first()
    assert (o.row_count, o.min_pickup_datetime, o.max_pickup_datetime) == (w.row_count, w.min_pickup_datetime, w.max_pickup_datetime)


def test_only_changed_days_are_read(spark, trips, tmp_out):
    root = f"{tmp_out}/partials"
    lay_out(trips, tmp_out)
    assert partials.refresh(spark, tmp_out, root) == days_of(5)
    assert_same_tables(spark, root, trips)
    assert partials.refresh(spark, tmp_out, root) == []
    # Replace the third day, and make every other day's files unreadable: a refresh must not touch them.
    third = days_of(5)[2]
    fewer = on(trips, third).filter("total_amount > 20")
    lay_out(fewer, tmp_out)
    for f in glob.glob(f"{tmp_out}/{feeds.PROCESSED_TABLE}/*/*/*/*.parquet"):
        if "/day=3/" not in f:
            with open(f, "wb") as out:
                out.write(b"PAR1 not a table PAR1")
            crc = f"{os.path.dirname(f)}/.{os.path.basename(f)}.crc"
            os.path.exists(crc) and os.remove(crc)
    spark.catalog.clearCache()
    # the schema comes from a readable footer
    schema = fewer.select("*", *[F.lit(0).alias(c) for c in writers.PARTITION_COLS]).schema
    real = feeds.load_processed
    try:
        feeds.load_processed = lambda s, p: s.read.schema(schema).parquet(f"{p}/{feeds.PROCESSED_TABLE}")
        assert partials.refresh(spark, tmp_out, root) == [third]
    finally:
        feeds.load_processed = real
    rest = trips.filter(F.to_date("pickup_datetime") != F.lit(third))
    assert_same_tables(spark, root, rest.unionByName(fewer))


def test_new_and_vanished_days(spark, trips, tmp_out):
    root, days = f"{tmp_out}/partials", days_of(5)
    lay_out(on(trips, *days[:3]), tmp_out)
    assert partials.refresh(spark, tmp_out, root) == days[:3]
    lay_out(on(trips, days[3]), tmp_out)
    assert partials.refresh(spark, tmp_out, root) == [days[3]]
    assert_same_tables(spark, root, on(trips, *days[:4]))
    table = f"{tmp_out}/{feeds.PROCESSED_TABLE}/year=2013/month=3"
    os.rename(f"{table}/day=4", f"{tmp_out}/gone")
    assert partials.refresh(spark, tmp_out, root) == []
    assert_same_tables(spark, root, on(trips, *days[:3]))
    assert len(os.listdir(f"{root}/numeric")) == len(os.listdir(f"{root}/kpi")) == 1  # the run of the fourth day has gone


def test_a_torn_refresh_changes_nothing(spark, trips, tmp_out, monkeypatch):
    root, days = f"{tmp_out}/partials", days_of(5)
    lay_out(on(trips, *days[:2]), tmp_out)
    partials.refresh(spark, tmp_out, root)
    lay_out(on(trips, days[2]), tmp_out)

    def dies(base):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(partials, "kpi_partials", dies)
        with pytest.raises(RuntimeError):
            partials.refresh(spark, tmp_out, root)
    os.makedirs(f"{root}/state/version=99")  # a state that was never completed
    assert_same_tables(spark, root, on(trips, *days[:2]))
    assert partials.refresh(spark, tmp_out, root) == [days[2]]
    assert_same_tables(spark, root, on(trips, *days[:3]))


def test_nothing_to_merge(spark, tmp_out):
    assert partials.numeric_stats(spark, f"{tmp_out}/none").collect() == []
    assert partials.kpi_grouping_sets(spark, f"{tmp_out}/none") is None
    assert partials.overview(spark, f"{tmp_out}/none").first().row_count == 0


def test_columns_without_values(spark, trips, tmp_out):
    nulls = trips.withColumns({"tip_amount": F.lit(None).cast("double"), "total_amount": F.lit(None).cast("double")})
    lay_out(nulls, tmp_out)
    partials.refresh(spark, tmp_out, f"{tmp_out}/partials")
    got = {r["column"]: r for r in partials.numeric_stats(spark, f"{tmp_out}/partials").collect()}
    tip = got["tip_amount"]
    assert (tip["count"], tip["null_count"], tip["mean"], tip["stddev"], tip["p50"]) == (0, trips.count(), None, None, None)
    assert partials.kpi_grouping_sets(spark, f"{tmp_out}/partials").filter("p50_total_amount IS NOT NULL").isEmpty()


def test_job_runs_incrementally(spark, trips, tmp_out):
    paths = job.Paths(tmp_out)
    lay_out(on(trips, *days_of(5)[:2]), paths.processed)
    outs = job.run_from_processed(spark, tmp_out, incremental=True).outputs
    by_hour = spark.read.option("header", True).option("inferSchema", True).csv(outs["kpi_by_hour"])
    n = on(trips, *days_of(5)[:2]).count()
    assert by_hour.agg(F.sum("trips")).first()[0] == n
    assert spark.read.json(outs["overview"]).first().row_count == n
    assert len(partials.current_state(spark, paths.partials)) == 2


def test_refresh_holds_the_sketches_of_a_tasks_days(spark, trips, tmp_out, monkeypatch):
    """While partials are written, a task may hold more groups than Spark's default of 128; the setting is restored."""
    key = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before, seen = spark.conf.get(key), []
    for name in ("numeric_partials", "kpi_partials"):
        real = getattr(partials, name)
        monkeypatch.setattr(partials, name, lambda base, real=real: seen.append(int(spark.conf.get(key))) or real(base))
    lay_out(trips, tmp_out)
    assert len(partials.refresh(spark, tmp_out, f"{tmp_out}/p")) == 5
    assert seen == [partials.GROUPS_IN_MEMORY] * 2 and partials.GROUPS_IN_MEMORY > 30 * len(profile.PROFILE_COLUMNS)
    assert spark.conf.get(key) == before
