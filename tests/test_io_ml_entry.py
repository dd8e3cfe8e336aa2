import os
import sys

from pyspark.sql import functions as F

from cabflow.operators import ml
from cabflow.plans import flow
from cabflow.sinks import writers
from cabflow.sources import feeds
from tests.conftest import SF001


def test_processed_roundtrip_and_dynamic_overwrite(spark, tmp_out):
    m = flow.fixture_matched(spark, SF001)
    path = f"{tmp_out}/processed/{feeds.PROCESSED_TABLE}"
    writers.write_processed(m, path)
    back = feeds.load_processed(spark, f"{tmp_out}/processed")
    assert back.columns[-3:] == ["year", "month", "day"] and back.count() == m.count()
    before = back.filter("year = 1996").count()
    # overwrite only 1995 rows: other years must stay
    writers.write_processed(m.filter(F.year("pickup_datetime") == 1995).limit(10), path)
    back = feeds.load_processed(spark, f"{tmp_out}/processed")
    assert back.filter("year = 1996").count() == before
    pruned = feeds.between_days(back, "1996-03-01", "1996-03-31")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert pruned.count() == m.filter("pickup_datetime >= '1996-03-01' AND pickup_datetime < '1996-04-01'").count()


def test_weather_prepare_and_refresh(spark, tmp_out):
    from cabflow.sources import fixtures

    csv = f"{tmp_out}/w.csv"
    writers.write_csv(fixtures.weather_csv_frame(spark, SF001), csv)
    w = feeds.load_or_prepare_weather(spark, f"{tmp_out}/p", csv)
    assert w.count() == fixtures.weather_raw(spark, SF001).count()
    assert feeds.load_or_prepare_weather(spark, f"{tmp_out}/p", None).count() == w.count()  # prepared copy wins
    assert feeds.load_or_prepare_weather(spark, f"{tmp_out}/none", None) is None


def test_metric_sql_equals_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    data = ml.prepare_features(flow.fixture_matched(spark, SF001))
    pred = data.withColumn("prediction", F.expr("2.5 + 2.0 * haversine_distance"))
    got = ml.regression_metrics(pred).first()
    for m in ("rmse", "mae", "r2"):
        ref = RegressionEvaluator(labelCol="total_amount", metricName=m).evaluate(pred)
        assert abs(got[m.upper()] - ref) < 1e-9
    cp = data.withColumn("prediction", F.expr("CASE WHEN haversine_distance < 2.0 THEN 1.0 ELSE 0.0 END").cast("double"))
    got = ml.classification_metrics(cp).first()
    for m, col in [("accuracy", "Accuracy"), ("weightedPrecision", "Precision"), ("weightedRecall", "Recall"), ("f1", "F1")]:
        ref = MulticlassClassificationEvaluator(labelCol="is_high_traffic", metricName=m).evaluate(cp)
        assert abs(got[col] - ref) < 1e-9


def test_model_save_and_reload(spark, tmp_out):
    from pyspark.ml import PipelineModel

    data = ml.prepare_features(flow.fixture_matched(spark, SF001))
    train, test = ml.split(data)
    assert train.count() + test.count() == data.count()
    model = ml.fit(ml.regressors(ml.ModelParams())["LinearRegression"], train)
    model.write().overwrite().save(f"{tmp_out}/lr")
    again = PipelineModel.load(f"{tmp_out}/lr")
    a = [r[0] for r in model.transform(test).orderBy(*ml.KEY).select("prediction").collect()]
    b = [r[0] for r in again.transform(test).orderBy(*ml.KEY).select("prediction").collect()]
    assert a == b


def test_entry_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 48 and df.columns == ["pickup_hour", "is_weekend", "revenue", "trips", "avg_speed_kmh", "avg_total_amount"]
    assert set(E.oracle_sql()) <= set(E.queries())


def test_same_result_at_1_and_8_partitions(spark):
    from cabflow.plans import registry

    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(registry.QUERIES["q2_tips"](spark, SF001).collect(), key=repr))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def test_run_ml_fits_and_evaluates_every_row(spark, tmp_out, monkeypatch):
    """All six models through ``run_ml``, in a session that has used ``observe``; the staged table
    holds every plausible row, the metrics come from every test row, and nothing is left behind."""
    from pyspark.sql import Observation

    from cabflow.session import checkpoint_root

    spark.range(3).observe(Observation("any"), F.count(F.lit(1)).alias("n")).collect()

    assert not [n for n in vars(ml) if "MAX" in n or "cap" in n.lower()]
    staged = []
    real = ml.stage_training_table
    monkeypatch.setattr(ml, "stage_training_table", lambda df, path: staged.append((real(df, path).count(), path)) or real(df, path))
    m = flow.fixture_matched(spark, SF001)
    small = ml.ModelParams(lr_max_iter=5, rf_trees=3, rf_depth=3, gbt_iter=2, gbt_depth=2, logr_max_iter=5)
    rows = ml.run_ml(m, output_path=tmp_out, params=small).collect()
    want = ml.prepare_features(m)
    assert staged[0][0] == want.count()
    assert checkpoint_root(spark) and not os.path.exists(staged[0][1])
    got = {(r.task, r.model, r.metric): r.value for r in rows}
    assert len(got) == 3 * 3 + 3 * 4
    assert all(0 <= v <= 1 for (task, _, _), v in got.items() if task == "classification")
    assert {m for t, m, _ in got if t == "classification"} == set(ml.classifiers(small))
    assert sorted(os.listdir(f"{tmp_out}/classification")) == sorted(ml.classifiers(small))


def test_sample_mode_picks_one_file(spark, tmp_out):
    d = f"{tmp_out}/tripData2013"
    os.makedirs(d)
    for n in ("trip_data_2.csv", "trip_data_10.csv", "other.csv"):
        open(f"{d}/{n}", "w").close()
    assert feeds.trips_path(spark, data_root=tmp_out, sample=True).endswith("/trip_data_10.csv")
    open(f"{d}/trip_data_1.csv", "w").close()
    assert feeds.trips_path(spark, data_root=f"file:{tmp_out}", sample=True).endswith("/trip_data_1.csv")
    assert feeds.trips_path(spark, f"{d}/trip_data_2*.csv", sample=True).endswith("/trip_data_2.csv")
    assert feeds.trips_path(spark, data_root=tmp_out) == f"{tmp_out}/{feeds.TRIP_GLOB}"
    with __import__("pytest").raises(FileNotFoundError):
        feeds.fares_path(spark, data_root=tmp_out, sample=True)


def test_questions_written_in_order(spark, tmp_out):
    from cabflow.plans import job

    m = flow.fixture_matched(spark, SF001)
    outs = job.run_questions(m, tmp_out, weather=None)
    q1 = spark.read.option("header", True).option("inferSchema", True).csv(outs["q1_hourly_weekday_weekend"])
    keys = [(r["pickup_hour"], r["is_weekend"]) for r in q1.collect()]
    assert keys == sorted(keys) and len(keys) == 48


def test_job_end_to_end_small(spark, tmp_out):
    from cabflow.plans import job
    from cabflow.sources import fixtures

    trips = fixtures.trips_raw(spark, SF001)
    fares = fixtures.fares_raw(spark, SF001)
    res = job.run_etl(spark, trips, fares, tmp_out, weather=None)
    rep = {(r["source"], r["metric"]): int(r["value"]) for r in res.report.collect()}
    # FIXTURES.md section 4 counts at sf0.001
    assert rep[("trips", "total_records")] == 6451 and rep[("match", "matched_records")] == 4033
    assert rep[("match", "trips_without_fare")] == 618 and rep[("match", "fares_without_trip")] == 1462
    assert rep[("match", "incomplete_records")] == 14
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("cabflow_")]
    q = job.Paths(tmp_out).questions
    assert os.path.isdir(f"{q}/q1_hourly_weekday_weekend.csv")


def test_job_with_weather_and_ml_and_both_cli_modes(spark, tmp_out, monkeypatch, capsys):
    from cabflow.plans import job
    from cabflow.sources import fixtures

    data, out = f"{tmp_out}/in", f"{tmp_out}/out"
    writers.write_csv(fixtures.trips_raw(spark, SF001), f"{data}/tripData2013/trip_data_1.csv")
    writers.write_csv(fixtures.fares_raw(spark, SF001), f"{data}/faredata2013/trip_fare_1.csv")
    writers.write_csv(fixtures.weather_csv_frame(spark, SF001), f"{data}/{feeds.WEATHER_CSV}")
    monkeypatch.setattr(job, "build_session", lambda name: spark)
    monkeypatch.setattr(spark, "stop", lambda: None)
    small = ml.ModelParams(lr_max_iter=3, rf_trees=2, rf_depth=2, gbt_iter=1, gbt_depth=2, logr_max_iter=3)
    monkeypatch.setattr(ml.ModelParams, "__init__", lambda self: self.__dict__.update(small.__dict__))
    width = spark.conf.get("spark.sql.shuffle.partitions")
    assert job.main(["--data-root", data, "--output-root", out, "--train-ml"]) == 0
    p = job.Paths(out)
    report = {(r.source, r.metric): r.value for r in spark.read.option("header", True).csv(f"{p.processed}/etl_report.csv").collect()}
    assert any(s == "trips" and m not in ("total_records", "rejected_records") for s, m in report)  # reasons
    assert spark.read.option("header", True).csv(f"{p.models}/metrics").count() == 21
    weather = [f"{p.questions}/{n}.csv" for n in ("q5_weather_by_condition_hour", "q5_weather_by_precip_wind_hour")]
    first = [sorted(map(tuple, spark.read.csv(w).collect())) for w in weather]
    assert all(len(x) > 1 for x in first)
    assert spark.conf.get("spark.sql.shuffle.partitions") == width
    assert not [f for _, _, files in os.walk(p.staging) for f in files]
    assert job.main(["--output-root", out, "--data-root", data, "--parquet-only"]) == 0
    assert [sorted(map(tuple, spark.read.csv(w).collect())) for w in weather] == first
    shown = capsys.readouterr().out
    assert "fares" in shown and "processed trips" in shown and "|-- medallion" in shown


def test_match_runs_once_for_the_processed_write(spark, tmp_out):
    """The rows written come from one execution of their source: no sampling pass."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    m = flow.fixture_matched(spark, SF001)
    writers.write_processed(m.mapInArrow(count, m.schema), f"{tmp_out}/p", num_partitions=8)
    back = spark.read.parquet(f"{tmp_out}/p")
    assert seen.value == back.count() == m.count()
    # a single hot day is written by several tasks
    hot = m.withColumn("pickup_datetime", F.lit("2013-05-01 10:00:00").cast("timestamp"))
    pieces = writers.day_pieces(hot, rows_per_file=500)
    assert pieces.count() == 1
    writers.write_processed(hot, f"{tmp_out}/hot", num_partitions=8, pieces=pieces)
    assert spark.read.parquet(f"{tmp_out}/hot").count() == m.count()
    (day,) = [d for d, _, files in os.walk(f"{tmp_out}/hot") if d.endswith("day=1")]
    assert 3 <= len([f for f in os.listdir(day) if f.endswith(".parquet")]) <= 8


def test_sizes_hold_at_any_input(spark, tmp_out):
    from cabflow.session import input_bytes, sized_for, sizes_for

    for i in range(3):
        with open(f"{tmp_out}/f{i}.csv", "w") as f:
            f.write("x" * 1000)
    assert input_bytes(spark, [f"{tmp_out}/f*.csv"]) == 3000
    assert sizes_for(1000, 96).width == 96  # never below what is configured
    assert sizes_for(10 * 2**40, 96).width == 40960  # 10 TiB / 256 MiB
    for nbytes in (100 * 10**12, 10**15):
        s = sizes_for(nbytes, 96)
        assert s.buckets < 100_000 and s.width < 100_000 and s.split_bytes <= 2**30
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_for(spark, sizes_for(10**12, 4)):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 3726
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_no_private_folder_on_a_cluster():
    import pytest

    from cabflow.session import checkpoint_root

    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        checkpoint_root(Session())
