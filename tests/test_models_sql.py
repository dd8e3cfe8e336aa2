import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cabflow.operators import certificates, ml, tree_sql
from cabflow.plans import flow, registry
from tests.conftest import SF001

SMALL = ml.ModelParams(rf_trees=5, rf_depth=6, gbt_iter=6, gbt_depth=3)


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ml") / "features")
    return ml.stage_training_table(ml.prepare_features(flow.fixture_matched(spark, SF001)), path)


@pytest.fixture(scope="module")
def saved(spark, data, tmp_path_factory):
    """Path and scored test rows of each tree model."""
    root, out = str(tmp_path_factory.mktemp("models")), {}
    train, test = ml.split(data)
    for name, est in (ml.regressors(SMALL) | ml.classifiers(SMALL)).items():
        if isinstance(est, ml.TREES):
            ml.fit(est, train).write().save(f"{root}/{name}")
            out[name] = (f"{root}/{name}", PipelineModel.load(f"{root}/{name}").transform(test).select(*ml.FEATURES, "prediction"))
    return out


MODELS = ["RandomForestRegressor", "GBTRegressor", "RandomForestClassifier", "GBTClassifier"]


@pytest.mark.parametrize("name", MODELS)
def test_compiled_trees_in_both_engines(spark, saved, name):
    path, scored = saved[name]
    ensemble = tree_sql.load(spark, path, ml.FEATURES)
    grid = tree_sql.compile_ensemble(ensemble)
    rows = scored.withColumn("compiled", grid.prediction()).withColumn("score", grid.score_column()).toPandas()
    assert len(rows) > 300 and rows.prediction.nunique() > (1 if ensemble.combine == "vote" else 1)
    np.testing.assert_allclose(rows.compiled, rows.prediction, rtol=1e-12)
    con = duckdb.connect()
    con.register("rows", rows)
    sql = f"SELECT {grid.prediction_sql('duckdb')} AS p, {grid.score_sql('duckdb')} AS s, {ensemble.case_sql()} AS c FROM rows"
    duck = con.execute(sql).df()
    assert (duck.p == rows.compiled).all() and (duck.s == rows.score).all()
    np.testing.assert_allclose(duck.c, rows.score, rtol=1e-12, atol=1e-15)
    np.testing.assert_allclose(ensemble.scores(rows[ml.FEATURES].to_numpy(float)), rows.score, rtol=0)


@pytest.mark.parametrize("name", MODELS)
def test_awkward_features(spark, saved, name, monkeypatch):
    """NULL gives NULL; NaN and values at, below and above every cut go where the trees send them; so do nested CASEs."""
    ensemble = tree_sql.load(spark, saved[name][0], ml.FEATURES)
    cuts = ensemble.cuts()
    rows = [tuple(float(c[len(c) // 2]) if len(c) else 1.0 for c in cuts)]
    for i, c in enumerate(cuts):
        for v in [*c.tolist(), *np.nextafter(c, np.inf).tolist(), -1e300, 1e300, float("nan")]:
            rows.append(tuple(v if j == i else x for j, x in enumerate(rows[0])))
    rows += [tuple(None if j == i else x for j, x in enumerate(rows[0])) for i in range(4)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in ml.FEATURES))
    by_grid = [r.p for r in tree_sql.with_prediction(df, ensemble, "p").collect()]
    monkeypatch.setattr(tree_sql.compile_ensemble, "__defaults__", (3,))
    by_case = [r.p for r in tree_sql.with_prediction(df, ensemble, "p").collect()]
    complete = np.array([r for r in rows if None not in r])
    want = ensemble.decide(ensemble.scores(complete)).tolist()
    assert by_grid[-4:] == by_case[-4:] == [None] * 4
    np.testing.assert_allclose(by_grid[:-4], want, rtol=0)
    np.testing.assert_allclose(by_case[:-4], want, rtol=1e-12)


def test_scoring_sql_is_saved_beside_the_model(spark, data, saved):
    path, scored = saved["GBTRegressor"]
    ml.save_scoring_sql(spark, path, f"{path}_sql", ml.FEATURES)
    sql = spark.read.text(f"{path}_sql").first()[0]
    assert scored.filter(F.abs(F.expr(sql) - F.col("prediction")) > 1e-9).count() == 0


def test_loading_refuses_what_it_cannot_compile(spark, data, saved, tmp_out):
    ml.fit(ml.regressors(SMALL)["LinearRegression"], data).write().save(f"{tmp_out}/linear")
    with pytest.raises(ValueError, match="not a tree ensemble"):
        tree_sql.load(spark, f"{tmp_out}/linear", ml.FEATURES)
    path = saved["GBTRegressor"][0]
    with pytest.raises(ValueError, match="4 features"):
        tree_sql.load(spark, path, ml.FEATURES[:2])
    with pytest.raises(ValueError, match="cells"):
        tree_sql.compile_ensemble(tree_sql.load(spark, path, ml.FEATURES), max_cells=10)


def test_agreement_counts_differences(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 1.1), ("b", None, None), ("b", None, 2.0), ("b", 3.0, None)], "g string, prediction double, compiled double")
    got = {r.g: (r.trips, r.agreeing) for r in tree_sql.agreement(df, ["g"]).collect()}
    assert got == {"a": (2, 1), "b": (3, 1)}


def flags(df):
    return {r.term: r.optimal for r in df.collect()}


@pytest.mark.parametrize("reg,elastic", [(0.0, 0.0), (0.1, 0.8), (3.0, 0.5), (40.0, 1.0)])
def test_linear_certificate(spark, data, reg, elastic):
    from pyspark.ml.regression import LinearRegression

    train = data.withColumn("total_amount", F.col("total_amount") + 8 * F.col("haversine_distance") - 2 * F.col("pickup_hour"))
    est = LinearRegression(featuresCol="features", labelCol=ml.REG_LABEL, maxIter=100, regParam=reg, elasticNetParam=elastic)
    m = ml.fit(est, train).stages[-1]
    beta = m.coefficients.toArray()
    args = (train, ml.FEATURES, ml.REG_LABEL)
    assert all(flags(certificates.linear(*args, beta, m.intercept, reg, elastic)).values())
    for i in range(4):  # any coefficient moved, also one that is exactly 0
        moved = beta.copy()
        moved[i] += 0.05
        assert not flags(certificates.linear(*args, moved, m.intercept, reg, elastic))[ml.FEATURES[i]]
    assert not flags(certificates.linear(*args, beta, m.intercept + 1, reg, elastic))["intercept"]
    if reg == 40.0:
        assert (beta == 0).any()
        assert not all(flags(certificates.linear(*args, beta, m.intercept, 0.1, elastic)).values())


def test_logistic_certificate(spark, data):
    m = ml.fit(ml.classifiers(SMALL)["LogisticRegression"], data).stages[-1]
    beta = m.coefficients.toArray()
    args = (data, ml.FEATURES, ml.CLS_LABEL)
    assert all(flags(certificates.logistic(*args, beta, m.intercept, 0.1)).values())
    assert not flags(certificates.logistic(*args, beta * 1.05, m.intercept, 0.1))["haversine_distance"]
    assert not flags(certificates.logistic(*args, beta, m.intercept, 0.2))["haversine_distance"]
    assert not flags(certificates.logistic(*args, beta, m.intercept + 0.01, 0.1))["intercept"]


def test_certificates_of_awkward_rows(spark):
    """NULL rows are left out, a constant feature must have coefficient 0, no rows prove nothing."""
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, 6.0), (None, 5.0, 9.0), (4.0, 5.0, None)], "a double, k double, y double")
    assert all(flags(certificates.linear(df, ["a", "k"], "y", [2.0, 0.0], 0.0, 0.0, 0.0)).values())
    assert not flags(certificates.linear(df, ["a", "k"], "y", [2.0, 1.0], -5.0, 0.0, 0.0))["k"]
    none = certificates.linear(df.limit(0), ["a", "k"], "y", [2.0, 0.0], 0.0, 0.0, 0.0).collect()
    assert [r.trips for r in none] == [0] * 3 and not any(r.optimal for r in none)
    assert not any(r.optimal for r in certificates.logistic(df.limit(0), ["a"], "y", [2.0], 0.0, 0.1).collect())


def test_in_range_finds_impossible_metrics(spark):
    rows = [("regression", "m", "RMSE", 2.0), ("regression", "m", "MAE", 2.1), ("regression", "m", "R2", 1.1),
            ("classification", "c", "Accuracy", 0.5), ("classification", "c", "Recall", 0.6), ("classification", "c", "Precision", -0.1),
            ("classification", "c", "F1", None)]
    df = spark.createDataFrame(rows, "task string, model string, metric string, value double")
    got = {r.metric: r.in_range for r in ml.in_range(df).collect()}
    assert got == {"RMSE": True, "MAE": False, "R2": False, "Accuracy": True, "Recall": False, "Precision": False, "F1": False}


def test_oracle_fits_the_same_models(spark):
    """The DuckDB oracles fit the linear and logistic models themselves; on other data than the gate's too."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name in ("ml_reg_linear", "ml_cls_logistic", "ml_reg_linear_certificate", "ml_cls_logistic_certificate"):
        got = registry.QUERIES[name](spark, SF001).toPandas()
        want = con.execute(registry.ORACLES[name]).df()
        key = list(got.columns[:3])
        got, want = (d.sort_values(key).reset_index(drop=True) for d in (got, want[got.columns]))
        pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9, atol=2e-6 if "certificate" not in name else 2e-4)


def test_training_table_is_dealt_by_rows(spark, tmp_out, monkeypatch):
    """A compact table is few splits for the reader; the fits get partitions of bounded rows, every row once."""
    df = spark.range(0, 40_000, 1, 1).select(
        *[F.col("id").cast("double").alias(c) for c in ml.FEATURES], F.lit(1.0).alias(ml.REG_LABEL), F.lit(0.0).alias(ml.CLS_LABEL),
        F.col("id").cast("string").alias("medallion"), F.lit("H").alias("hack_license"), F.lit("V").alias("vendor_id"),
        F.current_timestamp().alias("pickup_datetime"))
    assert ml.stage_training_table(df, f"{tmp_out}/few").rdd.getNumPartitions() == 1  # as read
    monkeypatch.setattr(ml, "ROWS_PER_PARTITION", 5_000)
    data = ml.stage_training_table(df, f"{tmp_out}/many")
    sizes = [r[1] for r in data.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 6_000
    assert data.agg(F.count_distinct(ml.FEATURES[0]), F.count("*")).first() == (40_000, 40_000)


def test_cached_nodes_change_no_forest(spark, data):
    train = ml.split(data)[0]
    for task in (ml.regressors, ml.classifiers):
        est = next(e for n, e in task(SMALL).items() if n.startswith("RandomForest"))
        assert est.getCacheNodeIds()
        cached, plain = (ml.fit(est.copy({est.cacheNodeIds: on}), train).stages[-1].toDebugString for on in (True, False))
        assert cached.split("\n")[1:] == plain.split("\n")[1:]
