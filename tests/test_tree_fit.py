"""Tree ensembles fitted on folded rows: what Spark fits on the rows, from points that do not grow with them."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cabflow.operators import ml, tree_fit

FEATURES = ["a", "b"]
P = ml.ModelParams(rf_trees=7, rf_depth=4, gbt_iter=3, gbt_depth=3, features=FEATURES)


def rows(n, seed=1):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        a, b = round(r.uniform(0, 30), 3), float(r.randrange(6))
        out.append((a, b, 2 * a + 5 * (b > 2) + r.gauss(0, 3), 1.0 if a + 3 * r.gauss(0, 2) > 15 else 0.0))
    return out


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(rows(1500), f"a double, b double, {ml.REG_LABEL} double, {ml.CLS_LABEL} double").coalesce(1).cache()


@pytest.mark.parametrize("name", ["GBTRegressor", "GBTClassifier"])
def test_boosted_trees_are_those_of_the_rows(train, name):
    est = (ml.regressors(P) | ml.classifiers(P))[name]
    by_rows = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), est]).fit(train)
    folded = ml.fit(est, train, FEATURES)
    a, b = ([r.prediction for r in m.transform(train).collect()] for m in (by_rows, folded))
    np.testing.assert_allclose(a, b, rtol=1e-9)
    old, new = by_rows.stages[-1], folded.stages[-1]
    assert new.getMaxBins() == old.getMaxBins() and not new.isSet("weightCol") and new.uid == est.uid
    np.testing.assert_allclose(new.featureImportances.toArray(), old.featureImportances.toArray(), rtol=1e-6)


def test_points_hold_all_that_impurity_reads_and_do_not_grow(train):
    est = ml.regressors(P)["GBTRegressor"]
    cuts = tree_fit.candidate_cuts(train, FEATURES, 32, 42)
    assert [len(c) for c in cuts] == [31, 5]
    many = train.crossJoin(train.sparkSession.range(40).select())
    points = tree_fit.fold(est, many, FEATURES, cuts)
    assert points.count() == tree_fit.fold(est, train, FEATURES, cuts).count() <= 2 * 32 * 6
    w, y = F.col(tree_fit.WEIGHT), F.col(ml.REG_LABEL)
    got = points.groupBy("b").agg(F.sum(w), F.sum(w * y), F.sum(w * y * y)).orderBy("b").collect()
    want = many.groupBy("b").agg(F.count("*"), F.sum(y), F.sum(y * y)).orderBy("b").collect()
    np.testing.assert_allclose([r[1:] for r in got], [r[1:] for r in want], rtol=1e-9)
    classes = tree_fit.fold(ml.classifiers(P)["GBTClassifier"], many, FEATURES, cuts)
    assert classes.groupBy(ml.CLS_LABEL).agg(F.sum(w)).collect() == many.groupBy(ml.CLS_LABEL).agg(F.count("*").cast("double")).collect()


@pytest.mark.parametrize("name", ["RandomForestRegressor", "RandomForestClassifier"])
def test_every_row_is_drawn_for_every_tree(train, name):
    est = (ml.regressors(P) | ml.classifiers(P))[name]
    cuts = tree_fit.candidate_cuts(train, FEATURES, 32, 42)
    many = train.crossJoin(train.sparkSession.range(20).select())
    bags = tree_fit.fold_bags(est, many, FEATURES, cuts).groupBy(tree_fit.TREE).agg(F.sum(tree_fit.WEIGHT), F.count("*")).collect()
    assert sorted(r[0] for r in bags) == list(range(7)) and len({r[1] for r in bags}) > 1
    n = 30_000  # the size of a bag is Poisson
    assert all(abs(r[1] - n) < 5 * n**0.5 and r[2] <= 2 * 32 * 6 for r in bags)
    model = ml.fit(est, many, FEATURES).stages[-1]
    assert len(model.trees) == 7 and {t.depth for t in model.trees} <= set(range(1, 5)) and model.getNumTrees == 7


def test_draws_are_poisson():
    for rate in (0.3, 1.0, 4.0):
        steps = np.array(tree_fit.poisson_steps(rate))
        share = np.diff(np.append(0.0, steps))
        assert share[0] == pytest.approx(np.exp(-rate)) and 1 - steps[-1] < 1e-14
        assert (share * np.arange(len(share))).sum() == pytest.approx(rate)


@pytest.mark.parametrize("name", ["GBTRegressor", "RandomForestClassifier"])
def test_missing_values_are_refused_as_in_rows(spark, train, name):
    est = (ml.regressors(P) | ml.classifiers(P))[name]
    for column in ("a", est.getLabelCol()):
        broken = train.limit(50).unionByName(train.limit(1).withColumn(column, F.lit(None).cast("double")))
        with pytest.raises(Exception):
            ml.fit(est, broken, FEATURES)


def test_other_estimators_go_by_rows(train):
    assert not tree_fit.folds(ml.regressors(P)["LinearRegression"])
    est = ml.regressors(P)["GBTRegressor"]
    assert tree_fit.folds(est) and not tree_fit.folds(est.copy({est.lossType: "absolute"})) and not tree_fit.folds(est.copy({est.subsamplingRate: 0.5}))
