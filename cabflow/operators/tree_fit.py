"""Tree ensembles fitted on folded rows: the work after one pass does not grow with the rows.

Spark's trainer puts every feature into at most ``maxBins`` bins and never looks at more than a row's bins, its
label and its weight. So rows of the same bins (a *cell*) are folded before the fit, with nothing lost:

* classes: a cell has a point for each class, with its number of rows;
* numbers: a cell has two points, mean - deviation and mean + deviation, of half its rows each. They have the cell's
  count, sum and sum of squares, which is all that variance impurity reads; squared-loss boosting moves all labels of a
  cell alike, so this holds for every tree of a boosted ensemble;
* bagging: each row is drawn Poisson-many times for each tree, row by row as in Spark, and the draws are folded.

The cuts between bins are those that Spark would take, from the rows that it would sample for them. Spark's trainer then
fits the points, with the bin's number as feature, and the thresholds of its nodes are put back to the cuts. There are
at most as many points as rows (or twice as many), and at most ``maxBins`` to the power of the features.

A boosted ensemble is the one that Spark fits on the rows, up to rounding. A forest is one of the same distribution: its
draws come from other random numbers than Spark's (which depend on the partitions as well).
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators.quantiles import kept
from cabflow.operators.tree_sql import bin_sql
from cabflow.session import remove_path, scratch_dir

FORESTS = (RandomForestRegressor, RandomForestClassifier)
CLASSIFIERS = (RandomForestClassifier, GBTClassifier)
TREES = (*FORESTS, GBTRegressor, GBTClassifier)
# Spark looks at this many rows at least for the cuts.
CUT_ROWS = 10_000
# Trees whose draws one pass over a row makes: an aggregate of three sums for each stays inside generated code.
TREES_A_BLOCK = 5
WEIGHT, TREE = "_weight", "tree_no"


def folds(estimator) -> bool:
    """Whether the estimator's result depends on cells alone (else it is left to Spark, row by row)."""
    if not isinstance(estimator, TREES) or estimator.isDefined("weightCol"):
        return False
    if isinstance(estimator, FORESTS):
        return estimator.getBootstrap()
    squared = isinstance(estimator, GBTClassifier) or estimator.getLossType() == "squared"
    return squared and estimator.getSubsamplingRate() == 1.0 and not estimator.isDefined("validationIndicatorCol")


def fit(estimator, train: DataFrame, features: Sequence[str]):
    """The fitted model of a tree estimator, over vectors of ``features``."""
    spark = train.sparkSession
    root = scratch_dir(spark, "tree-fit")
    try:
        cuts = candidate_cuts(train, features, estimator.getMaxBins(), estimator.getSeed())
        if isinstance(estimator, FORESTS):
            model = _fit_forest(estimator, train, features, cuts, root)
        else:
            model = _fit_boosted(estimator, train, features, cuts, root)
        model.write().save(f"{root}/binned")
        _with_cuts(spark, f"{root}/binned", f"{root}/model", cuts)
        return type(model).load(f"{root}/model")
    finally:
        remove_path(spark, root)


# ---- cuts ------------------------------------------------------------------------------------


def candidate_cuts(train: DataFrame, features: Sequence[str], max_bins: int, seed: int) -> list[list[float]]:
    """Of each feature the thresholds that Spark's trainer chooses from, ascending: by its rule, and from the rows that
    it draws with that seed."""
    spark, n = train.sparkSession, train.count()
    rows = train.select(*[F.col(f).cast("double") for f in features])
    wanted = max(max_bins * max_bins, CUT_ROWS)
    if wanted < n:
        own = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sampled = rows._jdf.rdd().sample(False, wanted / n, own)
        rows = DataFrame(spark._jsparkSession.createDataFrame(sampled, rows._jdf.schema()), spark)
    x = np.array([tuple(r) for r in rows.collect()], float).reshape(-1, len(features))
    expected = min(1.0, wanted / n) * n if n else 0.0
    return [cuts_of(x[:, i], expected, min(max_bins, n)) for i in range(len(features))]


def cuts_of(values: np.ndarray, expected: float, bins: int) -> list[float]:
    """Spark's rule for one continuous feature: a cut between any two neighbours if there are few values, else where the
    running count comes closest to a multiple of the stride. Zeros are what the other values lack of ``expected``."""
    x, count = np.unique(values[(values != 0) & ~np.isnan(values)], return_counts=True)
    if not len(x):
        return []
    count = count.astype(float)
    lacking = expected - count.sum()
    if lacking > np.finfo(float).eps * count.sum() * 100:
        at = int(np.searchsorted(x, 0.0))
        x, count = np.insert(x, at, 0.0), np.insert(count, at, lacking)
    middle = (x[:-1] + x[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle.tolist()
    stride = expected / bins
    cuts, target, current = [], stride, count[0]
    for i in range(1, len(x)):
        before, current = current, current + count[i]
        if abs(before - target) < abs(current - target):
            cuts.append(float(middle[i - 1]))
            target += stride
    return cuts


def _bins(features: Sequence[str], cuts: Sequence[Sequence[float]]) -> list[Column]:
    """The bin of each feature, from 1 (never 0: the trainer counts zeros by subtraction)."""
    return [F.expr(bin_sql(f, c)).alias(f) for f, c in zip(features, cuts, strict=True)]


# ---- folding ---------------------------------------------------------------------------------


def _two_points(n: Column, mean: Column, variance: Column, label: str) -> Column:
    dev = F.sqrt(F.greatest(variance, F.lit(0.0)))
    return F.explode(F.array(*[F.struct((mean + sign * dev).alias(label), (n / 2.0).alias(WEIGHT)) for sign in (-1.0, 1.0)]))


def _label(estimator) -> Column:
    """The label as a double; a missing one stays so that the trainer refuses it as it does in rows."""
    return F.coalesce(F.col(estimator.getLabelCol()).cast("double"), F.lit(float("nan"))).alias("_y")


def fold(estimator, train: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """The points of all rows: bins, label and weight."""
    label, keys = estimator.getLabelCol(), list(features)
    rows = train.select(*_bins(features, cuts), _label(estimator))
    if isinstance(estimator, CLASSIFIERS):
        return rows.groupBy(*keys, F.col("_y").alias(label)).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    cells = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg("_y").alias("_m"), F.var_pop("_y").alias("_v"))
    return cells.select(*keys, _two_points(F.col("_n"), F.col("_m"), F.col("_v"), label).alias("_p")).select(*keys, "_p.*")


def poisson_steps(rate: float) -> list[float]:
    """P(N <= k) for k = 0, 1, ... until nothing is left that a double in [0, 1) could hit."""
    steps, term, total, k = [], math.exp(-rate), 0.0, 0
    while total + term < 1.0 and (k <= rate or term > 2.0**-54):
        total += term
        steps.append(total)
        k += 1
        term *= rate / k
    return steps


def _draws(u: Column, rate: float) -> Column:
    """A Poisson variable from a uniform one, by its distribution function."""
    steps = poisson_steps(rate)
    out = F.when(u < steps[0], F.lit(0.0))
    for k, s in enumerate(steps[1:], 1):
        out = out.when(u < s, F.lit(float(k)))
    return out.otherwise(F.lit(float(len(steps))))


def fold_bags(estimator, train: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """The points of each tree's bag: bins, label, weight and ``TREE``. Every row is drawn for every tree."""
    label, keys, trees = estimator.getLabelCol(), list(features), estimator.getNumTrees()
    size = min(TREES_A_BLOCK, trees)
    block = F.explode(F.sequence(F.lit(0), F.lit(-(-trees // size) - 1))).alias("_block")
    rows = train.select(*_bins(features, cuts), _label(estimator)).select("*", block)
    # Spark adds the partition's number to a seed: a billion apart, no two columns of any partitions share one.
    own = estimator.getSeed() * 1_000_003
    rows = rows.select("*", *[F.rand(own + (j + 1) * 10**9).alias(f"_u{j}") for j in range(size)])
    rows = rows.select(*keys, "_y", "_block", *[_draws(F.col(f"_u{j}"), estimator.getSubsamplingRate()).alias(f"_w{j}") for j in range(size)])
    classes = isinstance(estimator, CLASSIFIERS)
    groups = [*keys, "_block", *(["_y"] if classes else [])]
    sums, y = [], F.col("_y")
    for j in range(size):
        w = F.col(f"_w{j}")
        sums.append(F.sum(w).alias(f"_n{j}"))
        if not classes:
            sums += [F.sum(w * y).alias(f"_s{j}"), F.sum(w * y * y).alias(f"_q{j}")]
    cells = rows.groupBy(*groups).agg(*sums)
    each = F.explode(F.array(*[
        F.struct((F.col("_block") * size + j).alias(TREE), *[F.col(f"_{c}{j}").alias(f"_{c}") for c in ("n" if classes else "nsq")])
        for j in range(size)
    ]))
    bags = cells.select(*[g for g in groups if g != "_block"], each.alias("_b")).filter(f"_b._n > 0 AND _b.{TREE} < {trees}")
    if classes:
        return bags.select(*keys, F.col("_y").alias(label), F.col("_b._n").alias(WEIGHT), f"_b.{TREE}")
    mean = F.col("_b._s") / F.col("_b._n")
    point = _two_points(F.col("_b._n"), mean, F.col("_b._q") / F.col("_b._n") - mean * mean, label)
    return bags.select(*keys, f"_b.{TREE}", point.alias("_p")).select(*keys, "_p.*", TREE)


# ---- fitting the points ----------------------------------------------------------------------


def _vectors(points: DataFrame, features: Sequence[str], estimator) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=estimator.getFeaturesCol()).transform(points)


def _enough_bins(estimator, points: int) -> int:
    """``maxBins`` with which the trainer looks at all points for its thresholds."""
    return max(estimator.getMaxBins(), math.isqrt(points) + 1)


def _fit_boosted(estimator, train: DataFrame, features: Sequence[str], cuts, root: str):
    points = kept(fold(estimator, train, features, cuts), f"{root}/points")
    e = estimator
    model = e.copy({e.weightCol: WEIGHT, e.maxBins: _enough_bins(e, points.count())}).fit(_vectors(points, features, e))
    jm = model._java_obj
    return _model(e, model, jm.trees(), jm.treeWeights(), len(features))


def _fit_forest(estimator, train: DataFrame, features: Sequence[str], cuts, root: str):
    """One forest of one tree for each bag, each by Spark's trainer; their trees together are the forest."""
    spark, e = train.sparkSession, estimator
    bags = fold_bags(e, train, features, cuts)
    schema = bags.drop(TREE).schema
    bags.repartition(e.getNumTrees(), TREE).write.partitionBy(TREE).parquet(f"{root}/bags")
    sizes = {r[0]: r[1] for r in spark.read.parquet(f"{root}/bags").groupBy(TREE).count().collect()}
    subset = e.getFeatureSubsetStrategy()
    if subset == "auto" and e.getNumTrees() > 1:
        subset = "sqrt" if isinstance(e, CLASSIFIERS) else "onethird"

    def one(t: int):
        own = e.copy({
            e.numTrees: 1, e.bootstrap: False, e.subsamplingRate: 1.0, e.featureSubsetStrategy: subset, e.cacheNodeIds: False,
            e.seed: e.getSeed() + t, e.weightCol: WEIGHT, e.maxBins: _enough_bins(e, sizes[t])})
        points = spark.read.schema(schema).parquet(f"{root}/bags/{TREE}={t}")
        return own.fit(_vectors(points, features, e))

    # A small bag may have drawn no row at all: its tree would say nothing, and is left out.
    with ThreadPoolExecutor(max(2, min(8, spark.sparkContext.defaultParallelism))) as pool:
        fitted = list(pool.map(one, sorted(sizes)))
    largest = max(fitted, key=lambda m: m.numClasses) if isinstance(e, CLASSIFIERS) else fitted[0]
    single = type(largest.trees[0]).__name__
    trees = spark.sparkContext._gateway.new_array(getattr(_package(spark, e), single), len(fitted))
    for i, m in enumerate(fitted):
        trees[i] = m._java_obj.trees()[0]
    return _model(e, largest, trees, len(features))


def _package(spark: SparkSession, estimator):
    ml = spark.sparkContext._jvm.org.apache.spark.ml
    return ml.classification if isinstance(estimator, CLASSIFIERS) else ml.regression


def _model(estimator, like, *parts):
    """A model of the class of ``like`` from its trees, with the estimator's own parameters."""
    classes = [like.numClasses] if isinstance(estimator, CLASSIFIERS) else []
    made = getattr(_package(SparkSession.active(), estimator), type(like).__name__)(estimator.uid, *parts, *classes)
    return estimator._copyValues(estimator._create_model(made))


def _with_cuts(spark: SparkSession, binned: str, path: str, cuts: Sequence[Sequence[float]]) -> None:
    """Copy a saved model with thresholds between bins put back to the cuts (one that lies between the bins a and b
    is any cut from a to b - 1), and the number of rows in each node to that of the rows folded."""
    spark.read.text(f"{binned}/metadata").coalesce(1).write.text(f"{path}/metadata")
    spark.read.parquet(f"{binned}/treesMetadata").write.parquet(f"{path}/treesMetadata")
    # One literal, not a column for each of its elements.
    known = F.from_json(F.lit(json.dumps([list(c) for c in cuts])), "array<array<double>>")
    feature, stats = F.col("nodeData.split.featureIndex"), F.col("nodeData.impurityStats")
    put_back = F.transform("nodeData.split.leftCategoriesOrThreshold",
                           lambda v: F.element_at(F.element_at(known, feature + 1), F.floor(v).cast("int")))
    gini = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)
    kind = json.loads(spark.read.text(f"{binned}/metadata").first()[0])["class"]
    folded = gini if kind.endswith("RandomForestClassificationModel") else stats[0]
    node = (F.col("nodeData").withField("split.leftCategoriesOrThreshold", put_back)
            .withField("rawCount", F.round(folded).cast("bigint")))
    spark.read.parquet(f"{binned}/data").withColumn("nodeData", node).write.parquet(f"{path}/data")
