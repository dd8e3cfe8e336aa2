"""Fare regression and traffic classification with Spark ML.

* Features are column expressions (haversine, hour, weekday, weekend flag) on the
  matched trips after a plausibility filter.
* The 80/20 split is a hash of the trip key (stable under repartitioning and executor
  loss, reproducible in SQL); ``randomSplit`` is kept as an option.
* The training columns are written once below the checkpoint folder and read back, which
  cuts the lineage before the iterative fits. Every row is used: there is no cap.
* Metrics are ONE aggregate per model (instead of one evaluator job per metric) and
  equal the Spark evaluators' definitions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions import features as fx
from cabflow.operators import tree_fit, tree_sql
from cabflow.schemas import KEY
from cabflow.session import remove_path, scratch_dir, staging

# The feature columns and the two labels.
FEATURES = ["haversine_distance", "pickup_hour", "is_weekend", "passenger_count"]
REG_LABEL = "total_amount"
CLS_LABEL = "is_high_traffic"
# Fixed value: traffic threshold (mph).
HIGH_TRAFFIC_MPH = 12.0
TRAIN_BUCKETS = 8  # of 10 hash buckets -> 80 % train
BUCKET = "split_bucket"
# Rows of one partition of the training table. The tree fits hold no rows; the linear and the logistic fit hold some
# 50 bytes for each.
ROWS_PER_PARTITION = 4_000_000


# The bounds of a plausible trip.
def plausible(df: DataFrame) -> DataFrame:
    """Total 2.5-500, both points inside lon -75..-72 / lat 40..42, passengers > 0."""
    return df.filter(
        F.col("total_amount").between(2.5, 500)
        & F.col("pickup_longitude").between(-75, -72)
        & F.col("pickup_latitude").between(40, 42)
        & F.col("dropoff_longitude").between(-75, -72)
        & F.col("dropoff_latitude").between(40, 42)
        & (F.col("passenger_count") > 0)
    )


def with_haversine(df: DataFrame) -> DataFrame:
    return df.withColumn("haversine_distance", fx.trip_haversine_km())


def prepare_features(df: DataFrame) -> DataFrame:
    """Plausibility filter -> haversine, hour, weekday, weekend -> time > 60 s and
    distance > 0.5 km -> speed (mph) and the traffic label (speed < 12 mph)."""
    out = with_haversine(plausible(df)).withColumns(
        {"pickup_hour": fx.pickup_hour(), "day_of_week": fx.pickup_dow()}
    )
    out = out.withColumn("is_weekend", fx.is_weekend(F.col("day_of_week")))
    out = out.filter((F.col("trip_time_in_secs") > 60) & (F.col("haversine_distance") > 0.5))
    out = out.withColumn(
        "trip_speed_mph",
        (F.col("haversine_distance") * F.lit(fx.KM_TO_MILES)) / (F.col("trip_time_in_secs") / F.lit(3600)),
    )
    return out.withColumn(
        CLS_LABEL, F.when(F.col("trip_speed_mph") < HIGH_TRAFFIC_MPH, F.lit(1.0)).otherwise(F.lit(0.0))
    )


def key_bucket(buckets: int = 10) -> Column:
    """Bucket 0..buckets-1 from the md5 of the trip key (pickup formatted explicitly)."""
    k = F.concat_ws(
        "|", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss") if c == "pickup_datetime" else F.col(c) for c in KEY]
    )
    return F.pmod(F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def split(df: DataFrame, method: str = "hash", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """80/20 train/test. ``hash``: by key bucket (deterministic); ``random``: randomSplit."""
    if method == "random":
        train, test = df.randomSplit([0.8, 0.2], seed=seed)
        return train, test
    b = F.col(BUCKET) if BUCKET in df.columns else key_bucket()
    return df.filter(b < TRAIN_BUCKETS), df.filter(b >= TRAIN_BUCKETS)


# ---- models -------------------------------------------------------------------------------

# The parameters of the six models.
@dataclass
class ModelParams:
    lr_max_iter: int = 100
    lr_reg: float = 0.1
    lr_elastic: float = 0.8
    rf_trees: int = 50
    rf_depth: int = 10
    gbt_iter: int = 30
    gbt_depth: int = 5
    logr_max_iter: int = 100
    logr_reg: float = 0.1
    seed: int = 42
    features: list[str] = field(default_factory=lambda: list(FEATURES))


def regressors(p: ModelParams) -> dict:
    """The forests keep each row's node in each tree (``cacheNodeIds``), which changes no result and only matters where
    a fit goes through the rows (``tree_fit`` folds them)."""
    return {
        "LinearRegression": LinearRegression(
            featuresCol="features", labelCol=REG_LABEL, maxIter=p.lr_max_iter, regParam=p.lr_reg,
            elasticNetParam=p.lr_elastic),
        "RandomForestRegressor": RandomForestRegressor(
            featuresCol="features", labelCol=REG_LABEL, numTrees=p.rf_trees, maxDepth=p.rf_depth, seed=p.seed,
            cacheNodeIds=True),
        "GBTRegressor": GBTRegressor(
            featuresCol="features", labelCol=REG_LABEL, maxIter=p.gbt_iter, maxDepth=p.gbt_depth, seed=p.seed),
    }


def classifiers(p: ModelParams) -> dict:
    return {
        "LogisticRegression": LogisticRegression(
            featuresCol="features", labelCol=CLS_LABEL, maxIter=p.logr_max_iter, regParam=p.logr_reg),
        "RandomForestClassifier": RandomForestClassifier(
            featuresCol="features", labelCol=CLS_LABEL, numTrees=p.rf_trees, maxDepth=p.rf_depth, seed=p.seed,
            cacheNodeIds=True),
        "GBTClassifier": GBTClassifier(
            featuresCol="features", labelCol=CLS_LABEL, maxIter=p.gbt_iter, maxDepth=p.gbt_depth, seed=p.seed),
    }


def fit(estimator, train: DataFrame, features: list[str] = FEATURES) -> PipelineModel:
    """Tree ensembles are fitted on rows folded by their bins (``tree_fit``), the others on the rows themselves."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    if tree_fit.folds(estimator):
        return PipelineModel([assembler, tree_fit.fit(estimator, train, features)])
    return Pipeline(stages=[assembler, estimator]).fit(train)


# ---- metrics (one aggregate each) --------------------------------------------------------

def regression_metrics(pred: DataFrame, label: str = REG_LABEL, prediction: str = "prediction") -> DataFrame:
    """``RMSE, MAE, R2`` as one row (RegressionEvaluator definitions)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    s = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((p - y) * (p - y)).alias("sse"),
        F.sum(F.abs(p - y)).alias("sae"),
        F.var_pop(y).alias("var_y"),
    )
    ss_tot = F.col("var_y") * F.col("n")
    return s.select(
        F.sqrt(F.col("sse") / F.col("n")).alias("RMSE"),
        (F.col("sae") / F.col("n")).alias("MAE"),
        (F.lit(1.0) - F.col("sse") / ss_tot).alias("R2"),
    )


def classification_metrics(pred: DataFrame, label: str = CLS_LABEL, prediction: str = "prediction") -> DataFrame:
    """``Accuracy`` and label-weighted ``Precision``, ``Recall``, ``F1`` as one row
    (MulticlassClassificationEvaluator definitions). The confusion table has at most
    labels x labels rows."""
    conf = pred.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("c")
    )
    per_label = conf.groupBy("y").agg(
        F.sum("c").alias("n_true"), F.sum(F.when(F.col("y") == F.col("p"), F.col("c")).otherwise(0)).alias("tp")
    )
    per_pred = conf.groupBy(F.col("p").alias("y")).agg(F.sum("c").alias("n_pred"))
    lab = per_label.join(per_pred, "y", "left").fillna(0, ["n_pred"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("n_true") > 0, F.col("tp") / F.col("n_true")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    lab = lab.select("n_true", "tp", prec.alias("prec"), rec.alias("rec"), f1.alias("f1"))
    return lab.agg(
        (F.sum("tp") / F.sum("n_true")).alias("Accuracy"),
        (F.sum(F.col("n_true") * F.col("prec")) / F.sum("n_true")).alias("Precision"),
        (F.sum(F.col("n_true") * F.col("rec")) / F.sum("n_true")).alias("Recall"),
        (F.sum(F.col("n_true") * F.col("f1")) / F.sum("n_true")).alias("F1"),
    )


def metrics_long(wide: DataFrame, task: str, model: str) -> DataFrame:
    """One metrics row -> ``task, model, metric, value`` rows."""
    return wide.select(
        F.lit(task).alias("task"),
        F.lit(model).alias("model"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                            for c in wide.columns])).alias("m"),
    ).select("task", "model", "m.metric", "m.value")


def training_columns(df: DataFrame, params: ModelParams | None = None) -> DataFrame:
    """The features, the two labels and the train/test bucket: all that the fits read."""
    return df.select(*(params or ModelParams()).features, REG_LABEL, CLS_LABEL, key_bucket().alias(BUCKET))


def stage_training_table(df: DataFrame, path: str) -> DataFrame:
    """Write the training columns once and read them back: the iterative fits scan a narrow
    Parquet table and do not recompute the match."""
    with staging(df.sparkSession):
        training_columns(df).write.mode("overwrite").parquet(path)
    return in_partitions(df.sparkSession.read.parquet(path))


def in_partitions(data: DataFrame, rows: int | None = None) -> DataFrame:
    """``data`` (files) in partitions of about ``rows`` rows at most. A reader splits by bytes, and the training
    columns are few bytes on disk, but many more in a fit. A table that is dealt finely enough is left as it is."""
    rows = rows or ROWS_PER_PARTITION
    wanted = -(-data.count() // rows)  # from the footers of the files
    return data.repartition(wanted) if wanted > data.rdd.getNumPartitions() else data


TREES = (RandomForestRegressor, GBTRegressor, RandomForestClassifier, GBTClassifier)


def save_scoring_sql(spark: SparkSession, model_path: str, path: str, features: list[str]) -> None:
    """Write the scoring expression of a saved tree model to ``path`` (one text file), for engines without the
    ML runtime."""
    ensemble = tree_sql.load(spark, model_path, features)
    try:
        sql = tree_sql.compile_ensemble(ensemble).prediction_sql()
    except ValueError:  # too many cells
        sql = ensemble.case_sql()
    spark.createDataFrame([(sql,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def train_evaluate(
    data: DataFrame,
    task: str,
    params: ModelParams | None = None,
    models: list[str] | None = None,
    output_path: str | None = None,
    split_method: str = "hash",
) -> DataFrame:
    """Fit the task's models on the train split, evaluate on the test split; returns the
    metrics as ``task, model, metric, value``. Models are saved under ``output_path``."""
    p = params or ModelParams()
    spark = data.sparkSession
    root = output_path.rstrip("/") if output_path else scratch_dir(spark, "models")
    ests = regressors(p) if task == "regression" else classifiers(p)
    train, test = split(data, split_method, p.seed)
    parts = []
    for name, est in ests.items():
        if models and name not in models:
            continue
        fit(est, train, p.features).write().overwrite().save(f"{root}/{task}/{name}")
        if output_path and isinstance(est, TREES):
            save_scoring_sql(spark, f"{root}/{task}/{name}", f"{root}/{task}_sql/{name}", p.features)
        # Score with the model as saved. A freshly fitted logistic model still holds its training
        # summary, and through it the session, which cannot be sent to tasks once any query of
        # the session has used ``observe``.
        pred = PipelineModel.load(f"{root}/{task}/{name}").transform(test)
        wide = regression_metrics(pred) if task == "regression" else classification_metrics(pred)
        # Materialise the small metrics row now, so the result no longer depends on the model.
        parts.append(spark.createDataFrame(metrics_long(wide, task, name).collect(),
                                           "task string, model string, metric string, value double"))
    if not output_path:
        remove_path(spark, root)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def run_ml(df: DataFrame, output_path: str | None = None, params: ModelParams | None = None) -> DataFrame:
    """Features -> staged table -> three regressors and three classifiers, fitted and evaluated on
    every row. The staged copy is removed once the metrics are there."""
    spark = df.sparkSession
    path, data = scratch_dir(spark, "ml-features"), None
    try:
        # The six fits scan the narrow table many times: kept in memory where it fits, else on disk.
        data = stage_training_table(prepare_features(df), path).persist(StorageLevel.MEMORY_AND_DISK)
        reg = train_evaluate(data, "regression", params, output_path=output_path)
        return reg.unionByName(train_evaluate(data, "classification", params, output_path=output_path))
    finally:
        if data is not None:
            data.unpersist()
        remove_path(spark, path)


def in_range(metrics: DataFrame) -> DataFrame:
    """``task, model, metric, in_range``: whether each value of a ``task, model, metric, value`` table is one
    that its metric can take (given the model's other metrics)."""
    per = metrics.groupBy("task", "model").agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("of"))
    m, v = F.col("metric"), F.col("value")
    ok = (
        F.when(m == "RMSE", v >= 0)
        .when(m == "MAE", (v >= 0) & (v <= F.col("of")["RMSE"] * (1 + 1e-12)))
        .when(m == "R2", v <= 1)
        .when(m == "Recall", F.abs(v - F.col("of")["Accuracy"]) < 1e-12)
        .otherwise((v >= 0) & (v <= 1))
    )
    return metrics.join(per, ["task", "model"]).select("task", "model", "metric", F.coalesce(ok, F.lit(False)).alias("in_range"))
