"""Proofs that a fitted linear or logistic model is the optimum of its objective.

A fit is iterative and its steps cannot be repeated elsewhere, but its result can be checked: at the optimum
of a convex objective the (sub)gradient is zero. Both checks take one aggregate over the training rows, whatever the
number of iterations the fit took, and return one row per term with the size of the violation:

* elastic net (``linear``): means, variances and covariances of features and label (a Gram matrix) give the
  gradient of the squared loss at the fitted coefficients. On standardised features and label, a
  coefficient that is not zero needs gradient = -l1 * sign - l2 * coefficient; one that is zero needs |gradient| <= l1.
* logistic with an L2 penalty (``logistic``): the mean of (probability - label) * standardised feature plus the
  penalty's gradient; the intercept has no penalty.

Defined results: rows with a NULL in a feature or the label are left out, as the runtime does not take them; a
feature without variation must have coefficient 0; no rows give NULL violations, which are not optimal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A violation up to this counts as zero (the fits stop at a relative improvement of 1e-6).
BOUND = 1e-4
INTERCEPT = "intercept"


def _complete(train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    every = [F.col(c).cast("double").alias(c) for c in (*features, label)]
    return train.select(*every).dropna()


def _rows(one: DataFrame, violations: dict[str, Column], coefficients: dict[str, float], bound: float) -> DataFrame:
    """The aggregate's one row as a row per term."""
    terms = [
        F.struct(F.lit(t).alias("term"), F.lit(float(coefficients[t])).alias("coefficient"), F.when(F.col("trips") > 0, v).alias("violation"))
        for t, v in violations.items()
    ]
    out = one.select("trips", F.explode(F.array(*terms)).alias("t")).select("t.term", "trips", "t.coefficient", "t.violation")
    return out.withColumn("optimal", F.coalesce(F.col("violation") <= bound, F.lit(False)))


def linear(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    coefficients: Sequence[float],
    intercept: float,
    reg: float,
    elastic: float,
    bound: float = BOUND,
) -> DataFrame:
    """``term, trips, coefficient, violation, optimal`` of an elastic net (features and label standardised by their
    population deviations in the objective, as the runtime does it)."""
    rows = _complete(train, features, label)
    aggregates = [F.count(F.lit(1)).alias("trips"), F.avg(label).alias("my"), F.stddev_pop(label).alias("sy")]
    for i, f in enumerate(features):
        aggregates += [F.avg(f).alias(f"m{i}"), F.stddev_pop(f).alias(f"s{i}"), F.covar_pop(f, label).alias(f"cy{i}")]
        aggregates += [F.covar_pop(f, g).alias(f"c{i}_{j}") for j, g in enumerate(features) if j >= i]
    one = rows.agg(*aggregates)
    c = F.col
    sy = c("sy")
    l1, l2 = F.lit(reg * elastic) / sy, F.lit(reg * (1 - elastic)) / sy
    violations: dict[str, Column] = {}
    for i, f in enumerate(features):
        beta = float(coefficients[i])
        fit = sum((F.lit(float(b)) * c(f"c{min(i, j)}_{max(i, j)}") for j, b in enumerate(coefficients)), F.lit(0.0))
        weight = F.lit(beta) * c(f"s{i}") / sy
        gradient = (fit - c(f"cy{i}")) / (c(f"s{i}") * sy) + l2 * weight
        off = F.abs(gradient + l1 * (1 if beta > 0 else -1)) if beta else F.greatest(F.lit(0.0), F.abs(gradient) - l1)
        violations[f] = F.when(c(f"s{i}") == 0, F.abs(F.lit(beta))).otherwise(off)
    mean = sum((F.lit(float(b)) * c(f"m{j}") for j, b in enumerate(coefficients)), F.lit(float(intercept)))
    violations[INTERCEPT] = F.abs(mean - c("my")) / sy
    return _rows(one, violations, dict(zip([*features, INTERCEPT], [*coefficients, intercept], strict=True)), bound)


def logistic(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    coefficients: Sequence[float],
    intercept: float,
    reg: float,
    bound: float = BOUND,
) -> DataFrame:
    """``term, trips, coefficient, violation, optimal`` of a two-class logistic model with an L2 penalty on the
    coefficients of features standardised by their sample deviations."""
    rows = _complete(train, features, label)
    margin = sum((F.lit(float(b)) * F.col(f) for f, b in zip(features, coefficients, strict=True)), F.lit(float(intercept)))
    rows = rows.withColumn("_residual", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col(label))
    aggregates = [F.count(F.lit(1)).alias("trips"), F.avg("_residual").alias("g")]
    for i, f in enumerate(features):
        aggregates += [F.avg(F.col("_residual") * F.col(f)).alias(f"g{i}"), F.stddev_samp(f).alias(f"s{i}")]
    one = rows.agg(*aggregates)
    violations: dict[str, Column] = {}
    for i, f in enumerate(features):
        beta, s = F.lit(float(coefficients[i])), F.col(f"s{i}")
        violations[f] = F.when(s == 0, F.abs(beta)).otherwise(F.abs(F.col(f"g{i}") / s + F.lit(reg) * beta * s))
    violations[INTERCEPT] = F.abs(F.col("g"))
    return _rows(one, violations, dict(zip([*features, INTERCEPT], [*coefficients, intercept], strict=True)), bound)
