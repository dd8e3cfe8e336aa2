"""Tree ensembles as one SQL expression: scoring without the ML runtime.

A saved forest or boosted ensemble is read from its own Parquet files (nodes and tree weights). Trees
over few features with binned thresholds are piecewise constant on a grid: the thresholds that any tree uses
cut each feature's axis, and inside a cell of the grid every tree gives the same leaf. So the ensemble is
evaluated once per cell on the driver, and scoring a row is to find its cell (a balanced CASE per feature)
and to look the cell up in a literal array: an expression without a join, a UDF or a broadcast, the same text in
Spark SQL and DuckDB but for the array functions. The grid is bounded by ``MAX_CELLS``; an ensemble beyond it
compiles to nested CASE expressions (``Ensemble.case_sql``), one per tree, which has no such bound.

Defined results: a row with a NULL feature has a NULL prediction (the runtime raises an error); NaN goes
right at every split, as in the runtime; ties between classes go to the smaller class.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells of a compiled grid, at most (the text of a cell is about 20 bytes).
MAX_CELLS = 250_000

# How the runtime combines its trees, by the class name in a saved model's metadata.
COMBINE = {
    "RandomForestRegressionModel": "mean",
    "GBTRegressionModel": "sum",
    "RandomForestClassificationModel": "vote",
    "GBTClassificationModel": "margin",
}


@dataclass(frozen=True)
class Tree:
    """Nodes in saved order: ``left`` and ``right`` are places of children, -1 at a leaf; rows with
    ``feature <= threshold`` go left. ``value``: what a leaf adds (a class share each for votes)."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # (node, outputs)
    weight: float

    def leaf_values(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = self.left[at] >= 0
            if not inner.any():
                return self.value[at]
            own = at[inner]
            goes_left = x[inner, self.feature[own]] <= self.threshold[own]
            at[inner] = np.where(goes_left, self.left[own], self.right[own])


@dataclass(frozen=True)
class Ensemble:
    combine: str  # mean, sum, vote or margin
    features: tuple[str, ...]
    trees: tuple[Tree, ...]

    @property
    def is_classifier(self) -> bool:
        return self.combine in ("vote", "margin")

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Regression value, share of votes of class 1, or margin, summed in the order of the trees."""
        total = np.zeros((len(x), self.trees[0].value.shape[1]))
        for t in self.trees:
            total += t.weight * t.leaf_values(x)
        if self.combine == "mean":
            return total[:, 0] / len(self.trees)
        if self.combine == "vote":
            return total[:, 1] / total.sum(1)
        return total[:, 0]

    def decide(self, score: np.ndarray) -> np.ndarray:
        """The prediction that belongs to a score."""
        if self.combine == "vote":
            return (score > 0.5).astype(float)
        return (score > 0).astype(float) if self.combine == "margin" else score

    def cuts(self) -> list[np.ndarray]:
        """Of each feature the thresholds that any tree uses, ascending."""
        every = [(t.feature[t.left >= 0], t.threshold[t.left >= 0]) for t in self.trees]
        feature, threshold = (np.concatenate(x) for x in zip(*every, strict=True))
        return [np.unique(threshold[feature == i]) for i in range(len(self.features))]

    def case_sql(self) -> str:
        """The score as a sum of nested CASE expressions (any SQL engine; not bounded by a grid)."""

        def node(t: Tree, i: int, output: int) -> str:
            if t.left[i] < 0:
                return _number(t.value[i, output])
            test = f"{self.features[t.feature[i]]} <= {_number(t.threshold[i])}"
            return f"CASE WHEN {test} THEN {node(t, t.left[i], output)} ELSE {node(t, t.right[i], output)} END"

        def total(output: int) -> str:
            return " + ".join(f"{_number(t.weight)} * ({node(t, 0, output)})" for t in self.trees)

        if self.combine == "vote":  # each tree's shares sum to 1
            score = f"({total(1)}) / {_number(sum(t.weight for t in self.trees))}"
        else:
            score = f"({total(0)})" + (f" / {_number(len(self.trees))}" if self.combine == "mean" else "")
        missing = " OR ".join(f"{f} IS NULL" for f in self.features)
        return f"CASE WHEN {missing} THEN NULL ELSE {score} END"


def _number(x: float) -> str:
    """A double literal that both engines read back to the same bits."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def load(spark: SparkSession, path: str, features: Sequence[str]) -> Ensemble:
    """The ensemble of a saved tree model (``path``: the model, or a pipeline whose last stage is one). The nodes
    are collected: a model fits in memory wherever it is used."""
    at = path.rstrip("/")
    meta = _metadata(spark, at)
    if meta["class"].endswith("PipelineModel"):
        stages = meta["paramMap"]["stageUids"]
        at = f"{at}/stages/{len(stages) - 1}_{stages[-1]}"
        meta = _metadata(spark, at)
    combine = COMBINE.get(meta["class"].rsplit(".", 1)[-1])
    if combine is None:
        raise ValueError(f"not a tree ensemble: {meta['class']}")
    if meta["numFeatures"] != len(features):
        raise ValueError(f"the model has {meta['numFeatures']} features, {len(features)} names were given")
    if combine == "vote" and meta["numClasses"] != 2:
        raise ValueError(f"a forest of {meta['numClasses']} classes: only two are supported")
    weights = {r[0]: r[1] for r in spark.read.parquet(f"{at}/treesMetadata").select("_1", "_3").collect()}
    nodes: dict[int, list] = {i: [] for i in weights}
    for r in spark.read.parquet(f"{at}/data").select("treeID", "nodeData.*").collect():
        nodes[r.treeID].append(r)
    return Ensemble(combine, tuple(features), tuple(_tree(nodes[i], weights[i], combine) for i in sorted(weights)))


def _metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()[0])


def _tree(rows: list, weight: float, combine: str) -> Tree:
    rows = sorted(rows, key=lambda r: r.id)
    place = {r.id: i for i, r in enumerate(rows)}
    if any(r.split.numCategories >= 0 for r in rows if r.leftChild >= 0):
        raise ValueError("categorical splits are not supported")
    if combine == "vote":
        value = np.array([r.impurityStats for r in rows], float)
        value /= value.sum(1, keepdims=True)
    else:
        value = np.array([[r.prediction] for r in rows], float)
    return Tree(
        np.array([r.split.featureIndex for r in rows], np.int64),
        np.array([r.split.leftCategoriesOrThreshold[0] if r.leftChild >= 0 else 0.0 for r in rows], float),
        np.array([place.get(r.leftChild, -1) for r in rows], np.int64),
        np.array([place.get(r.rightChild, -1) for r in rows], np.int64),
        value,
        float(weight),
    )


@dataclass(frozen=True)
class Compiled:
    """An ensemble on its grid: ``cuts`` of each feature, and the score of each cell (last feature fastest)."""

    ensemble: Ensemble
    cuts: tuple[np.ndarray, ...]
    score: np.ndarray

    def cell_sql(self) -> str:
        """The number of a row's cell, from 1."""
        parts, step = [], 1
        for name, cuts in reversed(list(zip(self.ensemble.features, self.cuts, strict=True))):
            parts.append(f"{step} * (CASE WHEN {name} IS NULL THEN NULL ELSE {_place(name, cuts, 0, len(cuts))} END)")
            step *= len(cuts) + 1
        return "1 + " + " + ".join(parts)

    def score_sql(self, dialect: str = "spark") -> str:
        return self._look_up(self.score, dialect)

    def prediction_sql(self, dialect: str = "spark") -> str:
        return self._look_up(self.ensemble.decide(self.score), dialect)

    def _look_up(self, values: np.ndarray, dialect: str) -> str:
        text = ",".join(repr(v) for v in values.tolist())
        if dialect == "duckdb":
            return f"list_extract(CAST(string_split('{text}', ',') AS DOUBLE[]), {self.cell_sql()})"
        return f"element_at(CAST(split('{text}', ',') AS ARRAY<DOUBLE>), {self.cell_sql()})"

    def prediction(self) -> Column:
        return F.expr(self.prediction_sql())

    def score_column(self) -> Column:
        return F.expr(self.score_sql())


def _place(name: str, cuts: np.ndarray, lo: int, hi: int) -> str:
    """How many cuts are below the value, by halving: ``cuts[lo:hi]`` are still open."""
    if lo == hi:
        return str(lo)
    mid = (lo + hi) // 2
    return f"CASE WHEN {name} <= {_number(cuts[mid])} THEN {_place(name, cuts, lo, mid)} ELSE {_place(name, cuts, mid + 1, hi)} END"


def bin_sql(name: str, cuts: Sequence[float]) -> str:
    """The number of a value's bin as a double, from 1: one more than the cuts below it. NULL for NULL and NaN."""
    return f"CASE WHEN {name} IS NULL OR isnan({name}) THEN NULL ELSE CAST(1 + {_place(name, cuts, 0, len(cuts))} AS DOUBLE) END"


def compile_ensemble(ensemble: Ensemble, max_cells: int = MAX_CELLS) -> Compiled:
    """The ensemble on its grid. Raises ``ValueError`` beyond ``max_cells`` (use ``case_sql`` then)."""
    cuts = ensemble.cuts()
    cells = int(np.prod([len(c) + 1 for c in cuts], dtype=object))
    if cells > max_cells:
        raise ValueError(f"{cells} cells, more than {max_cells}")
    # A cell (c[i-1], c[i]] is stood for by its upper cut, the last one by infinity.
    axes = [np.append(c, np.inf) for c in cuts]
    points = np.stack([m.ravel() for m in np.meshgrid(*axes, indexing="ij")], axis=1)
    return Compiled(ensemble, tuple(cuts), ensemble.scores(points))


def with_prediction(df: DataFrame, ensemble: Ensemble, name: str = "prediction") -> DataFrame:
    """``df`` with the ensemble's prediction, by the grid where it is small enough, else by nested CASEs."""
    try:
        return df.withColumn(name, compile_ensemble(ensemble).prediction())
    except ValueError:
        score = F.expr(ensemble.case_sql())
        if ensemble.combine == "vote":
            score = F.when(score.isNotNull(), (score > 0.5).cast("double"))
        elif ensemble.combine == "margin":
            score = F.when(score.isNotNull(), (score > 0).cast("double"))
        return df.withColumn(name, score)


def agreement(scored: DataFrame, by: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """Per group of ``by``: ``trips``, and how many have the same ``prediction`` (of the runtime) and ``compiled``
    (to a relative ``tolerance``; two NULLs agree)."""
    p, c = F.col("prediction"), F.col("compiled")
    near = F.abs(p - c) <= F.lit(tolerance) * F.greatest(F.abs(p), F.lit(1.0))
    close = p.eqNullSafe(c) | F.coalesce(near, F.lit(False))
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("trips"), F.count_if(close).alias("agreeing"))
