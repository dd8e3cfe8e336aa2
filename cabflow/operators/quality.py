"""Cleaning: deterministic dedup, default fill, ordered validation, good/bad split, stats.

Scale notes
-----------
* Dedup is an aggregation on the key, not a window: ``min(struct(other columns))``
  picks the same survivor on every run (lexicographic minimum, NULLs first) and the
  partial aggregate collapses a hot key on the map side before the shuffle, so a key
  that holds a third of the rows never lands whole in one task.
* The aggregate leaves the output hash-partitioned on the key, which the following
  full outer join on the same key reuses (no second exchange).
* Stats come from one ``groupBy(rejection_reason)`` over the tagged rows; the row
  count before dedup is carried through the dedup as a per-key multiplicity, so no
  separate pass over the raw feed is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.rules import (
    FARE_RULES,
    TRIP_DEFAULTS,
    TRIP_RULES,
    VALID,
    fare_rejection_reason,
    trip_rejection_reason,
)
from cabflow.schemas import KEY

REASON = "rejection_reason"
MULTIPLICITY = "_rows"


def dedup(df: DataFrame, key: Sequence[str] = KEY, multiplicity: str | None = None) -> DataFrame:
    """One row per key (NULL keys group together); the survivor is the row whose
    remaining columns are smallest in column order with NULLs first.

    ``multiplicity`` names an optional column holding the number of input rows of the key.
    """
    key = list(key)
    others = [c for c in df.columns if c not in key]
    aggs: list[Column] = []
    if others:
        aggs.append(F.min(F.struct(*[F.col(c) for c in others])).alias("_keep"))
    if multiplicity:
        aggs.append(F.count(F.lit(1)).alias(multiplicity))
    if not aggs:
        return df.select(*key).distinct()
    out = df.groupBy(*key).agg(*aggs)
    cols = [F.col(c) if c in key else F.col(f"_keep.{c}").alias(c) for c in df.columns]
    if multiplicity:
        cols.append(F.col(multiplicity))
    return out.select(*cols)


def fill_defaults(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    return df.fillna(dict(TRIP_DEFAULTS if defaults is None else defaults))


def tag_trips(df: DataFrame) -> DataFrame:
    """Dedup -> default fill -> ``rejection_reason`` (first failing trip rule or VALID)."""
    return fill_defaults(df).withColumn(REASON, trip_rejection_reason())


def tag_fares(df: DataFrame) -> DataFrame:
    return df.withColumn(REASON, fare_rejection_reason())


def validated_trips(raw: DataFrame, multiplicity: str | None = None) -> DataFrame:
    return tag_trips(dedup(raw, multiplicity=multiplicity))


def validated_fares(raw: DataFrame, multiplicity: str | None = None) -> DataFrame:
    return tag_fares(dedup(raw, multiplicity=multiplicity))


def split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, bad rows with it)."""
    cols = [c for c in tagged.columns if c != MULTIPLICITY]
    good = tagged.filter(F.col(REASON) == VALID).select(*[c for c in cols if c != REASON])
    bad = tagged.filter(F.col(REASON) != VALID).select(*cols)
    return good, bad


def reject_stats(tagged_with_multiplicity: DataFrame, source: str) -> DataFrame:
    """Long stats table ``source, metric, value``: ``total_records`` (rows before dedup),
    ``rejected_records`` (rejected rows after dedup) and one row per rejection reason.
    One aggregate over the tagged rows; the reshaping runs on at most a handful of rows.
    """
    per_reason = tagged_with_multiplicity.groupBy(REASON).agg(
        F.sum(MULTIPLICITY).alias("raw_rows"), F.count(F.lit(1)).alias("rows")
    )
    totals = per_reason.agg(
        F.coalesce(F.sum("raw_rows"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum(F.when(F.col(REASON) != VALID, F.col("rows"))), F.lit(0))
        .cast("bigint")
        .alias("rejected_records"),
    )
    total_rows = totals.select(
        F.lit(source).alias("source"),
        F.explode(
            F.array(
                F.struct(F.lit("total_records").alias("metric"), F.col("total_records").alias("value")),
                F.struct(F.lit("rejected_records").alias("metric"), F.col("rejected_records").alias("value")),
            )
        ).alias("m"),
    ).select("source", "m.metric", "m.value")
    reason_rows = per_reason.filter(F.col(REASON) != VALID).select(
        F.lit(source).alias("source"),
        F.col(REASON).alias("metric"),
        F.col("rows").cast("bigint").alias("value"),
    )
    return total_rows.unionByName(reason_rows)


def observe_stats(tagged_with_multiplicity: DataFrame, name: str, rules=None) -> tuple[DataFrame, Observation]:
    """Attach the reject stats to ``tagged`` as named metrics, so they are collected by
    whatever action writes it (no extra pass). The reasons are the fixed rule list, so
    each one is a ``count_if``; read the result with ``stats_from_observation``."""
    rules = rules if rules is not None else (TRIP_RULES if "trip" in name else FARE_RULES)
    obs = Observation(name)
    reason = F.col(REASON)
    metrics = [
        F.coalesce(F.sum(MULTIPLICITY), F.lit(0)).cast("bigint").alias("total_records"),
        F.count_if(reason != VALID).cast("bigint").alias("rejected_records"),
        *[F.count_if(reason == r).cast("bigint").alias(r) for r, _ in rules],
    ]
    return tagged_with_multiplicity.observe(obs, *metrics), obs


def stats_from_observation(spark: SparkSession, obs: Observation, source: str) -> DataFrame:
    """The observed metrics as the same long table ``reject_stats`` returns (reasons with
    zero rows are left out, as a group-by would)."""
    m = obs.get
    rows = [(source, "total_records", int(m["total_records"])), (source, "rejected_records", int(m["rejected_records"]))]
    rows += [(source, k, int(v)) for k, v in m.items() if k not in ("total_records", "rejected_records") and v]
    return spark.createDataFrame(rows, "source string, metric string, value bigint")
