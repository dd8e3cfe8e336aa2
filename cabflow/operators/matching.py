"""Matching valid trips with valid fares on the composite key (full outer join).

The match class follows the reference's value tests, not key presence:

* ``matched``     trip ``dropoff_datetime`` and fare ``total_amount`` both non-NULL
* ``trip_only``   dropoff non-NULL, total NULL (also a pair whose total is NULL)
* ``fare_only``   dropoff NULL, total non-NULL
* ``incomplete``  both NULL - rows the reference silently loses; kept so classes sum up

The three outputs use the plain NULL predicates, so Catalyst rewrites the full outer
join to Inner / LeftOuter / RightOuter for each of them. Both sides arrive
hash-partitioned on the key from the dedup aggregate, so the sort-merge join adds
no exchange of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cabflow.schemas import KEY

MATCHED = "matched"
TRIP_ONLY = "trip_only"
FARE_ONLY = "fare_only"
INCOMPLETE = "incomplete"


def full_outer(trips: DataFrame, fares: DataFrame) -> DataFrame:
    """``USING (key)`` full outer join; key columns are coalesced from both sides.

    Aliases ``t`` and ``f`` stay addressable (``t.*`` / ``f.*``).
    """
    return trips.alias("t").join(fares.alias("f"), KEY, "full_outer")


def _has_trip() -> Column:
    return F.col("t.dropoff_datetime").isNotNull()


def _has_fare() -> Column:
    return F.col("f.total_amount").isNotNull()


def match_class() -> Column:
    return (
        F.when(_has_trip() & _has_fare(), F.lit(MATCHED))
        .when(_has_trip(), F.lit(TRIP_ONLY))
        .when(_has_fare(), F.lit(FARE_ONLY))
        .otherwise(F.lit(INCOMPLETE))
    )


def matched(joined: DataFrame, trips: DataFrame, fares: DataFrame) -> DataFrame:
    """Key + trip value columns + fare value columns (21 columns)."""
    t_vals = [c for c in trips.columns if c not in KEY]
    f_vals = [c for c in fares.columns if c not in KEY]
    return joined.filter(_has_trip() & _has_fare()).select(
        *KEY, *[F.col(f"t.{c}") for c in t_vals], *[F.col(f"f.{c}") for c in f_vals]
    )


def trips_without_fare(joined: DataFrame) -> DataFrame:
    return joined.filter(_has_trip() & ~_has_fare()).select("t.*")


def fares_without_trip(joined: DataFrame) -> DataFrame:
    return joined.filter(~_has_trip() & _has_fare()).select("f.*")


def incomplete(joined: DataFrame) -> DataFrame:
    return joined.filter(~_has_trip() & ~_has_fare()).select(*KEY)


def match(trips: DataFrame, fares: DataFrame) -> dict[str, DataFrame]:
    """All outputs of one match, lazily; they share the same join plan."""
    joined = full_outer(trips, fares)
    return {
        MATCHED: matched(joined, trips, fares),
        TRIP_ONLY: trips_without_fare(joined),
        FARE_ONLY: fares_without_trip(joined),
        INCOMPLETE: incomplete(joined),
    }


def match_stats(trips: DataFrame, fares: DataFrame) -> DataFrame:
    """One aggregate over the join: inputs per side and rows per match class."""
    t = trips.withColumn("_t", F.lit(1))
    f = fares.withColumn("_f", F.lit(1))
    joined = full_outer(t, f).withColumn("_class", match_class())

    def n_class(name: str) -> Column:
        return F.count_if(F.col("_class") == name).cast("bigint")

    return joined.agg(
        F.count("t._t").cast("bigint").alias("valid_trips_for_join"),
        F.count("f._f").cast("bigint").alias("valid_fares_for_join"),
        n_class(MATCHED).alias("matched_records"),
        n_class(TRIP_ONLY).alias("trips_without_fare"),
        n_class(FARE_ONLY).alias("fares_without_trip"),
        n_class(INCOMPLETE).alias("incomplete_records"),
    )


def unmatched_union(trips_only: DataFrame, fares_only: DataFrame) -> DataFrame:
    """Trips without fare and fares without trip in one table, tagged by ``source``;
    columns missing on one side are NULL (bag union by name)."""
    return trips_only.withColumn("source", F.lit("trip_data")).unionByName(
        fares_only.withColumn("source", F.lit("fare_data")), allowMissingColumns=True
    )


STAT_NAMES = ["valid_trips_for_join", "valid_fares_for_join", "matched_records", "trips_without_fare",
              "fares_without_trip", "incomplete_records"]


def unmatched_with_stats(trips: DataFrame, fares: DataFrame) -> tuple[DataFrame, Observation]:
    """The unmatched table (same rows and columns as ``unmatched_union``) from ONE full
    outer join pass, with the match stats observed on that pass.

    Trip-only rows keep the trip side's columns and NULL fare columns (what ``t.*`` in a
    union gives), fare-only rows the reverse; for those rows the coalesced key equals the
    side's own key. The stats are read with ``stats_from_observation`` after the write."""
    t = trips.withColumn("_t", F.lit(1))
    f = fares.withColumn("_f", F.lit(1))
    cls = F.col("_class")
    joined = full_outer(t, f).withColumn("_class", match_class())
    obs = Observation("match")
    joined = joined.observe(
        obs,
        F.count("t._t").cast("bigint").alias("valid_trips_for_join"),
        F.count("f._f").cast("bigint").alias("valid_fares_for_join"),
        F.count_if(cls == MATCHED).cast("bigint").alias("matched_records"),
        F.count_if(cls == TRIP_ONLY).cast("bigint").alias("trips_without_fare"),
        F.count_if(cls == FARE_ONLY).cast("bigint").alias("fares_without_trip"),
        F.count_if(cls == INCOMPLETE).cast("bigint").alias("incomplete_records"),
    )
    fare_only_cols = [c for c in fares.columns if c not in KEY]
    out = joined.filter(cls.isin(TRIP_ONLY, FARE_ONLY)).select(
        *KEY,
        *[F.when(cls == TRIP_ONLY, F.col(f"t.{c}")).alias(c) for c in trips.columns if c not in KEY],
        F.when(cls == TRIP_ONLY, F.lit("trip_data")).otherwise(F.lit("fare_data")).alias("source"),
        *[F.when(cls == FARE_ONLY, F.col(f"f.{c}")).alias(c) for c in fare_only_cols],
    )
    return out, obs


def stats_from_observation(spark: SparkSession, obs: Observation) -> DataFrame:
    """The observed match stats as the one-row table ``match_stats`` returns."""
    m = obs.get
    return spark.createDataFrame([tuple(int(m[n]) for n in STAT_NAMES)], ", ".join(f"{n} bigint" for n in STAT_NAMES))
