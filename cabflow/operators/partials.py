"""The profile and the KPI tables from per-day partials, so that a changed day costs a read of that day alone.

Everything the profile needs of a day can be merged: counts, sums, minima and maxima, the sum of squared deviations (by
the day's own mean) and a KLL sketch of the values, one row per day and column; for the KPI tables likewise one row per day
and group. ``refresh`` compares the files of each day of the processed layout with those its partials were made from, reads
the days that differ, and appends their partials as one *run*. ``numeric_stats`` and ``kpi_grouping_sets`` merge what is current.

A state table names the run that holds each day; it is written as a new version after the partials, and readers take
the newest version that is complete. So a run that dies half-way changes nothing, and days that were replaced or have
gone are simply no longer named; their runs are deleted once none of their days is.

The driver holds one entry per calendar day. Quantiles are those of the merged sketches: their rank is within
``RANK_ERROR`` of the exact one (groups of a few hundred rows are exact but for the choice of neighbour).

Defined results: days without rows do not exist; a column or measure that is NULL in all rows gives NULL statistics and
count 0; no days give no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators import kpis, profile
from cabflow.operators.enrich import analytics_base
from cabflow.session import configured, remove_path
from cabflow.sources import feeds

#: Size of the KLL sketches, and the rank error (of the row count) that is promised for it.
SKETCH_K, RANK_ERROR = 1200, 0.01
#: Measures of the KPI tables that are averages.
AVERAGED = ["total_amount", "cost_per_km", "cost_per_min", "avg_speed_kmh"]
DAY = "of_day"
# Groups (a day and a column, or a day and a segment's group) whose sketches a task holds at once: some 30 kB each
# at most. Spark's default of 128 is passed by a few days; each task then sorts its rows by group, thirteen to a trip.
GROUPS_IN_MEMORY = 4096
_FALLBACK = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
_DAY_DIR = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)/([^/]+)$")


def _day() -> Column:
    return F.make_date("year", "month", "day").alias(DAY)


# ---- partials of the days in a table ---------------------------------------------------------------


def numeric_partials(base: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """One row per day and profiled column."""
    columns = profile.numeric_columns(base)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    long = base.select(_day(), F.col(ts).alias("_ts"), F.explode(pairs).alias("e")).select(DAY, "_ts", "e.column", "e.v")
    return long.groupBy(DAY, "column").agg(
        F.count(F.lit(1)).alias("trips"),
        F.min("_ts").alias("first_ts"),
        F.max("_ts").alias("last_ts"),
        F.count("v").alias("n"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        F.sum("v").alias("sum"),
        F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("m2"),
        F.kll_sketch_agg_double("v", SKETCH_K).alias("sketch"),
    )


def kpi_partials(base: DataFrame) -> DataFrame:
    """One row per day, segmentation and group."""
    measures = F.struct(*[F.col(c).cast("double").alias(c) for c in AVERAGED]).alias("m")
    rows, keys = kpis.segment_rows(base.select("*", measures, _day()).withColumn("_v", F.struct(DAY, "m")), "_v")
    rows = rows.select(*keys, F.col(f"_v.{DAY}").alias(DAY), "_v.m")
    return rows.groupBy(DAY, *keys).agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.count(f"m.{c}").alias(f"n_{c}") for c in AVERAGED],
        *[F.sum(f"m.{c}").alias(f"sum_{c}") for c in AVERAGED],
        F.kll_sketch_agg_double("m.total_amount", SKETCH_K).alias("sketch"),
    )


# ---- the store ---------------------------------------------------------------------------------------


def day_digests(processed: DataFrame) -> dict[date, str]:
    """A digest of the file names of each day (a rewritten day has other names)."""
    names: dict[date, list[str]] = {}
    for path in processed.inputFiles():
        found = _DAY_DIR.search(path)
        if found:
            names.setdefault(date(*map(int, found.groups()[:3])), []).append(found[4])
    return {d: hashlib.sha256("\n".join(sorted(x)).encode()).hexdigest() for d, x in names.items()}


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of the state, ascending."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(f"{root}/state")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop.Path(f"{root}/state/version=*/_SUCCESS")) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def current_state(spark: SparkSession, root: str) -> dict[date, tuple[str, str]]:
    """Day -> (digest of its files, run that holds its partials)."""
    versions = _versions(spark, root)
    if not versions:
        return {}
    rows = spark.read.parquet(f"{root}/state/version={versions[-1]}").collect()
    return {r[DAY]: (r.digest, r.run) for r in rows}


def refresh(spark: SparkSession, processed_root: str, root: str) -> list[date]:
    """Bring the partials under ``root`` up to date with the processed layout; returns the days that were read."""
    root = root.rstrip("/")
    trips = feeds.load_processed(spark, processed_root)
    now, before = day_digests(trips), current_state(spark, root)
    changed = sorted(d for d in now if before.get(d, ("", ""))[0] != now[d])
    if not changed and before.keys() == now.keys():
        return []
    run = uuid.uuid4().hex[:12]
    if changed:
        some = trips if len(changed) == len(now) else trips.filter(F.make_date("year", "month", "day").isin(changed))
        base = analytics_base(some)
        with configured(spark, {_FALLBACK: str(GROUPS_IN_MEMORY)}):
            numeric_partials(base).write.parquet(f"{root}/numeric/run={run}")
            kpi_partials(base).write.parquet(f"{root}/kpi/run={run}")
    state = [(d, now[d], run if d in set(changed) else before[d][1]) for d in sorted(now)]
    version = (_versions(spark, root) or [0])[-1] + 1
    rows = spark.createDataFrame(state, f"{DAY} date, digest string, run string").repartition(1)
    rows.write.mode("overwrite").parquet(f"{root}/state/version={version}")
    for gone in {r for _, r in before.values()} - {r for _, _, r in state}:
        for kind in ("numeric", "kpi"):
            remove_path(spark, f"{root}/{kind}/run={gone}")
    return changed


def _current(spark: SparkSession, root: str, kind: str) -> DataFrame | None:
    """The partials of each day from the run that is current for it."""
    root = root.rstrip("/")
    state = current_state(spark, root)
    runs = sorted({run for _, run in state.values()})
    if not runs:
        return None
    named = spark.createDataFrame([(d, run) for d, (_, run) in state.items()], f"{DAY} date, _run string")
    parts = None
    for run in runs:
        part = spark.read.parquet(f"{root}/{kind}/run={run}").withColumn("_run", F.lit(run))
        parts = part if parts is None else parts.unionByName(part)
    return parts.join(F.broadcast(named), [DAY, "_run"]).drop("_run")  # a row per calendar day


# ---- merged tables -----------------------------------------------------------------------------------


def _quantile(p: float) -> Column:
    return F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(p))))


def numeric_stats(spark: SparkSession, root: str) -> DataFrame:
    """The table of ``profile.numeric_stats`` from the partials."""
    parts = _current(spark, root, "numeric")
    if parts is None:
        return spark.createDataFrame([], profile.STATS_DDL)
    total = parts.groupBy("column").agg(
        F.sum("n").alias("_n"), F.sum("trips").alias("_trips"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("sum").alias("sum"), F.kll_merge_agg_double("sketch").alias("_sketch"),
    )
    total = total.withColumn("mean", F.when(F.col("_n") > 0, F.col("sum") / F.col("_n")))
    # Squared deviations from the whole mean: those within the days, and those of the days' means (few rows).
    off = parts.select("column", "n", "mean", "m2").join(total.select("column", F.col("mean").alias("_mean")), "column")
    off = off.groupBy("column").agg(F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2).alias("_m2"))
    listed = spark.createDataFrame([(i, c) for i, c in enumerate(profile.PROFILE_COLUMNS)], "_i int, column string")
    return (
        total.join(off, "column", "left").join(F.broadcast(listed), "column").orderBy("_i")
        .select(
            "column", F.col("_n").alias("count"), (F.col("_trips") - F.col("_n")).alias("null_count"), "min", "max", "mean",
            F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1))).alias("stddev"), "sum",
            *[_quantile(p).alias(n) for n, p in zip(profile.QUANTILE_NAMES, profile.QUANTILE_PROBS, strict=True)],
        )
    )


def overview(spark: SparkSession, root: str) -> DataFrame:
    """``row_count, min_pickup_datetime, max_pickup_datetime`` from the partials (of one column: all count every row)."""
    parts = _current(spark, root, "numeric")
    if parts is None:
        return spark.createDataFrame([(0, None, None)], "row_count bigint, min_pickup_datetime string, max_pickup_datetime string")
    one = parts.filter(F.col("column") == profile.PROFILE_COLUMNS[0])
    return one.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("row_count"),
        F.min("first_ts").cast("string").alias("min_pickup_datetime"),
        F.max("last_ts").cast("string").alias("max_pickup_datetime"),
    )


def kpi_grouping_sets(spark: SparkSession, root: str) -> DataFrame | None:
    """The table of ``kpis.kpi_grouping_sets`` from the partials (None without any day)."""
    parts = _current(spark, root, "kpi")
    if parts is None:
        return None
    keys = [c for c in parts.columns if c not in (DAY, "trips", "sketch") and not c.startswith(("n_", "sum_"))]
    merged = parts.groupBy(*keys).agg(
        F.sum("trips").alias("trips"), F.kll_merge_agg_double("sketch").alias("_sketch"),
        *[F.sum(c).alias(c) for c in parts.columns if c.startswith(("n_", "sum_"))],
    ).withColumn("_n", F.col("n_total_amount"))
    group_cols = [k for k in keys if k != "segment"]
    gid = F.lit(None).cast("int")
    for name, cols in kpis.SEGMENTS.items():
        gid = F.when(F.col("segment") == name, F.lit(kpis._gid_of(cols, group_cols))).otherwise(gid)

    def mean(c: str) -> Column:
        return F.when(F.col(f"n_{c}") > 0, F.col(f"sum_{c}") / F.col(f"n_{c}"))

    return merged.select(
        "segment", gid.alias("grouping_id"), *group_cols,
        mean("total_amount").alias("avg_total_amount"),
        *[_quantile(p).alias(n) for n, p in kpis.PERCENTILES],
        mean("cost_per_km").alias("avg_cost_per_km"), mean("cost_per_min").alias("avg_cost_per_min"),
        mean("avg_speed_kmh").alias("avg_speed_kmh"), "trips", F.col("sum_total_amount").alias("revenue"),
    )
