"""Segmented KPIs: the same measure set per segmentation, and all six segmentations
in one ``GROUPING SETS`` pass (one scan, one shuffle) instead of six group-bys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.operators.quantiles import attach, grouped_exact_quantiles, kept
from cabflow.session import remove_path, scratch_dir

# Segment name -> grouping columns, in report order.
SEGMENTS: dict[str, list[str]] = {
    "kpi_by_hour": ["pickup_hour"],
    "kpi_by_dow": ["pickup_dow"],
    "kpi_by_year_month": ["year", "month"],
    "kpi_by_payment": ["payment_type"],
    "kpi_by_vendor": ["vendor_id"],
    "kpi_by_passengers": ["passenger_count"],
}

# Default accuracy of ``percentile_approx`` (relative rank error 1/accuracy).
PERCENTILE_ACCURACY = 10000


def kpi_measures(accuracy: int = PERCENTILE_ACCURACY) -> list[Column]:
    """Mean/median/p95 total, mean cost per km and per minute, mean speed, trips, revenue.
    Percentiles are bounded-memory sketches (``percentile_approx``), never a buffered
    per-group value list."""
    return [
        F.avg("total_amount").alias("avg_total_amount"),
        F.percentile_approx("total_amount", 0.5, accuracy).alias("p50_total_amount"),
        F.percentile_approx("total_amount", 0.95, accuracy).alias("p95_total_amount"),
        F.avg("cost_per_km").alias("avg_cost_per_km"),
        F.avg("cost_per_min").alias("avg_cost_per_min"),
        F.avg("avg_speed_kmh").alias("avg_speed_kmh"),
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("revenue"),
    ]


PERCENTILES = [("p50_total_amount", 0.5), ("p95_total_amount", 0.95)]
MEASURE_ORDER = ["avg_total_amount", "p50_total_amount", "p95_total_amount", "avg_cost_per_km",
                 "avg_cost_per_min", "avg_speed_kmh", "trips", "revenue"]
# Columns that the measures read.
MEASURED = ["total_amount", "cost_per_km", "cost_per_min", "avg_speed_kmh"]


def _exact_percentiles(agg: DataFrame, df: DataFrame, group_cols: list[str]) -> DataFrame:
    """Replace the sketch percentiles of ``agg`` by exact ones (``operators.quantiles``)."""
    q = grouped_exact_quantiles(df, group_cols, "total_amount", [p for _, p in PERCENTILES],
                                [n for n, _ in PERCENTILES])
    base = agg.drop(*[n for n, _ in PERCENTILES])
    out = attach(base, q, group_cols, [n for n, _ in PERCENTILES])
    lead = [c for c in agg.columns if c not in MEASURE_ORDER]
    return out.select(*lead, *MEASURE_ORDER)


def segmented_kpis(df: DataFrame, accuracy: int = PERCENTILE_ACCURACY, exact: bool = False,
                   only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """One group-by per segmentation (``only``: of those named) whose columns exist in ``df``.

    ``exact=False`` (default): lazy, percentiles from the bounded sketch, as the reference.
    ``exact=True``: percentiles are the exact rank-``ceil(p*n)`` values (see
    ``operators.quantiles``). Their rounds run when called, so ``df`` is computed once: the
    columns read are staged, and removed once every segment's rows are there."""
    segs = {n: cols for n, cols in SEGMENTS.items()
            if all(c in df.columns for c in cols) and (only is None or n in only)}
    if not exact:
        return {n: df.groupBy(*cols).agg(*kpi_measures(accuracy)) for n, cols in segs.items()}
    spark = df.sparkSession
    keys = [c for c in _all_group_cols() if any(c in cols for cols in segs.values())]
    path = scratch_dir(spark, "kpi-rows")
    try:
        rows = kept(df.select(*keys, *MEASURED), path)
        return {n: kept(_exact_percentiles(rows.groupBy(*cols).agg(*kpi_measures(accuracy)), rows, cols), scratch_dir(spark, "kpis"))
                for n, cols in segs.items()}
    finally:
        remove_path(spark, path)


def kpi_grouping_sets(df: DataFrame, accuracy: int = PERCENTILE_ACCURACY, exact: bool = False, staged: bool = False) -> DataFrame:
    """All segmentations in one aggregate. Columns: ``segment`` (name), ``grouping_id``,
    every grouping column (NULL where not grouped) and the measures. ``grouping_id`` keeps
    a real NULL segment value apart from a rolled-up column. With ``exact`` the
    percentiles of all segments come from ONE rank pass over the ``(segment, value)``
    rows. Their rounds run when called, so ``df`` is computed once: the columns read are staged (not if it is a scan of
    ``staged`` files already), the ``(segment, value)`` rows are made from them by each round, and the result is kept."""
    if exact and not staged:
        path = scratch_dir(df.sparkSession, "kpi-rows")
        try:
            rows = kept(df.select(*columns_read(df)), path)
            return kept(kpi_grouping_sets(rows, accuracy, True, True), scratch_dir(df.sparkSession, "kpis"))
        finally:
            remove_path(df.sparkSession, path)
    segs = {n: cols for n, cols in SEGMENTS.items() if all(c in df.columns for c in cols)}
    group_cols: list[str] = []
    for cols in segs.values():
        group_cols += [c for c in cols if c not in group_cols]
    sets = ", ".join("(" + ", ".join(cols) + ")" for cols in segs.values())
    measures = ",\n  ".join(
        [
            "avg(total_amount) AS avg_total_amount",
            f"percentile_approx(total_amount, 0.5, {accuracy}) AS p50_total_amount",
            f"percentile_approx(total_amount, 0.95, {accuracy}) AS p95_total_amount",
            "avg(cost_per_km) AS avg_cost_per_km",
            "avg(cost_per_min) AS avg_cost_per_min",
            "avg(avg_speed_kmh) AS avg_speed_kmh",
            "count(1) AS trips",
            "sum(total_amount) AS revenue",
        ]
    )
    gid = f"grouping_id({', '.join(group_cols)})"
    seg_case = "CASE " + " ".join(
        f"WHEN {gid} = {_gid_of(cols, group_cols)} THEN '{n}'" for n, cols in segs.items()
    ) + " END"
    g = ", ".join(group_cols)
    agg = df.sparkSession.sql(
        f"SELECT {seg_case} AS segment, CAST({gid} AS INT) AS grouping_id, {g},\n  {measures}\n"
        f"FROM {{src}} GROUP BY GROUPING SETS ({sets})",
        src=df,
    )
    if not exact:
        return agg
    rows, keys = segment_rows(df)
    q = grouped_exact_quantiles(rows, keys, "total_amount", [p for _, p in PERCENTILES], [n for n, _ in PERCENTILES], True)
    out = attach(agg.drop(*[n for n, _ in PERCENTILES]), q, keys, [n for n, _ in PERCENTILES])
    return out.select("segment", "grouping_id", *group_cols, *MEASURE_ORDER)


def columns_read(df: DataFrame) -> list[str]:
    """The columns of ``df`` that the segmentations and their measures read."""
    return [c for c in _all_group_cols() if c in df.columns] + MEASURED


def segment_rows(df: DataFrame, value: str = "total_amount") -> tuple[DataFrame, list[str]]:
    """One row per (segment, input row): ``segment``, its grouping values (others NULL) and the
    value; and the names of the key columns."""
    segs = {n: cols for n, cols in SEGMENTS.items() if all(c in df.columns for c in cols)}
    group_cols = [c for c in _all_group_cols() if any(c in cols for cols in segs.values())]
    rows = df.select(
        F.col(value),
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("segment"), *[(F.col(c) if c in cols else F.lit(None).cast(df.schema[c].dataType)).alias(c)
                                                  for c in group_cols])
            for n, cols in segs.items()
        ])).alias("_s"),
    ).select("_s.*", value)
    return rows, ["segment", *group_cols]


def _gid_of(cols: list[str], group_cols: list[str]) -> int:
    """``grouping_id`` value of a grouping set: bit set for every column NOT grouped,
    first column is the most significant bit."""
    n = len(group_cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(group_cols) if c not in cols)


def kpi_segment(grouped: DataFrame, segment: str) -> DataFrame:
    """One segmentation out of ``kpi_grouping_sets`` (same columns as ``segmented_kpis``)."""
    cols = SEGMENTS[segment]
    measures = [m for m in grouped.columns if m not in ("segment", "grouping_id") and m not in _all_group_cols()]
    return grouped.filter(F.col("segment") == segment).select(*cols, *measures)


def _all_group_cols() -> list[str]:
    out: list[str] = []
    for cols in SEGMENTS.values():
        out += [c for c in cols if c not in out]
    return out


def kpi_summary_long(
    overview: DataFrame, numeric: DataFrame, grouped: DataFrame
) -> DataFrame:
    """The summary report as one long table ``section, segment, metric, value`` (text):
    money-like measures (name has amount/cost/revenue) with 2 decimals, counts as
    integers, other numbers with 4 decimals, NULL as empty text. Sections:
    OVERVIEW, NUMERIC_STATISTICS, then one per KPI segmentation."""
    def fmt(col: str) -> Column:
        v = F.col(col)
        if col in ("trips", "count", "null_count", "row_count"):
            s = v.cast("bigint").cast("string")
        elif any(k in col for k in ("amount", "cost", "revenue")) or col == "sum":
            s = F.format_string("%.2f", v.cast("double"))
        else:
            s = F.format_string("%.4f", v.cast("double"))
        return F.coalesce(s, F.lit(""))

    ov = overview.select(
        F.lit("OVERVIEW").alias("section"),
        F.lit("").alias("segment"),
        F.explode(
            F.array(
                F.struct(F.lit("row_count").alias("metric"), F.col("row_count").cast("string").alias("value")),
                F.struct(F.lit("min_pickup_datetime").alias("metric"),
                         F.coalesce(F.col("min_pickup_datetime").cast("string"), F.lit("")).alias("value")),
                F.struct(F.lit("max_pickup_datetime").alias("metric"),
                         F.coalesce(F.col("max_pickup_datetime").cast("string"), F.lit("")).alias("value")),
            )
        ).alias("m"),
    ).select("section", "segment", "m.metric", "m.value")

    stat_cols = [c for c in numeric.columns if c != "column"]
    num = numeric.select(
        F.lit("NUMERIC_STATISTICS").alias("section"),
        F.col("column").alias("segment"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), fmt(c).alias("value")) for c in stat_cols])).alias("m"),
    ).select("section", "segment", "m.metric", "m.value")

    group_cols = _all_group_cols()
    measures = [m for m in grouped.columns if m not in ("segment", "grouping_id") and m not in group_cols]
    # All segments in one pass over ``grouped``: the label depends on the segment of the row.
    label = F.lit(None).cast("string")
    for name, cols in SEGMENTS.items():
        own = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
        label = F.when(F.col("segment") == name, own).otherwise(label)
    kpi = grouped.select(
        F.upper("segment").alias("section"),
        label.alias("segment"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), fmt(m).alias("value")) for m in measures])).alias("m"),
    ).select("section", "segment", "m.metric", "m.value")
    return ov.unionByName(num).unionByName(kpi)
