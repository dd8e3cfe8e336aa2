"""Registered queries: one Spark callable per operator of the inventory, paired with its
DuckDB oracle where one exists. Every query starts from the driver's tables (through
the fixture mapping) and runs over them whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cabflow.functions import features as fx
from cabflow.operators import certificates, enrich, matching, partials, quality, quantiles, questions, tree_sql
from cabflow.operators.enrich import analytics_base
from cabflow.plans import flow
from cabflow.plans.oracle import FARE_COLS, FARE_VALS, MATCHED_COLS, TRIP_COLS, q, r
from cabflow.schemas import KEY, TRIP_SCHEMA
from cabflow.session import remove_path, scratch_dir
from cabflow.sinks import writers
from cabflow.sources import dims, feeds, fixtures, headers, malformed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Outputs that are large sums get fewer decimals so float summation order cannot show.
COARSE = ("revenue", "sum")


def stable(df: DataFrame, digits: int = 6, coarse_digits: int = 4) -> DataFrame:
    """Round aggregated double columns (6 decimals, 4 for large sums) so summation order
    cannot show. Rounds ``x * 10^d`` to an integer first: that product is the same IEEE
    operation in every engine, so ties resolve alike (a decimal ``round(x, d)`` does not)."""
    def rnd(name: str) -> F.Column:
        scale = float(10 ** (coarse_digits if name in COARSE else digits))
        return (F.round(F.col(name) * F.lit(scale), 0) / F.lit(scale)).alias(name)

    return df.select(
        [rnd(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in df.schema.fields]
    )


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def rd(cols: list[str], digits: int = 6) -> str:
    return ", ".join(r(c, c, digits) for c in cols)


TRIP_DOUBLES = ["trip_distance", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude"]
FARE_DOUBLES = ["fare_amount", "surcharge", "mta_tax", "tip_amount", "tolls_amount", "total_amount"]


def _sel(cols: list[str]) -> str:
    """Row-level outputs are not rounded: both engines compute them with the same IEEE ops."""
    return ", ".join(cols)


# ---- cleaning -------------------------------------------------------------------------

@register("dedup_trips", q(f"SELECT {_sel(TRIP_COLS)} FROM trips_dedup"))
def dedup_trips(spark, sf):
    return (quality.dedup(flow.fixture_raw(spark, sf)[0]))


@register("dedup_fares", q(f"SELECT {_sel(FARE_COLS)} FROM fares_dedup"))
def dedup_fares(spark, sf):
    return (quality.dedup(flow.fixture_raw(spark, sf)[1]))


@register(
    "fill_defaults",
    q("SELECT coalesce(rate_code, 'UNK') AS rate_code, coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, "
      "count(*) AS n FROM trips_dedup GROUP BY ALL"),
)
def fill_defaults(spark, sf):
    d = quality.fill_defaults(quality.dedup(flow.fixture_raw(spark, sf)[0]))
    return d.groupBy("rate_code", "store_and_fwd_flag").agg(F.count(F.lit(1)).alias("n"))


@register(
    "validate_trips",
    q(f"SELECT {_sel(TRIP_COLS)}, rejection_reason FROM trips_tagged"),
)
def validate_trips(spark, sf):
    return (quality.validated_trips(flow.fixture_raw(spark, sf)[0]))


@register(
    "validate_fares",
    q(f"SELECT {_sel(FARE_COLS)}, rejection_reason FROM fares_tagged"),
)
def validate_fares(spark, sf):
    return (quality.validated_fares(flow.fixture_raw(spark, sf)[1]))


@register(
    "quarantine_trips",
    q(f"SELECT {_sel(TRIP_COLS)}, rejection_reason FROM trips_tagged WHERE rejection_reason <> 'VALID'"),
)
def quarantine_trips(spark, sf):
    return (flow.fixture_clean(spark, sf).bad_trips)


@register(
    "quarantine_fares",
    q(f"SELECT {_sel(FARE_COLS)}, rejection_reason FROM fares_tagged WHERE rejection_reason <> 'VALID'"),
)
def quarantine_fares(spark, sf):
    return (flow.fixture_clean(spark, sf).bad_fares)


def _stats_sql(tagged: str, source: str) -> str:
    return (
        f"SELECT '{source}' AS source, 'total_records' AS metric, CAST(coalesce(sum(_rows), 0) AS BIGINT) AS value FROM {tagged} "
        f"UNION ALL SELECT '{source}', 'rejected_records', CAST(count(*) FILTER (WHERE rejection_reason <> 'VALID') AS BIGINT) FROM {tagged} "
        f"UNION ALL SELECT '{source}', rejection_reason, CAST(count(*) AS BIGINT) FROM {tagged} WHERE rejection_reason <> 'VALID' GROUP BY rejection_reason"
    )


@register("reject_stats_trips", q(_stats_sql("trips_tagged", "trips")))
def reject_stats_trips(spark, sf):
    return quality.reject_stats(flow.fixture_clean(spark, sf).tagged_trips, "trips")


@register("reject_stats_fares", q(_stats_sql("fares_tagged", "fares")))
def reject_stats_fares(spark, sf):
    return quality.reject_stats(flow.fixture_clean(spark, sf).tagged_fares, "fares")


# ---- matching ---------------------------------------------------------------------------

_MATCHED_DOUBLES = TRIP_DOUBLES + FARE_DOUBLES


@register(
    "match_full_outer",
    q("SELECT medallion, hack_license, vendor_id, pickup_datetime, dropoff_datetime, "
      "total_amount, "
      "CASE WHEN dropoff_datetime IS NOT NULL AND total_amount IS NOT NULL THEN 'matched' "
      "WHEN dropoff_datetime IS NOT NULL THEN 'trip_only' WHEN total_amount IS NOT NULL THEN 'fare_only' "
      "ELSE 'incomplete' END AS match_class FROM joined"),
)
def match_full_outer(spark, sf):
    c = flow.fixture_clean(spark, sf)
    j = matching.full_outer(c.good_trips, c.good_fares)
    return (
        j.select(*KEY, F.col("t.dropoff_datetime").alias("dropoff_datetime"),
                 F.col("f.total_amount").alias("total_amount"), matching.match_class().alias("match_class"))
    )


@register("match_inner", q(f"SELECT {_sel(MATCHED_COLS)} FROM matched"))
def match_inner(spark, sf):
    return (flow.fixture_matched(spark, sf))


@register("match_trips_only", q(f"SELECT {_sel(TRIP_COLS)} FROM trips_only"))
def match_trips_only(spark, sf):
    return (flow.fixture_match(spark, sf)[matching.TRIP_ONLY])


@register("match_fares_only", q(f"SELECT {_sel(FARE_COLS)} FROM fares_only"))
def match_fares_only(spark, sf):
    return (flow.fixture_match(spark, sf)[matching.FARE_ONLY])


@register(
    "match_stats",
    q("SELECT CAST((SELECT count(*) FROM trips_good) AS BIGINT) AS valid_trips_for_join, "
      "CAST((SELECT count(*) FROM fares_good) AS BIGINT) AS valid_fares_for_join, "
      "CAST(count(*) FILTER (WHERE dropoff_datetime IS NOT NULL AND total_amount IS NOT NULL) AS BIGINT) AS matched_records, "
      "CAST(count(*) FILTER (WHERE dropoff_datetime IS NOT NULL AND total_amount IS NULL) AS BIGINT) AS trips_without_fare, "
      "CAST(count(*) FILTER (WHERE dropoff_datetime IS NULL AND total_amount IS NOT NULL) AS BIGINT) AS fares_without_trip, "
      "CAST(count(*) FILTER (WHERE dropoff_datetime IS NULL AND total_amount IS NULL) AS BIGINT) AS incomplete_records "
      "FROM joined"),
)
def match_stats(spark, sf):
    c = flow.fixture_clean(spark, sf)
    return matching.match_stats(c.good_trips, c.good_fares)


_UNION_COLS = TRIP_COLS + ["source"] + FARE_VALS


@register(
    "unmatched_union",
    q(f"SELECT {_sel(_UNION_COLS)} FROM ("
      f"SELECT {', '.join(TRIP_COLS)}, 'trip_data' AS source, {', '.join('NULL AS ' + c for c in FARE_VALS)} FROM trips_only "
      f"UNION ALL SELECT {', '.join(c if c in FARE_COLS else 'NULL AS ' + c for c in TRIP_COLS)}, 'fare_data', {', '.join(FARE_VALS)} FROM fares_only)"),
)
def unmatched_union(spark, sf):
    m = flow.fixture_match(spark, sf)
    return (matching.unmatched_union(m[matching.TRIP_ONLY], m[matching.FARE_ONLY]))


@register("unmatched_single_pass", ORACLES["unmatched_union"])
def unmatched_single_pass(spark, sf):
    c = flow.fixture_clean(spark, sf)
    return matching.unmatched_with_stats(c.good_trips, c.good_fares)[0]


# ---- business questions -----------------------------------------------------------------

@register(
    "q1_hourly_weekend",
    q("SELECT pickup_hour, is_weekend, " + r("sum(total_amount)", "revenue", 4)
      + ", count(*) AS trips, " + r("avg(avg_speed_kmh)", "avg_speed_kmh") + ", " + r("avg(total_amount)", "avg_total_amount")
      + " FROM qbase WHERE trip_distance BETWEEN 1 AND 10 GROUP BY pickup_hour, is_weekend ORDER BY pickup_hour, is_weekend"),
)
def q1_hourly_weekend(spark, sf):
    return stable(questions.q1_hourly_weekend(flow.fixture_question_base(spark, sf, weather=False)))


# ---- report -------------------------------------------------------------------------------

def _feed_report_sql(tagged: str, source: str) -> str:
    return (
        f"SELECT '{source}' AS source, 'total_records' AS metric, CAST(sum(_rows) AS BIGINT) AS value, CAST(NULL AS DOUBLE) AS pct FROM {tagged} "
        f"UNION ALL SELECT '{source}', 'rejected_records', CAST(count(*) FILTER (WHERE rejection_reason <> 'VALID') AS BIGINT), "
        f"round(coalesce(count(*) FILTER (WHERE rejection_reason <> 'VALID') * CAST(100 AS DOUBLE) / nullif(sum(_rows), 0), 0) * 1e6) / 1e6 FROM {tagged} "
        f"UNION ALL SELECT '{source}', rejection_reason, count(*), round(count(*) * CAST(100 AS DOUBLE) / (SELECT sum(_rows) FROM {tagged}) * 1e6) / 1e6 "
        f"FROM {tagged} WHERE rejection_reason <> 'VALID' GROUP BY rejection_reason"
    )


_JOIN_COUNTS = (
    "SELECT (SELECT count(*) FROM trips_good) AS vt, (SELECT count(*) FROM fares_good) AS vf, "
    "count(*) FILTER (WHERE dropoff_datetime IS NOT NULL AND total_amount IS NOT NULL) AS mr, "
    "count(*) FILTER (WHERE dropoff_datetime IS NOT NULL AND total_amount IS NULL) AS tw, "
    "count(*) FILTER (WHERE dropoff_datetime IS NULL AND total_amount IS NOT NULL) AS fw, "
    "count(*) FILTER (WHERE dropoff_datetime IS NULL AND total_amount IS NULL) AS ir FROM joined"
)


@register(
    "etl_report",
    q(_feed_report_sql("trips_tagged", "trips") + " UNION ALL " + _feed_report_sql("fares_tagged", "fares")
      + " UNION ALL SELECT 'match', m, CAST(v AS BIGINT), p FROM (SELECT unnest(["
      "{'m': 'valid_trips_for_join', 'v': vt, 'p': NULL::DOUBLE}, {'m': 'valid_fares_for_join', 'v': vf, 'p': NULL::DOUBLE}, "
      "{'m': 'matched_records', 'v': mr, 'p': NULL::DOUBLE}, "
      "{'m': 'trips_without_fare', 'v': tw, 'p': round(coalesce(tw * CAST(100 AS DOUBLE) / nullif(vt, 0), 0) * 1e6) / 1e6}, "
      "{'m': 'fares_without_trip', 'v': fw, 'p': round(coalesce(fw * CAST(100 AS DOUBLE) / nullif(vf, 0), 0) * 1e6) / 1e6}, "
      "{'m': 'incomplete_records', 'v': ir, 'p': NULL::DOUBLE}], recursive := true) FROM (" + _JOIN_COUNTS + "))"),
)
def etl_report(spark, sf):
    from cabflow.operators.report import etl_report as build

    c = flow.fixture_clean(spark, sf)
    return stable(build(
        quality.reject_stats(c.tagged_trips, "trips"),
        quality.reject_stats(c.tagged_fares, "fares"),
        matching.match_stats(c.good_trips, c.good_fares),
    ))


# ---- features ------------------------------------------------------------------------------

def _matched_with(spark, sf, fn) -> DataFrame:
    return fn(flow.fixture_matched(spark, sf))


@register("feat_time", q("SELECT medallion, hack_license, vendor_id, pickup_datetime, pickup_hour, pickup_dow FROM abase"))
def feat_time(spark, sf):
    return _matched_with(spark, sf, enrich.add_time_features).select(*KEY, "pickup_hour", "pickup_dow")


@register(
    "feat_derived",
    q("SELECT medallion, hack_license, vendor_id, pickup_datetime, trip_duration_min, avg_speed_kmh, cost_per_km, cost_per_min FROM abase"),
)
def feat_derived(spark, sf):
    return _matched_with(spark, sf, enrich.add_derived_metrics).select(
        *KEY, "trip_duration_min", "avg_speed_kmh", "cost_per_km", "cost_per_min")


@register(
    "feat_time_flags",
    q("SELECT medallion, hack_license, vendor_id, pickup_datetime, is_weekend, day_part, is_evening_peak FROM qbase0"),
)
def feat_time_flags(spark, sf):
    return _matched_with(spark, sf, lambda d: enrich.add_time_flags(enrich.add_time_features(d))).select(
        *KEY, "is_weekend", "day_part", "is_evening_peak")


@register("feat_borough", q("SELECT medallion, hack_license, vendor_id, pickup_datetime, pickup_borough FROM qbase1"))
def feat_borough(spark, sf):
    return _matched_with(spark, sf, enrich.add_borough).select(*KEY, "pickup_borough")


@register("feat_utc_hour", q("SELECT medallion, hack_license, vendor_id, pickup_datetime, pickup_hour_utc FROM qbase1"))
def feat_utc_hour(spark, sf):
    return _matched_with(spark, sf, lambda d: d.withColumn("pickup_hour_utc", fx.pickup_hour_utc())).select(
        *KEY, "pickup_hour_utc")


@register("feat_ymd", q("SELECT medallion, hack_license, vendor_id, pickup_datetime, year, month, day FROM abase"))
def feat_ymd(spark, sf):
    return _matched_with(spark, sf, enrich.add_ymd).select(*KEY, "year", "month", "day")


@register(
    "enrich_holidays",
    q("SELECT medallion, hack_license, vendor_id, pickup_datetime, pickup_date, is_holiday FROM qbase1"),
)
def enrich_holidays(spark, sf):
    return _matched_with(spark, sf, enrich.add_holidays).select(*KEY, "pickup_date", "is_holiday")


_W = ["temperature_C", "dewpoint_C", "wind_speed_ms", "precip_mm_per_hr"]


@register(
    "enrich_weather",
    q(f"SELECT medallion, hack_license, vendor_id, pickup_datetime, pickup_hour_utc, {', '.join(_W)}, "
      "precip_bin, wind_bin, weather_condition_5 FROM qbase"),
)
def enrich_weather(spark, sf):
    m = flow.fixture_matched(spark, sf)
    return enrich.add_weather(m, flow.fixture_weather(spark, sf)).select(
        *KEY, "pickup_hour_utc", *_W, "precip_bin", "wind_bin", "weather_condition_5")


def _bin_counts(col: str) -> str:
    return q(f"SELECT {col}, count(*) AS trips FROM qbase GROUP BY {col}")


def _bin_query(col: str):
    def run(spark, sf):
        base = flow.fixture_question_base(spark, sf, weather=True)
        return base.groupBy(col).agg(F.count(F.lit(1)).alias("trips"))

    return run


register("feat_precip_bin", _bin_counts("precip_bin"))(_bin_query("precip_bin"))
register("feat_wind_bin", _bin_counts("wind_bin"))(_bin_query("wind_bin"))
register("feat_weather_condition", _bin_counts("weather_condition_5"))(_bin_query("weather_condition_5"))


# ---- questions Q2-Q6 --------------------------------------------------------------------------

def _rank_pick(x: str, p: float) -> str:
    """The value at rank max(1, ceil(p * n)) among the non-NULL values (1-based)."""
    return (f"list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))"
            f"[CAST(greatest(1, ceil({p} * count({x}))) AS BIGINT)]")


@register(
    "q2_tips",
    q("SELECT payment_type, passenger_count, day_part, " + r("avg(tip_amount)", "avg_tip") + ", "
      + r(_rank_pick("tip_amount", 0.5), "p50_tip") + ", count(*) AS trips FROM qbase GROUP BY ALL"),
)
def q2_tips(spark, sf):
    return stable(questions.q2_tips(flow.fixture_question_base(spark, sf, weather=False), exact=True))


@register(
    "q2_tips_approx",
    q("SELECT payment_type, passenger_count, day_part, TRUE AS p50_tip FROM qbase WHERE tip_amount IS NOT NULL GROUP BY ALL"),
)
def q2_tips_approx(spark, sf):
    """The median that the job writes is within the rank bound of the sketch."""
    base = flow.fixture_question_base(spark, sf, weather=False)
    return quantiles.rank_bounds_hold(
        base, questions.TIP_GROUPS, "tip_amount", questions.q2_tips(base), [0.5], ["p50_tip"], questions.PERCENTILE_ACCURACY)


@register(
    "q3_evening_peak",
    q("SELECT pickup_borough, " + r("avg(total_amount)", "avg_total_amount") + ", count(*) AS trips FROM qbase "
      "WHERE is_evening_peak = 1 AND trip_distance BETWEEN 1 AND 50 AND avg_speed_kmh BETWEEN 5 AND 80 GROUP BY pickup_borough"),
)
def q3_evening_peak(spark, sf):
    return stable(questions.q3_evening_peak(flow.fixture_question_base(spark, sf, weather=False)))


_MOM_SQL = (
    "mom AS (SELECT vendor_id, year, month, a AS avg_cost_per_km, lag(a) OVER (PARTITION BY vendor_id ORDER BY year, month) AS lag_avg, "
    "a - lag(a) OVER (PARTITION BY vendor_id ORDER BY year, month) AS mom_change "
    "FROM (SELECT vendor_id, year, month, avg(cost_per_km) AS a FROM qbase GROUP BY ALL))"
)


@register(
    "q4_vendor_mom",
    q("SELECT vendor_id, year, month, " + r("avg_cost_per_km", "avg_cost_per_km") + ", "
      + r("lag_avg", "lag_avg") + ", " + r("mom_change", "mom_change") + " FROM (WITH " + _MOM_SQL + " SELECT * FROM mom)"),
)
def q4_vendor_mom(spark, sf):
    return stable(questions.q4_vendor_mom(flow.fixture_question_base(spark, sf, weather=False)))


@register(
    "q4_growth_streak",
    q("SELECT vendor_id, max(streak_len) AS longest_growth_streak_months, max(streak_len) - 1 AS growth_steps FROM ("
      "SELECT vendor_id, is_up, count(*) OVER (PARTITION BY vendor_id, grp) AS streak_len FROM ("
      "SELECT vendor_id, is_up, sum(CASE WHEN is_up = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY vendor_id ORDER BY year, month "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM ("
      "SELECT vendor_id, year, month, CASE WHEN mom_change > 0 THEN 1 ELSE 0 END AS is_up FROM (WITH " + _MOM_SQL
      + " SELECT * FROM mom)))) WHERE is_up = 1 GROUP BY vendor_id"),
)
def q4_growth_streak(spark, sf):
    base = flow.fixture_question_base(spark, sf, weather=False)
    return questions.q4_growth_streak(questions.q4_vendor_mom(base)).select(
        "vendor_id", F.col("longest_growth_streak_months").cast("bigint").alias("longest_growth_streak_months"),
        F.col("growth_steps").cast("bigint").alias("growth_steps"))


_WM = ", ".join([
    r("avg(avg_speed_kmh)", "avg_speed_kmh"), r("avg(cost_per_min)", "avg_cost_per_min"), "count(*) AS trips",
    r("avg(temperature_C)", "avg_temperature_C"), r("avg(dewpoint_C)", "avg_dewpoint_C"),
    r("avg(wind_speed_ms)", "avg_wind_speed_ms"), r("avg(precip_mm_per_hr)", "avg_precip_mm_per_hr"),
])


@register("q5_condition_hour",
          q(f"SELECT weather_condition_5, pickup_hour, {_WM} FROM qbase GROUP BY ALL ORDER BY weather_condition_5, pickup_hour"))
def q5_condition_hour(spark, sf):
    return stable(questions.q5_condition_hour(flow.fixture_question_base(spark, sf, weather=True)))


@register("q5_precip_wind_hour",
          q(f"SELECT precip_bin, wind_bin, pickup_hour, {_WM} FROM qbase GROUP BY ALL ORDER BY precip_bin, wind_bin, pickup_hour"))
def q5_precip_wind_hour(spark, sf):
    return stable(questions.q5_precip_wind_hour(flow.fixture_question_base(spark, sf, weather=True)))


@register(
    "q6_high_value_share",
    q("SELECT pickup_borough, is_holiday, count(*) AS trips, CAST(count(*) FILTER (WHERE total_amount > 50) AS BIGINT) AS high_value_trips, "
      + r("CAST(count(*) FILTER (WHERE total_amount > 50) AS DOUBLE) / count(*)", "share") + " FROM qbase GROUP BY ALL"),
)
def q6_high_value_share(spark, sf):
    return stable(questions.q6_high_value_share(flow.fixture_question_base(spark, sf, weather=False)))


# ---- KPIs ------------------------------------------------------------------------------------

from cabflow.operators import kpis, profile  # noqa: E402

_KPI_SQL_MEASURES = ", ".join([
    r("avg(total_amount)", "avg_total_amount"),
    r(_rank_pick("total_amount", 0.5), "p50_total_amount"),
    r(_rank_pick("total_amount", 0.95), "p95_total_amount"),
    r("avg(cost_per_km)", "avg_cost_per_km"),
    r("avg(cost_per_min)", "avg_cost_per_min"),
    r("avg(avg_speed_kmh)", "avg_speed_kmh"),
    "count(*) AS trips",
    r("sum(total_amount)", "revenue", 4),
])
# Segment name -> grouping columns (oracle side, independent of kpis.SEGMENTS).
_KPI_SEGMENTS_SQL = [
    ("kpi_by_hour", ["pickup_hour"]),
    ("kpi_by_dow", ["pickup_dow"]),
    ("kpi_by_year_month", ["year", "month"]),
    ("kpi_by_payment", ["payment_type"]),
    ("kpi_by_vendor", ["vendor_id"]),
    ("kpi_by_passengers", ["passenger_count"]),
]
_KPI_ALL_COLS = ["pickup_hour", "pickup_dow", "year", "month", "payment_type", "vendor_id", "passenger_count"]


def _kpi_query(segment: str):
    def run(spark, sf):
        with flow.fine_splits(spark, sf):
            return stable(kpis.segmented_kpis(flow.fixture_analytics_base(spark, sf), exact=True, only=[segment])[segment])

    return run


for _name, _cols in _KPI_SEGMENTS_SQL:
    register(_name, q(f"SELECT {', '.join(_cols)}, {_KPI_SQL_MEASURES} FROM abase GROUP BY {', '.join(_cols)}"))(
        _kpi_query(_name))


def _gid(cols: list[str]) -> int:
    n = len(_KPI_ALL_COLS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_KPI_ALL_COLS) if c not in cols)


_KPI_GS_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS segment, CAST({_gid(cols)} AS INT) AS grouping_id, "
    + ", ".join(c if c in cols else f"NULL AS {c}" for c in _KPI_ALL_COLS)
    + f", {_KPI_SQL_MEASURES} FROM abase GROUP BY {', '.join(cols)}"
    for n, cols in _KPI_SEGMENTS_SQL
)


@register("kpi_grouping_sets", q(_KPI_GS_SQL))
def kpi_grouping_sets(spark, sf):
    with flow.fine_splits(spark, sf):
        return stable(kpis.kpi_grouping_sets(flow.fixture_analytics_base(spark, sf), exact=True))


@register(
    "kpi_grouping_sets_approx",
    q(" UNION ALL ".join(
        f"SELECT '{n}' AS segment, " + ", ".join(c if c in cols else f"NULL AS {c}" for c in _KPI_ALL_COLS)
        + f", TRUE AS p50_total_amount, TRUE AS p95_total_amount FROM abase WHERE total_amount IS NOT NULL GROUP BY {', '.join(cols)}"
        for n, cols in _KPI_SEGMENTS_SQL)),
)
def kpi_grouping_sets_approx(spark, sf):
    """The percentiles that the job writes are within the rank bound of the sketch."""
    base = flow.fixture_analytics_base(spark, sf)
    rows, keys = kpis.segment_rows(base)
    names, probs = zip(*kpis.PERCENTILES, strict=True)
    return quantiles.rank_bounds_hold(rows, keys, "total_amount", kpis.kpi_grouping_sets(base), probs, names, kpis.PERCENTILE_ACCURACY)


# ---- profile ---------------------------------------------------------------------------------

# Oracle-side schema of the analytics base (name, Spark type name).
_ABASE_TYPES = [
    ("medallion", "string"), ("hack_license", "string"), ("vendor_id", "string"), ("pickup_datetime", "timestamp"),
    ("rate_code", "string"), ("store_and_fwd_flag", "string"), ("dropoff_datetime", "timestamp"),
    ("passenger_count", "int"), ("trip_time_in_secs", "int"), ("trip_distance", "double"),
    ("pickup_longitude", "double"), ("pickup_latitude", "double"), ("dropoff_longitude", "double"),
    ("dropoff_latitude", "double"), ("payment_type", "string"), ("fare_amount", "double"), ("surcharge", "double"),
    ("mta_tax", "double"), ("tip_amount", "double"), ("tolls_amount", "double"), ("total_amount", "double"),
    ("year", "int"), ("month", "int"), ("day", "int"), ("trip_duration_min", "double"), ("avg_speed_kmh", "double"),
    ("cost_per_km", "double"), ("cost_per_min", "double"), ("pickup_hour", "int"), ("pickup_dow", "int"),
]
_SCHEMA_JSON = "[" + ",".join('{"name":"%s","type":"%s"}' % nt for nt in _ABASE_TYPES) + "]"


@register(
    "profile_overview",
    q(f"SELECT CAST(count(*) AS BIGINT) AS row_count, {len(_ABASE_TYPES)} AS num_columns, '{_SCHEMA_JSON}' AS schema_json, "
      "min(pickup_datetime) AS min_pickup_datetime, max(pickup_datetime) AS max_pickup_datetime FROM abase"),
)
def profile_overview(spark, sf):
    """The document that the job writes, its schema list as JSON text."""
    doc = profile.overview_document(flow.fixture_analytics_base(spark, sf))
    return doc.select("row_count", "num_columns", F.to_json("schema").alias("schema_json"),
                      F.col("min_pickup_datetime").cast("timestamp_ntz").alias("min_pickup_datetime"),
                      F.col("max_pickup_datetime").cast("timestamp_ntz").alias("max_pickup_datetime"))


# Oracle-side list of profiled columns.
_PROFILE_COLS_SQL = [
    "trip_time_in_secs", "trip_distance", "passenger_count", "fare_amount", "surcharge", "mta_tax", "tip_amount",
    "tolls_amount", "total_amount", "trip_duration_min", "avg_speed_kmh", "cost_per_km", "cost_per_min",
]


def _numeric_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
            f"{r(f'min({x})', 'min')}, {r(f'max({x})', 'max')}, {r(f'avg({x})', 'mean')}, {r(f'stddev_samp({x})', 'stddev')}, "
            f"{r(f'sum({x})', 'sum', 4)} FROM abase")


@register("profile_numeric", q(" UNION ALL ".join(_numeric_sql(c) for c in _PROFILE_COLS_SQL)))
def profile_numeric(spark, sf):
    return stable(profile.numeric_stats(flow.fixture_analytics_base(spark, sf), quantiles=False).drop(
        "p01", "p05", "p50", "p95", "p99"))


_QP = [("p01", 0.01), ("p05", 0.05), ("p50", 0.5), ("p95", 0.95), ("p99", 0.99)]


def _quantile_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"SELECT '{c}' AS \"column\", " + ", ".join(r(_rank_pick(x, p), n) for n, p in _QP) + " FROM abase"


@register("profile_quantiles_exact", q(" UNION ALL ".join(_quantile_sql(c) for c in _PROFILE_COLS_SQL)))
def profile_quantiles_exact(spark, sf):
    return stable(profile.exact_quantiles(flow.fixture_analytics_base(spark, sf)))


@register(
    "profile_quantiles_approx",
    q(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", " + ", ".join(f"TRUE AS {n}" for n, _ in _QP)
                         + f" FROM abase HAVING count({c}) > 0" for c in _PROFILE_COLS_SQL)),
)
def profile_quantiles_approx(spark, sf):
    """The quantiles that the job writes are within the rank bound of the sketch."""
    base = flow.fixture_analytics_base(spark, sf)
    accuracy = int(round(1 / profile.QUANTILE_REL_ERROR))
    return quantiles.rank_bounds_hold(profile.stacked(base), ["column"], "v", profile.numeric_stats(base),
                                      profile.QUANTILE_PROBS, profile.QUANTILE_NAMES, accuracy)


# ---- incremental profile -------------------------------------------------------------------------


def _partials(spark, sf) -> tuple[str, str]:
    """(processed root, root of the partials) of a layout one day of which was wrong, was profiled, and was replaced:
    the merged tables are right only if the refresh reads the replaced day, and it may read no other."""
    root = scratch_dir(spark, "incremental")
    table = f"{root}/{feeds.PROCESSED_TABLE}"
    writers.write_processed(flow.fixture_matched(spark, sf), table)
    trips = feeds.load_processed(spark, root)
    day = min(partials.day_digests(trips))
    whole_day = F.make_date("year", "month", "day") == F.lit(day)
    trips.filter(whole_day).write.parquet(f"{root}/right")
    right = spark.read.schema(trips.schema).parquet(f"{root}/right")
    writers.write_processed(right.unionByName(right), table)
    partials.refresh(spark, root, f"{root}/partials")
    writers.write_processed(right, table)
    read = partials.refresh(spark, root, f"{root}/partials")
    if read != [day]:
        raise AssertionError(f"refreshed {read}, not only {day}")
    return root, f"{root}/partials"


@register("profile_partials", ORACLES["profile_numeric"])
def profile_partials(spark, sf):
    stats = partials.numeric_stats(spark, _partials(spark, sf)[1])
    return stable(stats.drop(*profile.QUANTILE_NAMES))


@register("profile_partials_quantiles", ORACLES["profile_quantiles_approx"])
def profile_partials_quantiles(spark, sf):
    """Quantiles of the merged sketches keep their rank bound."""
    root, parts = _partials(spark, sf)
    base = analytics_base(feeds.load_processed(spark, root))
    return quantiles.rank_bounds_hold(profile.stacked(base), ["column"], "v", partials.numeric_stats(spark, parts),
                                      profile.QUANTILE_PROBS, profile.QUANTILE_NAMES, int(round(1 / partials.RANK_ERROR)))


@register("kpi_partials", q(f"SELECT * EXCLUDE (p50_total_amount, p95_total_amount) FROM ({_KPI_GS_SQL})"))
def kpi_partials(spark, sf):
    merged = partials.kpi_grouping_sets(spark, _partials(spark, sf)[1])
    return stable(merged.drop(*[n for n, _ in kpis.PERCENTILES]))


@register("kpi_partials_quantiles", ORACLES["kpi_grouping_sets_approx"])
def kpi_partials_quantiles(spark, sf):
    root, parts = _partials(spark, sf)
    rows, keys = kpis.segment_rows(analytics_base(feeds.load_processed(spark, root)))
    names, probs = zip(*kpis.PERCENTILES, strict=True)
    merged = partials.kpi_grouping_sets(spark, parts)
    return quantiles.rank_bounds_hold(rows, keys, "total_amount", merged, probs, names, int(round(1 / partials.RANK_ERROR)))


def _fmt_sql(expr: str, kind: str) -> str:
    if kind == "int":
        return f"coalesce(CAST(CAST({expr} AS BIGINT) AS VARCHAR), '')"
    d = 2 if kind == "money" else 4
    return f"coalesce(printf('%.{d}f', round(({expr}) * 1e{d}) / 1e{d}), '')"


def _kind(name: str) -> str:
    if name in ("trips", "count", "null_count", "row_count"):
        return "int"
    if any(k in name for k in ("amount", "cost", "revenue")) or name == "sum":
        return "money"
    return "dec"


def _summary_sql() -> str:
    parts = [
        "SELECT 'OVERVIEW' AS section, '' AS segment, 'row_count' AS metric, CAST(count(*) AS VARCHAR) AS value FROM abase",
        "SELECT 'OVERVIEW', '', 'min_pickup_datetime', coalesce(CAST(min(pickup_datetime) AS VARCHAR), '') FROM abase",
        "SELECT 'OVERVIEW', '', 'max_pickup_datetime', coalesce(CAST(max(pickup_datetime) AS VARCHAR), '') FROM abase",
    ]
    stat_exprs = [("count", "count({c})"), ("null_count", "count(*) - count({c})"), ("min", "min({x})"),
                  ("max", "max({x})"), ("mean", "avg({x})"), ("stddev", "stddev_samp({x})"), ("sum", "sum({x})")]
    for c in _PROFILE_COLS_SQL:
        x = f"CAST({c} AS DOUBLE)"
        for m, e in stat_exprs:
            parts.append(f"SELECT 'NUMERIC_STATISTICS', '{c}', '{m}', {_fmt_sql(e.format(c=c, x=x), _kind(m))} FROM abase")
        for n, p in _QP:
            parts.append(f"SELECT 'NUMERIC_STATISTICS', '{c}', '{n}', {_fmt_sql(_rank_pick(x, p), 'dec')} FROM abase")
    measures = [("avg_total_amount", "avg(total_amount)"), ("p50_total_amount", _rank_pick("total_amount", 0.5)),
                ("p95_total_amount", _rank_pick("total_amount", 0.95)), ("avg_cost_per_km", "avg(cost_per_km)"),
                ("avg_cost_per_min", "avg(cost_per_min)"), ("avg_speed_kmh", "avg(avg_speed_kmh)"),
                ("trips", "count(*)"), ("revenue", "sum(total_amount)")]
    for name, cols in _KPI_SEGMENTS_SQL:
        label = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols)
        for m, e in measures:
            parts.append(f"SELECT '{name.upper()}', {label}, '{m}', {_fmt_sql(e, _kind(m))} FROM abase GROUP BY {', '.join(cols)}")
    return " UNION ALL ".join(parts)


@register("kpi_summary_long", q(_summary_sql()))
def kpi_summary_long(spark, sf):
    """All sections are read from one staged copy of the columns that any of them needs."""
    path = scratch_dir(spark, "summary-rows")
    try:
        with flow.fine_splits(spark, sf):
            base = flow.fixture_analytics_base(spark, sf)
            needed = {"pickup_datetime", *profile.numeric_columns(base), *kpis.columns_read(base)}
            rows = quantiles.kept(base.select(*[c for c in base.columns if c in needed]), path)
            stats = profile.numeric_stats(rows, quantiles=False).drop("p01", "p05", "p50", "p95", "p99")
            numeric = stats.join(profile.exact_quantiles(rows, staged=True), "column")
            overview = profile.with_schema(profile.overview_document(rows), base)
            grouped = kpis.kpi_grouping_sets(rows, exact=True, staged=True)
            return quantiles.kept(kpis.kpi_summary_long(overview, numeric, grouped), scratch_dir(spark, "summary"))
    finally:
        remove_path(spark, path)


# ---- sources -----------------------------------------------------------------------------------



def _via_csv(spark, df: DataFrame, name: str) -> str:
    path = scratch_dir(spark, name)
    writers.write_csv(df, path)
    return path


@register("src_trips", q("SELECT * FROM trips_raw"))
def src_trips(spark, sf):
    return feeds.load_trips(spark, _via_csv(spark, fixtures.trips_raw(spark, sf), "trips-csv"))


@register("src_fares", q("SELECT * FROM fares_raw"))
def src_fares(spark, sf):
    return feeds.load_fares(spark, _via_csv(spark, fixtures.fares_raw(spark, sf), "fares-csv"))


# Faults planted in the trip CSV, by the number k in the hack license: the row loses its last two cells, or gets one
# more, or has text in a numeric or time cell.
_K = "CAST(substr(hack_license, 2) AS BIGINT)"
_SHORT, _LONG = f"{_K} % 47 = 0", f"{_K} % 47 <> 0 AND {_K} % 59 = 0"
_BAD = {"dropoff_datetime": (f"{_K} % 43 = 1", "1996-13-45 00:00:00"), "passenger_count": (f"{_K} % 37 = 0", "two"),
        "trip_distance": (f"{_K} % 41 = 0", "\"a, b\"")}
_RIGHT = f"NOT ({_SHORT}) AND NOT ({_LONG})"
_FAULTY = " OR ".join([f"({_SHORT})", f"({_LONG})", *[f"({c})" for c, _ in _BAD.values()]])


def _broken_trips_csv(spark, sf) -> str:
    trips = fixtures.trips_raw(spark, sf)
    cells = []
    for f in TRIP_SCHEMA.fields:
        cell = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss") if f.name.endswith("datetime") else F.col(f.name).cast("string")
        if f.name in _BAD:
            cell = F.when(F.expr(_BAD[f.name][0]), F.lit(_BAD[f.name][1])).otherwise(cell)
        cells.append(F.coalesce(cell, F.lit("")))
    line = F.concat_ws(",", F.when(F.expr(_SHORT), F.array(*cells[:-2])).when(F.expr(_LONG), F.array(*cells, F.lit("more"))).otherwise(F.array(*cells)))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of each file
    header = F.lit(",".join(TRIP_SCHEMA.names) + "\n")
    path = scratch_dir(spark, "broken-csv")
    trips.select(F.when(first, F.concat(header, line)).otherwise(line).alias("value")).write.text(path)
    return path


@register(
    "malformed_trips",
    q(f"SELECT 'trips' AS source, 'malformed_rows' AS metric, count(*) FILTER (WHERE {_FAULTY}) AS value FROM trips_raw"
      + "".join(f" UNION ALL SELECT 'trips', '{n}', count(*) FROM trips_raw WHERE {c} HAVING count(*) > 0" for n, c in [
          ("short_row", _SHORT), ("long_row", _LONG), *[(f"bad_{n}", f"({c}) AND {_RIGHT}") for n, (c, _) in _BAD.items()]])),
)
def malformed_trips(spark, sf):
    """Faults of a trip CSV with broken cells, short and long rows, counted per column."""
    return malformed.fault_counts(feeds.load_trips(spark, _broken_trips_csv(spark, sf), checked=True), TRIP_SCHEMA, "trips")


@register(
    "quarantine_malformed",
    q("SELECT medallion, hack_license, pickup_datetime, concat_ws('|', "
      + ", ".join([f"CASE WHEN {_SHORT} THEN 'short_row' END", f"CASE WHEN {_LONG} THEN 'long_row' END",
                   *[f"CASE WHEN ({c}) AND {_RIGHT} THEN 'bad_{n}' END" for n, (c, _) in _BAD.items()]])
      + f") AS faults FROM trips_raw WHERE {_FAULTY}"),
)
def quarantine_malformed(spark, sf):
    checked = feeds.load_trips(spark, _broken_trips_csv(spark, sf), checked=True)
    return malformed.quarantine(checked, TRIP_SCHEMA).select("medallion", "hack_license", "pickup_datetime", "faults")


@register(
    "src_trips_checked",
    q("SELECT " + ", ".join(
        f"CASE WHEN {_BAD[c][0]} THEN NULL ELSE {c} END AS {c}" if c in _BAD
        else f"CASE WHEN {_SHORT} THEN NULL ELSE {c} END AS {c}" if c in TRIP_COLS[-2:] else c for c in TRIP_COLS) + " FROM trips_raw"),
)
def src_trips_checked(spark, sf):
    """The parsed values of the same CSV: what does not parse is NULL, all else is as in a clean file."""
    return feeds.load_trips(spark, _broken_trips_csv(spark, sf), by_name=True, checked=True).drop(malformed.MALFORMED)


# The columns of the trip feed in another order, as some files have them.
_TURNED = TRIP_COLS[::-1]


def _turned_csv(spark, sf) -> str:
    """Two files of trips, each a folder of parts as many tasks write it: half of the trips with the schema's order,
    half with the columns turned round."""
    trips = fixtures.trips_raw(spark, sf)
    odd = F.expr(f"{_K} % 2 = 1")
    root = scratch_dir(spark, "turned-csv")
    writers.write_csv(trips.filter(~odd), f"{root}/one.csv")
    writers.write_csv(trips.filter(odd).select(*[F.col(c).alias(f" {c.upper()}") for c in _TURNED]), f"{root}/two.csv")
    return root


@register("src_trips_by_name", q("SELECT * FROM trips_raw"))
def src_trips_by_name(spark, sf):
    return feeds.load_trips(spark, _turned_csv(spark, sf), by_name=True)


@register(
    "schema_check",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS name, '{f.dataType.simpleString()}' AS type, CAST({at} AS INTEGER) AS place, "
        "CAST(1 AS INTEGER) AS files"
        for i, f in enumerate(TRIP_SCHEMA.fields) for at in (i, len(TRIP_COLS) - 1 - i)),
)
def schema_check(spark, sf):
    """The schema of the trip feed, and where the header of each file has its columns."""
    return headers.header_rows(spark, TRIP_SCHEMA, _turned_csv(spark, sf), parts=True)


@register(
    "schema_trips",
    " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS position, '{f.name}' AS name, '{t}' AS type" for i, (f, t) in enumerate(
        zip(TRIP_SCHEMA.fields, ["string"] * 5 + ["timestamp"] * 2 + ["int"] * 2 + ["double"] * 5, strict=True))),
)
def schema_trips(spark, sf):
    return feeds.schema_rows(fixtures.trips_raw(spark, sf))


@register("src_weather_hourly", q("SELECT * FROM weather_raw"))
def src_weather_hourly(spark, sf):
    csv_path = _via_csv(spark, fixtures.weather_csv_frame(spark, sf), "weather-csv")
    return feeds.load_or_prepare_weather(spark, scratch_dir(spark, "processed"), csv_path=csv_path)


@register(
    "src_processed_roundtrip",
    q("SELECT medallion, hack_license, vendor_id, pickup_datetime, rate_code, store_and_fwd_flag, dropoff_datetime, "
      "passenger_count, trip_time_in_secs, trip_distance, pickup_longitude, pickup_latitude, dropoff_longitude, "
      "dropoff_latitude, payment_type, fare_amount, surcharge, mta_tax, tip_amount, tolls_amount, total_amount, "
      "year, month, day FROM abase"),
)
def src_processed_roundtrip(spark, sf):
    root = scratch_dir(spark, "processed")
    writers.write_processed(flow.fixture_matched(spark, sf), f"{root}/{feeds.PROCESSED_TABLE}")
    return feeds.load_processed(spark, root)


@register(
    "dim_holidays",
    q("SELECT date, is_holiday, holiday_name FROM holidays WHERE year(date) BETWEEN "
      "(SELECT min(year(pickup_datetime)) FROM trips_raw) AND (SELECT max(year(pickup_datetime)) FROM trips_raw)"),
)
def dim_holidays(spark, sf):
    return dims.holidays_covering(fixtures.trips_raw(spark, sf))


@register(
    "holiday_flags",
    q("SELECT d AS pickup_date, CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday FROM days LEFT JOIN holidays h ON h.date = d "
      "WHERE year(d) BETWEEN (SELECT min(year(pickup_datetime)) FROM trips_raw) AND (SELECT max(year(pickup_datetime)) FROM trips_raw)"),
)
def holiday_flags(spark, sf):
    """The flag expression that the job uses, on every day of the years that the trips touch."""
    span = fixtures.trips_raw(spark, sf).agg(F.min(F.year("pickup_datetime")).alias("y0"), F.max(F.year("pickup_datetime")).alias("y1"))
    every = F.sequence(F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31)))
    days = span.select(F.explode(every).alias("day")).select(F.col("day").cast("timestamp").alias("pickup_datetime"))
    return enrich.add_holidays(days).select("pickup_date", "is_holiday")


@register("preview_trips")
def preview_trips(spark, sf):
    return feeds.preview(fixtures.trips_raw(spark, sf))


@register("preview_fares")
def preview_fares(spark, sf):
    return feeds.preview(fixtures.fares_raw(spark, sf))


# ---- ML -----------------------------------------------------------------------------------------

from cabflow.operators import ml  # noqa: E402

_HAV_SQL = ("2 * CAST(6371.0 AS DOUBLE) * asin(sqrt(least(1, pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2) "
            "+ cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude)) * "
            "pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2))))")
_PLAUSIBLE_SQL = ("total_amount BETWEEN 2.5 AND 500 AND pickup_longitude BETWEEN -75 AND -72 AND pickup_latitude BETWEEN 40 AND 42 "
                  "AND dropoff_longitude BETWEEN -75 AND -72 AND dropoff_latitude BETWEEN 40 AND 42 AND passenger_count > 0")
_MLF = (f"(SELECT *, {_HAV_SQL} AS hav FROM matched WHERE {_PLAUSIBLE_SQL})")
_MLFEAT = (f"(SELECT *, CAST(hour(pickup_datetime) AS INT) AS pickup_hour, CAST(dayofweek(pickup_datetime) + 1 AS INT) AS day_of_week, "
           "CASE WHEN dayofweek(pickup_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, "
           "hav * CAST(0.621371 AS DOUBLE) / (trip_time_in_secs / CAST(3600 AS DOUBLE)) AS speed, "
           "CASE WHEN hav * CAST(0.621371 AS DOUBLE) / (trip_time_in_secs / CAST(3600 AS DOUBLE)) < 12 THEN 1.0 ELSE 0.0 END AS label, "
           "('0x' || substr(md5(concat_ws('|', medallion, hack_license, vendor_id, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'))), 1, 8))::BIGINT % 10 AS bucket "
           f"FROM {_MLF} WHERE trip_time_in_secs > 60 AND hav > 0.5)")


def _ml_data(spark, sf) -> DataFrame:
    return ml.prepare_features(flow.fixture_matched(spark, sf))


@register("feat_haversine", q(f"SELECT medallion, hack_license, vendor_id, pickup_datetime, {r(_HAV_SQL, 'haversine_distance')} FROM matched"))
def feat_haversine(spark, sf):
    return stable(ml.with_haversine(flow.fixture_matched(spark, sf)).select(*KEY, "haversine_distance"))


@register("ml_filter", q(f"SELECT medallion, hack_license, vendor_id, pickup_datetime FROM matched WHERE {_PLAUSIBLE_SQL}"))
def ml_filter(spark, sf):
    return ml.plausible(flow.fixture_matched(spark, sf)).select(*KEY)


@register(
    "ml_features",
    q("SELECT medallion, hack_license, vendor_id, pickup_datetime, pickup_hour, day_of_week, is_weekend, "
      f"{r('hav', 'haversine_distance')}, {r('speed', 'trip_speed_mph')}, CAST(label AS DOUBLE) AS is_high_traffic FROM {_MLFEAT}"),
)
def ml_features(spark, sf):
    return stable(_ml_data(spark, sf).select(
        *KEY, "pickup_hour", "day_of_week", "is_weekend", "haversine_distance", "trip_speed_mph", "is_high_traffic"))


@register("ml_traffic_label", q(f"SELECT CAST(label AS DOUBLE) AS is_high_traffic, count(*) AS trips FROM {_MLFEAT} GROUP BY 1"))
def ml_traffic_label(spark, sf):
    return _ml_data(spark, sf).groupBy("is_high_traffic").agg(F.count(F.lit(1)).alias("trips"))


@register("ml_split", q(f"SELECT CASE WHEN bucket < 8 THEN 'train' ELSE 'test' END AS part, count(*) AS trips FROM {_MLFEAT} GROUP BY 1"))
def ml_split(spark, sf):
    train, test = ml.split(_ml_data(spark, sf))
    return (train.select(F.lit("train").alias("part")).unionByName(test.select(F.lit("test").alias("part")))
            .groupBy("part").agg(F.count(F.lit(1)).alias("trips")))


# Fixed formula predictions so the metric aggregates have an exact SQL twin.
_FIXED_REG = "2.5 + 2.0 * haversine_distance"
_FIXED_CLS = "CASE WHEN haversine_distance < 2.0 THEN 1.0 ELSE 0.0 END"


@register(
    "ml_metrics_regression",
    q("SELECT " + r("sqrt(avg((p - y) * (p - y)))", "RMSE") + ", " + r("avg(abs(p - y))", "MAE") + ", "
      + r("1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*))", "R2")
      + f" FROM (SELECT total_amount AS y, 2.5 + 2.0 * hav AS p FROM {_MLFEAT} WHERE bucket >= 8)"),
)
def ml_metrics_regression(spark, sf):
    _, test = ml.split(_ml_data(spark, sf))
    return stable(ml.regression_metrics(test.withColumn("prediction", F.expr(_FIXED_REG))))


@register(
    "ml_metrics_classification",
    q("SELECT " + ", ".join([
        r("sum(tp) / sum(nt)", "Accuracy"),
        r("sum(nt * CASE WHEN np > 0 THEN tp / np ELSE 0 END) / sum(nt)", "Precision"),
        r("sum(nt * CASE WHEN nt > 0 THEN tp / nt ELSE 0 END) / sum(nt)", "Recall"),
        r("sum(nt * CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END) / sum(nt)", "F1")])
      + " FROM (SELECT *, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS pr, CASE WHEN nt > 0 THEN tp / nt ELSE 0 END AS rc FROM ("
      "SELECT l.y, CAST(l.nt AS DOUBLE) AS nt, CAST(l.tp AS DOUBLE) AS tp, CAST(coalesce(pp.np, 0) AS DOUBLE) AS np FROM "
      "(SELECT y, count(*) AS nt, count(*) FILTER (WHERE y = p) AS tp FROM c GROUP BY y) l "
      "LEFT JOIN (SELECT p, count(*) AS np FROM c GROUP BY p) pp ON l.y = pp.p))".replace(
          " FROM c ", f" FROM (SELECT label AS y, CASE WHEN hav < 2.0 THEN 1.0 ELSE 0.0 END AS p FROM {_MLFEAT} WHERE bucket >= 8) ")),
)
def ml_metrics_classification(spark, sf):
    _, test = ml.split(_ml_data(spark, sf))
    return stable(ml.classification_metrics(test.withColumn("prediction", F.expr(_FIXED_CLS))))


def _model_query(task: str, model: str):
    def run(spark, sf):
        path = scratch_dir(spark, "ml-features")
        try:
            with flow.fine_splits(spark, sf):
                data = ml.stage_training_table(_ml_data(spark, sf), path)
            return stable(ml.train_evaluate(data, task, models=[model]))
        finally:
            remove_path(spark, path)

    return run


# The oracle fits the linear and the logistic model itself: coordinate descent on the Gram matrix, and gradient
# steps over the training rows, both as recursive CTEs run until nothing moves any more.
_X = ["x1", "x2", "x3", "x4"]
_ROWS_SQL = ("f AS MATERIALIZED (SELECT hav AS x1, CAST(pickup_hour AS DOUBLE) AS x2, CAST(is_weekend AS DOUBLE) AS x3, "
             f"CAST(passenger_count AS DOUBLE) AS x4, total_amount AS y, CAST(label AS DOUBLE) AS label, bucket FROM {_MLFEAT}), "
             "tr AS (SELECT * FROM f WHERE bucket < 8), te AS (SELECT * FROM f WHERE bucket >= 8)")


def _linear_sql() -> str:
    aggregates = ["avg(y) AS my", "stddev_pop(y) AS sy"]
    for i, x in enumerate(_X):
        aggregates += [f"avg({x}) AS m{i}", f"stddev_pop({x}) AS s{i}", f"corr({x}, y) AS r{i}"]
        aggregates += [f"corr({x}, {z}) AS r{i}_{j}" for j, z in enumerate(_X) if j > i]

    def step(i: int) -> str:
        """The best weight i given the others (new ones before it, old ones after it)."""
        rest = " - ".join([f"r{i}"] + [f"r{min(i, j)}_{max(i, j)} * {'n' if j < i else 'w'}{j}" for j in range(4) if j != i])
        return f"sign({rest}) * greatest(abs({rest}) - l1, 0) / (1 + l2)"

    steps, inner = "cd, g WHERE i < 300", ""
    for i in range(4):
        inner = f"(SELECT *, {step(i)} AS n{i} FROM {inner or steps})"
    betas = ", ".join(f"w{i} * sy / s{i} AS b{i}" for i in range(4))
    return (f"g AS (SELECT *, 0.08 / sy AS l1, 0.02 / sy AS l2 FROM (SELECT {', '.join(aggregates)} FROM tr)), "
            "cd(i, w0, w1, w2, w3) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) "
            f"UNION ALL SELECT i + 1, n0, n1, n2, n3 FROM {inner}), "
            f"beta AS (SELECT b0, b1, b2, b3, my - b0 * m0 - b1 * m1 - b2 * m2 - b3 * m3 AS b FROM "
            f"(SELECT *, {betas} FROM (SELECT * FROM cd ORDER BY i DESC LIMIT 1), g))")


def _logistic_sql() -> str:
    scale = ", ".join(f"avg({x}) AS m{i}, stddev_samp({x}) AS s{i}" for i, x in enumerate(_X))
    z = ", ".join(f"({x} - m{i}) / s{i} AS z{i}" for i, x in enumerate(_X))
    moves = ", ".join(f"w{i} - 1.5 * (avg((p - label) * z{i}) + 0.1 * w{i})" for i in range(4))
    return (f"g AS (SELECT {scale} FROM tr), z AS MATERIALIZED (SELECT {z}, label FROM tr, g), "
            "gd(i, w, w0, w1, w2, w3) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), "
            f"CAST(0 AS DOUBLE) UNION ALL SELECT i + 1, w - 2 * avg(p - label), {moves} FROM (SELECT *, "
            "1 / (1 + exp(-(w + w0 * z0 + w1 * z1 + w2 * z2 + w3 * z3))) AS p FROM gd, z WHERE i < 400) GROUP BY i, w, w0, w1, w2, w3), "
            "beta AS (SELECT w0 / s0 AS b0, w1 / s1 AS b1, w2 / s2 AS b2, w3 / s3 AS b3, "
            "w - w0 * m0 / s0 - w1 * m1 / s1 - w2 * m2 / s2 - w3 * m3 / s3 AS b FROM (SELECT * FROM gd ORDER BY i DESC LIMIT 1), g)")


_FITTED = "(b + b0 * x1 + b1 * x2 + b2 * x3 + b3 * x4)"
_REG_METRICS = {"RMSE": "sqrt(avg((p - y) * (p - y)))", "MAE": "avg(abs(p - y))",
                "R2": "1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*))"}


def qr(body: str) -> str:
    """An oracle with recursive parts."""
    return "WITH RECURSIVE" + q(body).removeprefix("WITH")


def _metric_rows(task: str, model: str, metrics: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{task}' AS task, '{model}' AS model, '{m}' AS metric, {r(e, 'value')} FROM {source}" for m, e in metrics.items()
    )


_LINEAR_METRICS = (f", {_ROWS_SQL}, {_linear_sql()}, scored AS (SELECT y, {_FITTED} AS p FROM te, beta) "
                   + _metric_rows("regression", "LinearRegression", _REG_METRICS, "scored"))
_PER_LABEL = ("c AS (SELECT label AS y, CASE WHEN " + _FITTED + " > 0 THEN 1.0 ELSE 0.0 END AS p FROM te, beta), "
              "k AS (SELECT l.y, nt, tp, coalesce(np, 0) AS np FROM (SELECT y, count(*) AS nt, count(*) FILTER (WHERE y = p) AS tp FROM c GROUP BY y) l "
              "LEFT JOIN (SELECT p, count(*) AS np FROM c GROUP BY p) USING (p)), "
              "j AS (SELECT *, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS pr, tp / nt AS rc FROM k), "
              "h AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f1 FROM j)").replace(
                  "USING (p)", "pp ON pp.p = l.y")
_CLS_METRICS = {"Accuracy": "sum(tp) / sum(nt)", "Precision": "sum(nt * pr) / sum(nt)", "Recall": "sum(nt * rc) / sum(nt)",
                "F1": "sum(nt * f1) / sum(nt)"}
_LOGISTIC_METRICS = (f", {_ROWS_SQL}, {_logistic_sql()}, {_PER_LABEL} "
                     + _metric_rows("classification", "LogisticRegression", _CLS_METRICS, "h"))

for _task, _model, _qname, _oracle in [
    ("regression", "LinearRegression", "ml_reg_linear", qr(_LINEAR_METRICS)),
    ("regression", "RandomForestRegressor", "ml_reg_forest", None),
    ("regression", "GBTRegressor", "ml_reg_gbt", None),
    ("classification", "LogisticRegression", "ml_cls_logistic", qr(_LOGISTIC_METRICS)),
    ("classification", "RandomForestClassifier", "ml_cls_forest", None),
    ("classification", "GBTClassifier", "ml_cls_gbt", None),
]:
    register(_qname, _oracle)(_model_query(_task, _model))


def _fitted(spark, sf, task: str, model: str, use):
    """``use(model, training table, path of the saved model)`` with the scratch removed after; its result is written
    first, as it reads the training table."""
    from cabflow.session import scratch_dir as fresh

    root = fresh(spark, "ml-model")
    try:
        with flow.fine_splits(spark, sf):
            data = ml.stage_training_table(_ml_data(spark, sf), f"{root}/features")
        p = ml.ModelParams()
        estimator = (ml.regressors(p) if task == "regression" else ml.classifiers(p))[model]
        path = f"{root}/model"
        ml.fit(estimator, ml.split(data)[0], p.features).write().overwrite().save(path)
        out = use(data, path)
        return spark.createDataFrame(out.collect(), out.schema)  # a row per term or per hour
    finally:
        remove_path(spark, root)


_TERMS = [*ml.FEATURES, certificates.INTERCEPT]


def _certificate_sql(fit: str) -> str:
    terms = " UNION ALL ".join(
        f"SELECT '{t}' AS term, (SELECT count(*) FROM tr) AS trips, {r(b, 'coefficient', 4)}, TRUE AS optimal FROM beta"
        for t, b in zip(_TERMS, ["b0", "b1", "b2", "b3", "b"], strict=True))
    return qr(f", {_ROWS_SQL}, {fit} {terms}")


@register("ml_reg_linear_certificate", _certificate_sql(_linear_sql()))
def ml_reg_linear_certificate(spark, sf):
    """The saved elastic net is the optimum of its objective: every term, by one aggregate."""
    def use(data, path):
        p, m = ml.ModelParams(), ml.PipelineModel.load(path).stages[-1]
        return certificates.linear(ml.split(data)[0], p.features, ml.REG_LABEL, m.coefficients.toArray(), m.intercept, p.lr_reg, p.lr_elastic)

    return stable(_fitted(spark, sf, "regression", "LinearRegression", use).drop("violation"), 4)


@register("ml_cls_logistic_certificate", _certificate_sql(_logistic_sql()))
def ml_cls_logistic_certificate(spark, sf):
    def use(data, path):
        p, m = ml.ModelParams(), ml.PipelineModel.load(path).stages[-1]
        return certificates.logistic(ml.split(data)[0], p.features, ml.CLS_LABEL, m.coefficients.toArray(), m.intercept, p.logr_reg)

    return stable(_fitted(spark, sf, "classification", "LogisticRegression", use).drop("violation"), 4)


_COMPILED = q("SELECT CASE WHEN bucket < 8 THEN 'train' ELSE 'test' END AS part, pickup_hour, is_weekend, count(*) AS trips, "
              f"count(*) AS agreeing FROM {_MLFEAT} GROUP BY ALL")


def _compiled_query(task: str, model: str):
    def use(data, path):
        spark = data.sparkSession
        ensemble = tree_sql.load(spark, path, ml.FEATURES)
        part = F.when(F.col(ml.BUCKET) < ml.TRAIN_BUCKETS, "train").otherwise("test")
        scored = ml.PipelineModel.load(path).transform(data).withColumn("part", part)
        return tree_sql.agreement(tree_sql.with_prediction(scored, ensemble, "compiled"), ["part", "pickup_hour", "is_weekend"])

    def run(spark, sf):
        """Every row of the training table scored by the runtime and by the compiled SQL expression: how many agree."""
        return _fitted(spark, sf, task, model, use)

    return run


for _task, _model, _qname in [
    ("regression", "RandomForestRegressor", "ml_reg_forest_compiled"),
    ("regression", "GBTRegressor", "ml_reg_gbt_compiled"),
    ("classification", "RandomForestClassifier", "ml_cls_forest_compiled"),
    ("classification", "GBTClassifier", "ml_cls_gbt_compiled"),
]:
    register(_qname, _COMPILED)(_compiled_query(_task, _model))


@register("ml_metrics_all")
def ml_metrics_all(spark, sf):
    with flow.fine_splits(spark, sf):
        return ml.run_ml(flow.fixture_matched(spark, sf))


def _ranges_sql() -> str:
    reg = ["LinearRegression", "RandomForestRegressor", "GBTRegressor"]
    cls = ["LogisticRegression", "RandomForestClassifier", "GBTClassifier"]
    rows = [("regression", m, k) for m in reg for k in _REG_METRICS] + [("classification", m, k) for m in cls for k in _CLS_METRICS]
    return " UNION ALL ".join(f"SELECT '{t}' AS task, '{m}' AS model, '{k}' AS metric, TRUE AS in_range" for t, m, k in rows)


@register("ml_metrics_ranges", _ranges_sql())
def ml_metrics_ranges(spark, sf):
    """All metrics of one ML run lie where they must: errors at or above 0 and MAE at most RMSE, R2 at most 1,
    shares in [0, 1], and recall (weighted by label) equal to accuracy."""
    with flow.fine_splits(spark, sf):
        return ml.in_range(ml.run_ml(flow.fixture_matched(spark, sf)))
