"""End-to-end jobs.

B1 ``run_etl``   raw feeds -> dedup + validation (staged once as bucketed tables, reject
                 stats observed) -> quarantine CSVs -> match on the bucketed tables (no
                 shuffle): matched -> processed Parquet (year/month/day); one full outer
                 pass -> unmatched CSV with the match stats observed -> report
                 -> analytics and questions on the written Parquet -> optional ML.
B2 ``run_from_processed``  processed Parquet -> analytics, questions, optional ML.

Why staged: the raw CSV is parsed and deduplicated exactly once; every later output
(quarantine files, stats, match, report) reads the staged Parquet, so nothing is
recomputed per action and the lineage is cut (an executor loss re-reads Parquet, it
does not re-parse CSV). The staged tables are bucketed on the match key with the
same bucket count, so the sort-merge join of trips and fares needs no exchange.
All analytics read the written processed table, so every result comes from the
same bytes.
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cabflow.operators import kpis, matching, ml, partials, profile, quality, questions
from cabflow.operators.enrich import add_ymd, analytics_base, question_base
from cabflow.operators.report import etl_report
from cabflow.schemas import FARE_SCHEMA, KEY, TRIP_SCHEMA
from cabflow.session import Sizes, build_session, input_bytes, remove_path, scratch_dir, sized_for, sizes_for
from cabflow.sinks import manifest, writers
from cabflow.sources import feeds, malformed


# The folders and file names below the output root, and the option names and defaults
# of the command line.
@dataclass
class Paths:
    output_root: str

    @property
    def processed(self) -> str:
        return f"{self.output_root.rstrip('/')}/processed"

    @property
    def quarantine(self) -> str:
        return f"{self.output_root.rstrip('/')}/quarantine"

    @property
    def analytics(self) -> str:
        return f"{self.processed}/analytics"

    @property
    def questions(self) -> str:
        return f"{self.analytics}/questions"

    @property
    def staging(self) -> str:
        return f"{self.output_root.rstrip('/')}/_staging"

    @property
    def partials(self) -> str:
        return f"{self.processed}/profile_partials"

    @property
    def models(self) -> str:
        return f"{self.processed}/models"


@dataclass
class RunResult:
    status: str = "ok"
    report: DataFrame | None = None
    outputs: dict[str, str] = field(default_factory=dict)


def stage_bucketed(df: DataFrame, name: str, buckets: int, root: str | None = None,
                   registry: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once below ``root``, bucketed on the key (the join sorts each bucket itself),
    register it (external table) under a unique name and return the table. Name and
    folder go to ``registry``, so the caller can drop both afterwards."""
    spark = df.sparkSession
    table = f"cabflow_{name}_{uuid.uuid4().hex[:10]}"
    path = scratch_dir(spark, name, root)
    if registry is not None:
        registry[table] = path
    df.write.bucketBy(buckets, *KEY).option("path", path).mode("overwrite").saveAsTable(table)
    return spark.table(table)


def run_etl(
    spark: SparkSession,
    trips_raw: DataFrame,
    fares_raw: DataFrame,
    output_root: str,
    weather: DataFrame | None = None,
    holidays: DataFrame | None = None,
    train_ml: bool = False,
    ml_params: ml.ModelParams | None = None,
    analytics: bool = True,
    sizes: Sizes | None = None,
    incremental: bool = False,
    track_changes: bool = False,
) -> RunResult:
    """``track_changes``: only days whose input differs from the manifest's are matched and written (see
    ``sinks.manifest``). ``sizes`` (see ``session.sizes_for``) hold for the ETL alone; the aggregates after it run
    with the session's own width."""
    p = Paths(output_root)
    res = RunResult()
    with sized_for(spark, sizes):
        _etl(spark, p, res, trips_raw, fares_raw, sizes, track_changes)
    if analytics:
        res.outputs.update(run_from_processed(
            spark, output_root, weather, holidays, train_ml, ml_params, incremental).outputs)
    return res


def _etl(spark: SparkSession, p: Paths, res: RunResult, trips_raw: DataFrame, fares_raw: DataFrame,
         sizes: Sizes | None, track_changes: bool = False) -> None:
    buckets = sizes.buckets if sizes else int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged: dict[str, str] = {}
    faults = {}
    checked = {"trips": (trips_raw, TRIP_SCHEMA), "fares": (fares_raw, FARE_SCHEMA)}
    if malformed.is_checked(trips_raw):
        trips_raw, faults["trips"] = malformed.observe_faults(trips_raw, TRIP_SCHEMA, "trips")
    if malformed.is_checked(fares_raw):
        fares_raw, faults["fares"] = malformed.observe_faults(fares_raw, FARE_SCHEMA, "fares")
    try:
        # 1. one pass over each raw feed: dedup + tag, staged as bucketed Parquet; the
        #    reject stats are observed during these writes (no second pass for them).
        obs_t_df, obs_t = quality.observe_stats(
            quality.validated_trips(trips_raw, multiplicity=quality.MULTIPLICITY), "trips")
        obs_f_df, obs_f = quality.observe_stats(
            quality.validated_fares(fares_raw, multiplicity=quality.MULTIPLICITY), "fares")
        tt = stage_bucketed(obs_t_df, "trips_tagged", buckets, p.staging, staged)
        tf = stage_bucketed(obs_f_df, "fares_tagged", buckets, p.staging, staged)
        good_t, bad_t = quality.split(tt)
        good_f, bad_f = quality.split(tf)
        trip_stats = quality.stats_from_observation(spark, obs_t, "trips")
        fare_stats = quality.stats_from_observation(spark, obs_f, "fares")
        if "trips" in faults:
            trip_stats = trip_stats.unionByName(malformed.faults_from_observation(spark, faults["trips"], "trips"))
        if "fares" in faults:
            fare_stats = fare_stats.unionByName(malformed.faults_from_observation(spark, faults["fares"], "fares"))

        # 2. quarantine: parallel CSV writers over the staged tables.
        writers.write_csv(bad_t, f"{p.quarantine}/invalid_trips.csv")
        writers.write_csv(bad_f, f"{p.quarantine}/invalid_fares.csv")
        for feed, seen in faults.items():
            if seen.get[malformed.ROWS]:  # another scan of the feed, only if there is something to keep
                writers.write_csv(malformed.quarantine(*checked[feed]), f"{p.quarantine}/malformed_{feed}.csv")

        # 3. match on the bucketed tables (sort-merge join, no exchange). The join runs twice:
        #    once for the matched rows (Inner) -> processed layout, and once as a full outer
        #    pass that writes the unmatched table while the match stats are observed.
        table = f"{p.processed}/{feeds.PROCESSED_TABLE}"
        if track_changes:
            digests = manifest.input_digests(good_t, good_f)
            days = manifest.changed_days(digests, manifest.current(spark, table))
            print(f"days to match: {len(days)} of {len(digests)}")
            if days:
                t, f = manifest.of_days(good_t, days), manifest.of_days(good_f, days)
                matched = matching.match(t, f)[matching.MATCHED]
                manifest.publish(matched, table, days, digests, pieces=writers.day_pieces(t))
        else:
            out = matching.match(good_t, good_f)
            writers.write_processed(out[matching.MATCHED], table, pieces=writers.day_pieces(good_t))
        unmatched, match_obs = matching.unmatched_with_stats(good_t, good_f)
        writers.write_csv(unmatched, f"{p.quarantine}/unmatched_data.csv")
        match_stats = matching.stats_from_observation(spark, match_obs)

        # 4. report: a few rows; written as one CSV.
        report = etl_report(trip_stats, fare_stats, match_stats)
        writers.write_csv(report, f"{p.processed}/etl_report.csv", single_file=True)
        res.report = spark.read.option("header", True).csv(f"{p.processed}/etl_report.csv")
        res.outputs["processed"] = f"{p.processed}/{feeds.PROCESSED_TABLE}"
    finally:
        # This run's staged copies: catalog entries and folders.
        for name, path in staged.items():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            remove_path(spark, path)


def run_analytics(base_input: DataFrame, analytics_root: str, exact_percentiles: bool = False,
                  partials_root: str | None = None) -> dict[str, str]:
    """Overview JSON, numeric stats, KPI tables (one grouping-sets pass, written once,
    then split per segment from the written copy) and the long summary table. With ``partials_root`` the three are
    merged from the per-day partials there (see ``operators.partials``) and no trip is read."""
    spark = base_input.sparkSession
    base = analytics_base(add_ymd(base_input))
    outs = {}
    ov_path = f"{analytics_root}/overview.json"
    stats_path = f"{analytics_root}/numeric_stats"
    if partials_root:
        writers.write_parquet(writers.one_partition(partials.numeric_stats(spark, partials_root)), stats_path)
        writers.write_json_doc(profile.with_schema(partials.overview(spark, partials_root), base), ov_path)
        grouped = partials.kpi_grouping_sets(spark, partials_root)
    else:
        grouped = None
    if grouped is None:
        grouped = kpis.kpi_grouping_sets(base, exact=exact_percentiles)
    if not partials_root:
        seen, stats = profile.overview_and_stats(base)
        writers.write_parquet(writers.one_partition(stats), stats_path)  # one scan fills the overview too
        writers.write_json_doc(profile.overview_from_observation(base, seen), ov_path)
    outs["overview"] = ov_path
    writers.write_csv(spark.read.parquet(stats_path), f"{analytics_root}/numeric_stats_csv", single_file=True)
    grouped_path = f"{analytics_root}/kpi_grouping_sets"
    writers.write_parquet(writers.one_partition(grouped), grouped_path)
    grouped = spark.read.parquet(grouped_path)
    for seg in kpis.SEGMENTS:
        writers.write_csv(kpis.kpi_segment(grouped, seg), f"{analytics_root}/{seg}", single_file=True)
        outs[seg] = f"{analytics_root}/{seg}"
    ov = spark.read.json(ov_path)
    numeric = spark.read.parquet(stats_path)
    summary = kpis.kpi_summary_long(ov, numeric, grouped)
    writers.write_csv(summary, f"{analytics_root}/analytics_summary", single_file=True)
    outs["summary"] = f"{analytics_root}/analytics_summary"
    return outs


def run_questions(base_input: DataFrame, questions_root: str, weather: DataFrame | None,
                  holidays: DataFrame | None = None) -> dict[str, str]:
    base = question_base(base_input, holidays=holidays, weather=weather)
    outs = {}
    months = scratch_dir(base_input.sparkSession, "months")
    writers.write_parquet(writers.one_partition(questions.q4_vendor_mom(base)), months)  # an input of two questions
    mom = base_input.sparkSession.read.parquet(months)
    shared = {questions.MONTHS: mom, questions.STREAK: questions.q4_growth_streak(mom)}
    try:
        for name, df in (questions.business_questions(base) | shared).items():
            path = f"{questions_root}/{name}.csv"
            writers.write_csv(df, path, single_file=True, sort_by=questions.SORT_KEYS.get(name))
            outs[name] = path
    finally:
        remove_path(base_input.sparkSession, months)
    return outs


def run_from_processed(
    spark: SparkSession,
    output_root: str,
    weather: DataFrame | None = None,
    holidays: DataFrame | None = None,
    train_ml: bool = False,
    ml_params: ml.ModelParams | None = None,
    incremental: bool = False,
) -> RunResult:
    """``incremental``: the analytics come from per-day partials, of which only those of changed days are made anew."""
    p = Paths(output_root)
    res = RunResult()
    processed = feeds.load_processed(spark, p.processed)
    show_input(processed, "processed trips")
    if incremental:
        days = partials.refresh(spark, p.processed, p.partials)
        print(f"profile partials: {len(days)} days read")
    res.outputs.update(run_analytics(processed, p.analytics, partials_root=p.partials if incremental else None))
    res.outputs.update(run_questions(processed, p.questions, weather, holidays))
    if train_ml:
        metrics = ml.run_ml(processed, output_path=p.models, params=ml_params)
        writers.write_csv(metrics, f"{p.models}/metrics", single_file=True)
        res.outputs["ml_metrics"] = f"{p.models}/metrics"
    return res


def show_input(df: DataFrame, name: str) -> None:
    """Schema and first rows of an input, for the log of the run."""
    print(name)
    df.printSchema()
    feeds.preview(df).show(truncate=False)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description="Trip and fare ETL, analytics and models on Spark")
    ap.add_argument("--data-root", default=os.environ.get("DATA_ROOT", "/data/nyc"))
    ap.add_argument("--output-root", default=os.environ.get("OUTPUT_ROOT", "/data"))
    ap.add_argument("--trips", default=None, help="trip CSV file, directory or glob (overrides --data-root)")
    ap.add_argument("--fares", default=None, help="fare CSV file, directory or glob (overrides --data-root)")
    ap.add_argument("--sample", action="store_true", help="read one file of each feed")
    ap.add_argument("--parquet-only", action="store_true", help="skip ingestion; use the processed Parquet")
    ap.add_argument("--weather-path", default=os.environ.get("WEATHER_CSV_PATH"))
    ap.add_argument("--refresh-weather", action="store_true", help="re-prepare weather even if a copy exists")
    ap.add_argument("--train-ml", action="store_true")
    ap.add_argument("--incremental", action="store_true",
                    help="profile and KPIs from per-day partials; only days whose files changed are read")
    ap.add_argument("--bind-by-position", action="store_true",
                    help="take the columns of the raw files in the order of the schema, whatever their headers say")
    ap.add_argument("--track-changes", action="store_true",
                    help="keep a manifest of the processed days; match and write only days whose input changed")
    ap.add_argument("--no-autosize", action="store_true",
                    help="keep spark.sql.shuffle.partitions as configured instead of sizing it from the input")
    args = ap.parse_args(argv)

    spark = build_session("cabflow-etl")
    p = Paths(args.output_root)
    status = 1
    try:
        weather = feeds.load_or_prepare_weather(spark, p.processed, args.weather_path, refresh=args.refresh_weather,
                                                default_csv=f"{args.data_root.rstrip('/')}/{feeds.WEATHER_CSV}")
        if weather is None:
            print("weather: no prepared copy and no CSV; weather questions are skipped")
        if args.parquet_only:
            run_from_processed(spark, args.output_root, weather, train_ml=args.train_ml, incremental=args.incremental)
        else:
            trips_path = feeds.trips_path(spark, args.trips, args.data_root, args.sample)
            fares_path = feeds.fares_path(spark, args.fares, args.data_root, args.sample)
            sizes = None
            if not args.no_autosize:
                current = int(spark.conf.get("spark.sql.shuffle.partitions"))
                sizes = sizes_for(input_bytes(spark, [trips_path, fares_path]), current)
                print(f"sized from input: {sizes}")
            how = {"by_name": not args.bind_by_position, "checked": True}
            trips, fares = feeds.load_trips(spark, trips_path, **how), feeds.load_fares(spark, fares_path, **how)
            show_input(trips, "trips")
            show_input(fares, "fares")
            res = run_etl(spark, trips, fares, args.output_root, weather, train_ml=args.train_ml, sizes=sizes,
                          incremental=args.incremental, track_changes=args.track_changes)
            res.report.show(truncate=False)
        status = 0
        print("completed successfully")
    except Exception as e:  # noqa: BLE001 - report the failure truthfully, then re-raise
        print(f"FAILED: {type(e).__name__}: {e}", file=sys.stderr)
        raise
    finally:
        spark.stop()
    return status


if __name__ == "__main__":
    sys.exit(main())
