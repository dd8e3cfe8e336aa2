"""Benchmark: the full job and each business question at one scale factor.

Setup (not timed): the driver's tables are mapped to the raw trip / fare / weather
feeds and written as CSV, the job's real input format. Timed, in order:

  etl        CSV -> dedup + validation (staged, bucketed) -> quarantine + stats ->
             full outer match -> processed Parquet (year/month/day) -> report
  weather    weather CSV -> hourly Parquet
  analytics  overview, numeric stats, KPI grouping sets, six KPI files, summary
  q1..q6     each question alone on the processed Parquet (+ holidays, region, weather)

A warm-up (not timed) first runs the same pipeline once on the sibling sf0.001 tables, when
present, so the figures are steady-state rather than JIT start-up (BENCH_WARMUP=0 skips it).

Prints one JSON line: {"metric", "value" (sum of timed parts), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cabflow.operators import questions  # noqa: E402
from cabflow.operators.enrich import question_base  # noqa: E402
from cabflow.plans import job  # noqa: E402
from cabflow.session import build_session  # noqa: E402
from cabflow.sinks import writers  # noqa: E402
from cabflow.sources import feeds, fixtures  # noqa: E402


def warm_up(spark, sf_dir: str, root: str) -> None:
    """Run the whole timed pipeline once on a small input, untimed."""
    for name, df in (("trips", fixtures.trips_raw(spark, sf_dir)), ("fares", fixtures.fares_raw(spark, sf_dir)),
                     ("weather", fixtures.weather_csv_frame(spark, sf_dir))):
        writers.write_csv(df, f"{root}/in/{name}")
    job.run_etl(spark, feeds.load_trips(spark, f"{root}/in/trips"), feeds.load_fares(spark, f"{root}/in/fares"),
                f"{root}/out", analytics=False)
    p = job.Paths(f"{root}/out")
    weather = feeds.load_or_prepare_weather(spark, p.processed, f"{root}/in/weather")
    processed = feeds.load_processed(spark, p.processed)
    job.run_analytics(processed, p.analytics)
    for df in questions.business_questions(question_base(processed, weather=weather)).values():
        df.collect()


def _driver_memory() -> str:
    """8g, or 60 % of physical memory on smaller machines."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(8, int(total * 0.6 / 2**30)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(
        "cabflow-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * cpus),
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", _driver_memory()),
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    root = tempfile.mkdtemp(prefix="cabflow-bench-", dir=os.environ.get("BENCH_TMP", "/tmp"))
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warmed = os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warm_dir) and warm_dir != sf_dir.rstrip("/")
    if warmed:
        warm_up(spark, warm_dir, f"{root}/warm")
    inp, out = f"{root}/in", f"{root}/out"
    writers.write_csv(fixtures.trips_raw(spark, sf_dir), f"{inp}/trips")
    writers.write_csv(fixtures.fares_raw(spark, sf_dir), f"{inp}/fares")
    writers.write_csv(fixtures.weather_csv_frame(spark, sf_dir), f"{inp}/weather")

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        r = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return r

    trips = feeds.load_trips(spark, f"{inp}/trips")
    fares = feeds.load_fares(spark, f"{inp}/fares")
    res = timed("etl", lambda: job.run_etl(spark, trips, fares, out, analytics=False))
    report = {r["metric"]: int(r["value"]) for r in res.report.collect() if r["source"] == "match"}
    p = job.Paths(out)
    weather = timed("weather", lambda: feeds.load_or_prepare_weather(spark, p.processed, f"{inp}/weather"))
    processed = feeds.load_processed(spark, p.processed)
    timed("analytics", lambda: job.run_analytics(processed, p.analytics))

    base = question_base(processed, weather=weather)
    mom = questions.q4_vendor_mom(base)
    qs = {
        "q1": lambda: questions.q1_hourly_weekend(base),
        "q2": lambda: questions.q2_tips(base),
        "q3": lambda: questions.q3_evening_peak(base),
        "q4a": lambda: mom,
        "q4b": lambda: questions.q4_growth_streak(mom),
        "q5a": lambda: questions.q5_condition_hour(base),
        "q5b": lambda: questions.q5_precip_wind_hour(base),
        "q6": lambda: questions.q6_high_value_share(base),
    }
    rows = {}
    for name, build in qs.items():
        rows[name] = len(timed(name, lambda b=build: b().collect()))

    print(json.dumps({
        "metric": "etl_analytics_questions_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "warmup": bool(warmed),
        "rows": {"matched": report.get("matched_records"), **rows},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
