import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabflow.operators import kpis, profile, questions
from cabflow.operators.quantiles import grouped_exact_quantiles
from cabflow.plans import flow
from tests.conftest import SF001


def _mom(spark, values):
    rows = [("V", 2013, m + 1, float(v)) for m, v in enumerate(values)]
    df = spark.createDataFrame(rows, "vendor_id string, year int, month int, cost_per_km double")
    return questions.q4_vendor_mom(df)


def test_streak_counts_base_row(spark):
    # 5, 6, 7 (two rises) then 4, 5 (one rise): longest island is 3 rows incl. its base
    out = questions.q4_growth_streak(_mom(spark, [5, 6, 7, 4, 5])).first()
    assert out["longest_growth_streak_months"] == 3 and out["growth_steps"] == 2


def test_vendor_without_rise_is_absent(spark):
    assert questions.q4_growth_streak(_mom(spark, [5, 4, 3])).count() == 0


def test_lag_is_previous_row_not_month(spark):
    rows = [("V", 2013, 1, 1.0), ("V", 2013, 3, 4.0)]
    df = spark.createDataFrame(rows, "vendor_id string, year int, month int, cost_per_km double")
    out = questions.q4_vendor_mom(df).orderBy("month").collect()
    assert out[1]["lag_avg"] == 1.0 and out[1]["mom_change"] == 3.0


@pytest.fixture(scope="module")
def abase(spark):
    return flow.fixture_analytics_base(spark, SF001).cache()


def test_grouping_sets_equal_separate_kpis(spark, abase):
    grouped = kpis.kpi_grouping_sets(abase, exact=True)
    sep = kpis.segmented_kpis(abase, exact=True)
    for name, df in sep.items():
        a = sorted(kpis.kpi_segment(grouped, name).collect(), key=repr)
        b = sorted(df.collect(), key=repr)
        assert len(a) == len(b)
        for ra, rb in zip(a, b):
            for x, y in zip(ra, rb):
                assert (x == y) or (isinstance(x, float) and abs(x - y) < 1e-6 * max(1, abs(y)))


def test_exact_kpis_of_one_segment_compute_the_trips_once(spark, monkeypatch):
    """Only the named segment is built, and its aggregate and its percentiles read one staged copy."""
    rows = [(1, 2, 2013, 1, "CRD", "CMT", 1, float(i), 1.0, 2.0, 3.0) for i in range(100)]
    df = spark.createDataFrame(rows, "pickup_hour int, pickup_dow int, year int, month int, payment_type string, vendor_id string, "
                                     "passenger_count int, total_amount double, cost_per_km double, cost_per_min double, avg_speed_kmh double")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    ranked, real = [], kpis.grouped_exact_quantiles
    monkeypatch.setattr(kpis, "grouped_exact_quantiles", lambda df, cols, *a: ranked.append(list(cols)) or real(df, cols, *a))
    out = kpis.segmented_kpis(df.mapInPandas(counted, df.schema), exact=True, only=["kpi_by_hour"])
    got = [tuple(r) for r in out["kpi_by_hour"].collect()]
    assert list(out) == ["kpi_by_hour"] and ranked == [["pickup_hour"]] and seen.value == 100
    assert got == [(1, 49.5, 49.0, 94.0, 1.0, 2.0, 3.0, 100, 4950.0)]


def test_kpi_trips_sum_to_rows(spark, abase):
    n = abase.count()
    for name, df in kpis.segmented_kpis(abase).items():
        assert df.agg(F.sum("trips")).first()[0] == n, name


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=500), np.full(400, 3.0)])  # a hot value
    rows = [("a" if i % 3 else None, float(v)) for i, v in enumerate(vals)] + [("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.01, 0.5, 0.95, 1.0]
    out = {r["g"]: r for r in grouped_exact_quantiles(df, ["g"], "v", probs, ["a", "b", "c", "d"]).collect()}
    assert "empty" not in out
    for g in ("a", None):
        xs = np.sort([v for gg, v in rows if gg == g and v is not None])
        for name, p in zip("abcd", probs):
            assert out[g][name] == xs[max(1, int(np.ceil(p * len(xs)))) - 1]


def test_profile_exact_vs_approx(spark, abase):
    ex = {r["column"]: r for r in profile.exact_quantiles(abase).collect()}
    st = {r["column"]: r for r in profile.numeric_stats(abase).collect()}
    assert list(ex) == profile.numeric_columns(abase)
    for c, r in ex.items():
        assert st[c]["min"] <= r["p01"] <= r["p50"] <= r["p99"] <= st[c]["max"]
        assert st[c]["count"] + st[c]["null_count"] == abase.count()


def test_overview_document_json(spark, abase, tmp_path):
    import json

    from cabflow.sinks import writers

    writers.write_json_doc(profile.overview_document(abase), str(tmp_path / "ov"))
    text = [ln for p in (tmp_path / "ov").glob("part-*") for ln in p.read_text().splitlines() if ln]
    doc = json.loads(text[0])
    assert doc["row_count"] == abase.count() and doc["num_columns"] == len(abase.columns)
    assert doc["schema"][0] == {"name": "medallion", "type": "string"}
    assert doc["min_pickup_datetime"] <= doc["max_pickup_datetime"]


def test_exact_quantiles_need_no_exchange_reuse(spark):
    """The same answer with exchange reuse on and off, for a hot group, a hot value and groups
    larger than the sketch is exact for."""
    n = 60000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 9 == 0, F.lit(7.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**6)) / 7).alias("v"),
    )
    values = {}
    for r in df.collect():
        values.setdefault(r.g, []).append(r.v)
    probs, names = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0], list("abcdef")
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r.g: r for r in grouped_exact_quantiles(df, ["g"], "v", probs, names).collect()}
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert got.keys() == values.keys()
        for g, xs in values.items():
            xs = sorted(xs)
            assert [got[g][m] for m in names] == [xs[max(1, int(np.ceil(p * len(xs)))) - 1] for p in probs], (g, reuse)


def test_rank_bounds_tell_good_from_bad(spark):
    from cabflow.operators.quantiles import rank_bounds_hold

    df = spark.range(20000).select(F.lit("x").alias("g"), F.col("id").cast("double").alias("v"))
    for value, holds in ((9999.0, True), (9800.0, True), (9700.0, False), (10300.0, False)):
        told = spark.createDataFrame([("x", value)], "g string, p double")
        assert rank_bounds_hold(df, ["g"], "v", told, [0.5], ["p"], 100).first()["p"] == holds


def test_summary_is_one_pass_over_the_segments(spark, abase):
    grouped = kpis.kpi_grouping_sets(abase)
    numeric = profile.numeric_stats(abase)
    plan = kpis.kpi_summary_long(profile.overview_document(abase), numeric, grouped)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand [") == 1


def test_no_job_runs_while_a_plan_is_built(spark):
    from cabflow.sources import fixtures

    tracker = spark.sparkContext.statusTracker()
    m, w, trips = flow.fixture_matched(spark, SF001), flow.fixture_weather(spark, SF001), fixtures.trips_raw(spark, SF001)
    spark.sparkContext.setJobGroup("plans", "plans")
    questions.business_questions(flow.question_base(m, weather=w))
    flow.question_base(m, holidays=flow_holidays(trips))
    assert not tracker.getJobIdsForGroup("plans")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def flow_holidays(trips):
    from cabflow.sources.dims import holidays_covering

    return holidays_covering(trips)


def test_holiday_flag_has_no_year_limit(spark):
    from cabflow.operators.enrich import add_holidays

    df = spark.sql("SELECT explode(array(timestamp'1850-07-04 10:00:00', timestamp'2350-12-25 00:00:00', timestamp'2350-12-24 00:00:00', NULL)) AS pickup_datetime")
    assert [r.is_holiday for r in add_holidays(df).collect()] == [1, 1, 0, 0]


def test_overview_is_observed_on_the_stats_scan(spark, abase):
    seen, stats = profile.overview_and_stats(abase)
    assert stats.count() == len(profile.numeric_columns(abase))
    assert profile.overview_from_observation(abase, seen).first() == profile.overview_document(abase).first()


def _rounds(monkeypatch, bound):
    """Patch the bound; returns the list of the largest open interval that each final ranking saw, and of rounds."""
    from cabflow.operators import quantiles

    seen, rounds = [], []
    monkeypatch.setattr(quantiles, "BOUND", bound)
    narrow, rest = quantiles._narrow, quantiles._rank_rest

    def ranked(vals, state, keys, names):
        open_rows = [F.when(F.col(f"_x{i}").isNull(), F.col(f"_m{i}")).otherwise(0) for i in range(len(names))]
        seen.append(state.agg(F.max(F.greatest(*open_rows, F.lit(0)))).first()[0])
        return rest(vals, state, keys, names)

    monkeypatch.setattr(quantiles, "_narrow", lambda *a: rounds.append(1) or narrow(*a))
    monkeypatch.setattr(quantiles, "_rank_rest", ranked)
    return seen, rounds


def _sorted_pick(values, p):
    return sorted(values)[max(1, math.ceil(p * len(values))) - 1]


def test_exact_quantiles_take_rounds_on_a_continuous_column(spark, monkeypatch):
    seen, rounds = _rounds(monkeypatch, 100)
    probs, names = [0.0, 0.01, 0.5, 0.777, 1.0], ["a", "b", "c", "d", "e"]
    rnd = random.Random(11)
    rows = [("hot", rnd.lognormvariate(0, 3)) for _ in range(60_000)]  # all different
    rows += [("ties", float(rnd.randrange(3))) for _ in range(5_000)] + [("one", 7.0)] * 3_000 + [(None, rnd.random()) for _ in range(400)]
    rows += [("few", v) for v in (3.0, None, 1.0, float("-inf"), float("inf"))] + [("none", None)] * 300
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: tuple(r[n] for n in names) for r in grouped_exact_quantiles(df, ["g"], "v", probs, names).collect()}
    want = {}
    for g in {g for g, v in rows if v is not None}:
        want[g] = tuple(_sorted_pick([v for h, v in rows if h == g and v is not None], p) for p in probs)
    assert got == want
    assert len(rounds) >= 2 and seen[0] <= 100
    whole = grouped_exact_quantiles(df, [], "v", probs, names).collect()
    assert [tuple(r) for r in whole] == [tuple(_sorted_pick([v for _, v in rows if v is not None], p) for p in probs)]
    assert len(rounds) >= 4 and max(seen) <= 100
    empty = grouped_exact_quantiles(df.filter("g = 'none'"), ["g"], "v", probs, names)
    assert empty.collect() == [] and empty.columns == ["g", *names]


def test_a_bad_sketch_costs_rounds_not_the_result(spark, monkeypatch):
    """With cuts far from the wanted rank (a sketch of 8 parts and of poor accuracy) the answer is the same."""
    from cabflow.operators import quantiles

    seen, rounds = _rounds(monkeypatch, 200)
    monkeypatch.setattr(quantiles, "GRID", 8)
    monkeypatch.setattr(quantiles, "ACCURACY", 60)
    rnd = random.Random(5)
    values = [rnd.choice([rnd.random(), 0.5]) for _ in range(3_000)]
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    row = grouped_exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], ["a", "b", "c"]).first()
    assert (row.a, row.b, row.c) == tuple(_sorted_pick(values, p) for p in (0.1, 0.5, 0.9))
    assert len(rounds) >= 2 and seen[0] <= 200
