"""Queries with rounds compute the match once, from fine splits, and stack no copy of its rows on disk."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cabflow import session
from cabflow.operators import ml, quantiles
from cabflow.plans import flow, registry
from tests.test_input_sizes import LINEITEM


@pytest.fixture()
def sf(spark, tmp_path):
    rows = [(k, 2 + k, 1 + k % 3, n, 5.0 + n, 20000.0 + 100 * k, 0.05, 0.02, "N" if k % 2 else "R", "F",
             datetime(1996, 3, 1) + timedelta(days=k)) for k in range(1, 21) for n in (2, 3, 4)]
    spark.createDataFrame(rows, LINEITEM).repartition(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    yield str(tmp_path)
    spark.conf.unset(session.INITIAL_WIDTH)


def scratch(spark):
    root = f"{session.checkpoint_root(spark)}/cabflow"
    return {d for d in os.listdir(root) if not d.startswith((".", "kpis-", "summary-", "quantiles-"))} if os.path.isdir(root) else set()


@pytest.mark.parametrize("name", ["kpi_grouping_sets", "kpi_summary_long"])
def test_the_match_runs_once(spark, sf, monkeypatch, name):
    want = sorted(map(repr, registry.QUERIES[name](spark, sf).collect()))
    seen, splits, copies = spark.sparkContext.accumulator(0), [], []

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    base, real = flow.fixture_analytics_base, quantiles.kept

    def counted(*a):
        splits.append(spark.conf.get(session.SPLIT))
        df = base(*a)
        return df.mapInArrow(count, df.schema)

    monkeypatch.setattr(session, "COLUMNAR_SPLIT_BYTES", 4096)
    monkeypatch.setattr(flow, "fixture_analytics_base", counted)
    monkeypatch.setattr(quantiles, "kept", lambda df, path: copies.append(path) or real(df, path))
    before, default = scratch(spark), spark.conf.get(session.SPLIT)
    got = sorted(map(repr, registry.QUERIES[name](spark, sf).collect()))
    assert got == want and len(got) > 5
    assert seen.value == flow.fixture_matched(spark, sf).count() > 0
    assert splits == ["4096"] and spark.conf.get(session.SPLIT) == default
    assert not [p for p in copies if p.endswith("/values")] and scratch(spark) == before


@pytest.mark.parametrize("name", ["ml_metrics_all", "ml_metrics_ranges"])
def test_ml_reads_fine_splits(spark, sf, monkeypatch, name):
    monkeypatch.setattr(session, "COLUMNAR_SPLIT_BYTES", 4096)
    seen = []
    monkeypatch.setattr(ml, "run_ml", lambda df: seen.append(spark.conf.get(session.SPLIT)) or spark.createDataFrame(
        [("regression", "m", "RMSE", 1.0), ("regression", "m", "MAE", 1.0)], "task string, model string, metric string, value double"))
    assert registry.QUERIES[name](spark, sf).count() == 2 and seen == ["4096"]


def test_shuffle_files_of_a_staged_table_go_with_its_write(spark, tmp_out):
    before = spark.conf.get(session.CLEANUP)
    seen = []
    with session.staging(spark):
        seen.append(spark.conf.get(session.CLEANUP))
    kept = quantiles.kept(spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count(), f"{tmp_out}/t")
    assert seen == ["true"] and spark.conf.get(session.CLEANUP) == before and kept.count() == 7
