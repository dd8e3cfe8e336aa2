"""Shuffle width and split size of the queries over the feeds follow their input."""

import re
from datetime import datetime, timedelta

import pytest

from cabflow import session
from cabflow.plans import flow, registry

LINEITEM = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"


@pytest.fixture()
def sf(spark, tmp_path):
    """60 line items of 20 orders; the session's width is put back after the test."""
    rows = [(k, 2 + k, 1 + k % 3, n, 5.0 + n, 20000.0 + 100 * k, 0.05, 0.02, "N" if k % 2 else "R", "F",
             datetime(1996, 3, 1) + timedelta(days=k)) for k in range(1, 21) for n in (2, 3, 4)]
    spark.createDataFrame(rows, LINEITEM).repartition(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k, datetime(1996, 3, 1) + timedelta(days=k)) for k in range(1, 21)], ORDERS).write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.conf.unset(session.INITIAL_WIDTH)
    yield str(tmp_path)
    spark.conf.unset(session.INITIAL_WIDTH)


def widths(df):
    return {int(n) for n in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), ENSURE", df._jdf.queryExecution().executedPlan().toString())}


def test_width_is_linear_in_the_input_and_never_lowered():
    target = session.TARGET_COLUMNAR_BYTES
    assert session.width_for_columnar(10 * target, 12) == 12
    assert session.width_for_columnar(400 * target, 12) == 400
    assert session.width_for_columnar(10**15, 12) == session.MAX_WIDTH
    assert session.width_for_columnar(10**15, 60_000) == 60_000


def test_splits_are_never_raised_and_stay_within_the_bookkeeping():
    assert session.split_for_columnar(10**9, 128 << 20) == session.COLUMNAR_SPLIT_BYTES
    assert session.split_for_columnar(10**9, 1 << 20) == 1 << 20
    assert session.split_for_columnar(3 * 10**12, 128 << 20) == 3 * 10**12 // session.MAX_WIDTH


@pytest.mark.parametrize("name", ["feat_utc_hour", "feat_precip_bin"])
def test_lazy_queries_start_with_partitions_for_their_input(spark, sf, monkeypatch, name):
    plain = registry.QUERIES[name](spark, sf)
    rows = sorted(map(repr, plain.collect()))
    assert rows and widths(plain) == {4}  # the session's own
    nbytes = session.input_bytes(spark, [f"{sf}/lineitem.parquet"])
    monkeypatch.setattr(session, "TARGET_COLUMNAR_BYTES", -(-nbytes // 40))
    wide = registry.QUERIES[name](spark, sf)
    assert min(widths(wide)) >= 39 and sorted(map(repr, wide.collect())) == rows
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_jobs_run_when_called_read_finer_splits_which_end_with_them(spark, sf, monkeypatch):
    before = spark.conf.get(session.SPLIT)
    monkeypatch.setattr(session, "COLUMNAR_SPLIT_BYTES", 4096)
    seen = []
    base = flow.fixture_analytics_base
    monkeypatch.setattr(flow, "fixture_analytics_base", lambda *a: (seen.append(spark.conf.get(session.SPLIT)), base(*a))[1])
    rows = registry.QUERIES["kpi_by_vendor"](spark, sf).collect()
    assert seen == ["4096"] and sum(r.trips for r in rows) == flow.fixture_matched(spark, sf).count() > 0
    assert spark.conf.get(session.SPLIT) == before


def test_a_split_sorts_in_half_a_gigabyte(spark):
    """The map side of the dedup holds and sorts some 35 bytes for each byte of its split (measured on 24 x sf0.1)."""
    default = int(spark.conf.get(session.SPLIT).removesuffix("b"))
    for nbytes in (10**8, 10**9, 6 * 10**9, 10**11):
        assert 36 * session.split_for_columnar(nbytes, default) <= 512 << 20
