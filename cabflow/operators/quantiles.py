"""Exact discrete quantiles per group, and a check of approximate ones.

For probability p over the n non-NULL values of a group, the result is the value at
rank ``max(1, ceil(p * n))`` in ascending order.

How: selection in rounds. For every group and probability an open interval is known in which the value must lie,
at first without ends, with the number of rows in it. A round takes a bounded sketch of the rows inside
and two of its values around the wanted rank, and counts the rows below, at, between and above them.
Then either the rank falls on one of the two values, which is the answer however many rows tie there, or the
interval shrinks to one of the gaps, mostly that between them (some ``4 / GRID`` of its rows). The sketch only
chooses where to cut: a bad cut costs another round, never the result. When no interval holds more than ``BOUND``
rows, those left are counted by value and a running count finds the ranks; so no window ever sees more rows
than ``BOUND`` of a group. 1e12 rows of a continuous column take three rounds.

The values are written once (keys and value alone), so that no round repeats the work before, unless they are read
from files as they are; the copy is removed. A hot group is spread like any other: rounds are aggregates with a partial step in each task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabflow.session import remove_path, scratch_dir, staging

# Rows of a group that one window may rank; beyond it another round narrows the interval.
BOUND = 100_000
# Parts of the sketch between whose borders an interval is cut, and the accuracy of the sketch.
GRID, ACCURACY = 1000, 10_000


def _null_safe_on(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    conds = [left[c].eqNullSafe(right[c]) for c in cols]
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def _join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of their group, matched null-safely on ``keys``."""
    named = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    conds = [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    on = reduce(lambda a, b: a & b, conds) if conds else F.lit(True)
    return rows.join(named, on).drop(*[f"_g_{k}" for k in keys])


def _rank(p: float, n: str = "_n") -> Column:
    return F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col(n)))


def _inside(i: int) -> Column:
    """Whether the value lies in the group's open interval for probability i, and is still sought."""
    v, a, b = F.col("_v"), F.col(f"_a{i}"), F.col(f"_b{i}")
    return F.col(f"_x{i}").isNull() & (a.isNull() | (v > a)) & (b.isNull() | (v < b))


def _too_many(i: int) -> Column:
    return F.col(f"_x{i}").isNull() & (F.col(f"_m{i}") > BOUND)


def _first_state(vals: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row per group. For each probability i: the wanted rank ``_k`` among the ``_m`` rows in the interval from
    ``_a`` to ``_b`` (both exclusive, NULL: no end), and the answer ``_x`` once it is known."""
    end = F.lit(None).cast("double")
    return vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(*keys, *[
        c.alias(f"_{name}{i}") for i, p in enumerate(probs)
        for name, c in (("k", _rank(p)), ("m", F.col("_n")), ("a", end), ("b", end), ("x", end))
    ])


def _narrow(vals: DataFrame, state: DataFrame, keys: Sequence[str], n: int, first: bool) -> DataFrame:
    """The state after one round: two aggregates over the rows in intervals with more than ``BOUND`` rows."""
    # One literal, not a column for each of its elements.
    grid = F.split(F.lit(",".join(str(j / GRID) for j in range(GRID + 1))), ",").cast("array<double>")
    some = reduce(lambda x, y: x | y, [_too_many(i) for i in range(n)])
    rows = _join_groups(vals, state.filter(some), keys)
    # In the first round all intervals of a group are the same: one sketch does for all.
    sketches = rows.groupBy(*keys).agg(*[
        F.percentile_approx(F.when(_too_many(i) & _inside(i), F.col("_v")), grid, ACCURACY).alias(f"_q{i}")
        for i in range(1 if first else n)
    ])
    marks = []
    for i in range(n):
        at, q = F.col(f"_k{i}") / F.col(f"_m{i}") * GRID, F.col(f"_q{0 if first else i}")
        marks += [F.when(_too_many(i), q[F.greatest(F.lit(0), F.floor(at) - 1).cast("int")]).alias(f"_lo{i}"),
                  F.when(_too_many(i), q[F.least(F.lit(GRID), F.ceil(at) + 1).cast("int")]).alias(f"_hi{i}")]
    marked = _join_groups(state, sketches, keys).select(*state.columns, *marks)
    v = F.col("_v")
    counts = []
    for i in range(n):
        lo, hi, on = F.col(f"_lo{i}"), F.col(f"_hi{i}"), _too_many(i) & _inside(i)
        counts += [F.count_if(on & (v < lo)).alias(f"_c{i}"), F.count_if(on & (v == lo)).alias(f"_d{i}"),
                   F.count_if(on & (v > lo) & (v < hi)).alias(f"_e{i}"), F.count_if(on & (v == hi) & (lo < hi)).alias(f"_f{i}")]
    counted = _join_groups(marked, _join_groups(vals, marked, keys).groupBy(*keys).agg(*counts), keys)
    moved = []
    for i in range(n):
        k, m, a, b, x, lo, hi = (F.col(f"_{c}{i}") for c in ("k", "m", "a", "b", "x", "lo", "hi"))
        below, at_lo, between, at_hi = (F.col(f"_{c}{i}") for c in "cdef")
        to_lo, to_hi = below + at_lo, below + at_lo + between
        # (the rank lies here, new k, new m, new a, new b, answer)
        cases = [
            (~_too_many(i), k, m, a, b, x),
            (k <= below, k, below, a, lo, x),
            (k <= to_lo, k, m, a, b, lo),
            (k <= to_hi, k - to_lo, between, lo, hi, x),
            (k <= to_hi + at_hi, k, m, a, b, hi),
            (F.lit(True), k - to_hi - at_hi, m - to_hi - at_hi, hi, b, x),
        ]
        for place, name in enumerate(("k", "m", "a", "b", "x"), 1):
            value = F.when(cases[0][0], cases[0][place])
            for case in cases[1:]:
                value = value.when(case[0], case[place])
            moved.append(value.alias(f"_{name}{i}"))
    done = state.filter(~some)
    return counted.select(*keys, *moved).unionByName(done)


def _rank_rest(vals: DataFrame, state: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Keys and answers: the rows left in the intervals, at most ``BOUND`` of each, ranked by a running count."""
    n = len(names)
    which = F.explode(F.array_compact(F.array(*[F.when(_inside(i), F.lit(i)) for i in range(n)]))).alias("_i")
    wanted = F.array(*[F.col(f"_k{i}") for i in range(n)])
    cells = _join_groups(vals, state, keys).select(*keys, "_v", wanted.alias("_w"), which)
    cells = cells.groupBy(*keys, "_i", F.col("_w")[F.col("_i")].alias("_k"), "_v").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hit = cells.withColumn("_to", F.sum("_c").over(running)).filter("_k <= _to AND _k > _to - _c")
    found = hit.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(f"_r{i}") for i in range(n)])
    on = _null_safe_on(state, found, keys)
    return state.join(found, on, "left").select(
        *[state[k] for k in keys], *[F.coalesce(state[f"_x{i}"], found[f"_r{i}"]).alias(nm) for i, nm in enumerate(names)]
    )


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` as written to ``path`` and read back."""
    with staging(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grouped_exact_quantiles(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    probs: Sequence[float],
    names: Sequence[str],
    staged: bool = False,
) -> DataFrame:
    """``group_cols`` + one double column per name, for every group with a non-NULL value
    (attach to the group's other aggregates with ``attach``). Runs its rounds when called; the result, a row per
    group, is a small table in the shared folder. ``staged``: ``df`` is little more than a scan of files, which the
    rounds read again; a copy of rows stacked many times over would be far larger than those files."""
    spark = df.sparkSession
    keys = [f"_k{i}_" for i in range(len(group_cols))]
    vals = df.select(*[F.col(c).alias(k) for c, k in zip(group_cols, keys, strict=True)],
                     F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    root = scratch_dir(spark, "quantile-rounds")
    try:
        vals = vals if staged else kept(vals, f"{root}/values")
        state = kept(_first_state(vals, keys, probs), f"{root}/round-0")
        some = reduce(lambda x, y: x | y, [_too_many(i) for i in range(len(probs))])
        done = 0
        while not state.filter(some).isEmpty():
            state = kept(_narrow(vals, state, keys, len(probs), done == 0), f"{root}/round-{done + 1}")
            done += 1
        found = _rank_rest(vals, state, keys, names).withColumnsRenamed(dict(zip(keys, group_cols, strict=True)))
        return kept(found, scratch_dir(spark, "quantiles"))
    finally:
        remove_path(spark, root)


def rank_bounds_hold(
    df: DataFrame, group_cols: Sequence[str], value_col: str, approx: DataFrame,
    probs: Sequence[float], names: Sequence[str], accuracy: int,
) -> DataFrame:
    """``group_cols`` + one boolean per name: whether the approximate quantile in ``approx`` is a
    value whose rank is within ``n / accuracy`` (and one) of the exact rank."""
    vals = df.select(*group_cols, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    j = _join_groups(vals, approx.select(*group_cols, *names), group_cols)
    counts = j.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col("_v") < F.col(n)).alias(f"_b_{n}") for n in names],
        *[F.count_if(F.col("_v") <= F.col(n)).alias(f"_t_{n}") for n in names],
    )
    slack = F.ceil(F.col("_n") / F.lit(float(accuracy))) + 1
    return counts.select(*group_cols, *[
        ((F.col(f"_b_{n}") + 1 <= _rank(p) + slack) & (F.col(f"_t_{n}") >= _rank(p) - slack)).alias(n)
        for p, n in zip(probs, names, strict=True)
    ])


def attach(left: DataFrame, right: DataFrame, group_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``left`` plus ``cols`` of ``right`` matched null-safely on ``group_cols``."""
    j = left.join(right, _null_safe_on(left, right, group_cols), "left")
    return j.select(*[left[c] for c in left.columns], *[right[c] for c in cols])
