"""Change tracking of the processed layout: a manifest of its days, committed once their files are complete.

The layout is plain ``year/month/day`` Parquet. A version of the manifest has a row per day: the files that make it up,
their rows, and a digest of the *input* the day was made from. Trips and fares meet on a key that holds the pickup
time, so a day's matched rows depend on the valid trips and fares of that day alone; the digest is a count and a sum of
row hashes of each feed, one aggregate over the staged tables. So

* a re-run joins and writes only days whose digest differs from the manifest's (``changed_days``);
* new files are *added* to a day, then the next version of the manifest is written, then files no longer named are
  deleted. A run that dies before the commit leaves the old version and its files; the half-written ones
  are named nowhere, readers leave them out (``read``), and the next commit of the day deletes them;
* versions are complete or ignored (the writer's success marker), readers take the newest complete one.

The driver holds the days and their file names. Days that a run's input does not have are left as they are.

Defined results: rows without a pickup time belong to no day and never match; a day whose rows all vanish from
the input is left alone, as with a plain overwrite of partitions; a day that matches nothing has no files.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.session import remove_path
from cabflow.sinks import writers

#: Versions kept besides the newest.
KEPT_VERSIONS = 3
DDL = "day date, digest string, trips bigint, files array<string>"
_DAY_DIR = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)/[^/]+$")


@dataclass(frozen=True)
class Day:
    digest: str
    trips: int
    files: tuple[str, ...]  # paths below the table


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def manifest_root(table: str) -> str:
    """Beside the table, so that a read of the table never meets it."""
    return f"{table.rstrip('/')}_manifest"


def _versions(spark: SparkSession, table: str) -> list[int]:
    fs, p = _fs(spark, f"{manifest_root(table)}/version=*/_SUCCESS")
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in fs.globStatus(p) or [])


def current(spark: SparkSession, table: str) -> dict[date, Day] | None:
    """The newest complete version, or None where there is none."""
    versions = _versions(spark, table)
    if not versions:
        return None
    rows = spark.read.schema(DDL).parquet(f"{manifest_root(table)}/version={versions[-1]}").collect()
    return {r.day: Day(r.digest, r.trips, tuple(r.files)) for r in rows}


def input_digests(trips: DataFrame, fares: DataFrame, ts: str = "pickup_datetime") -> dict[date, str]:
    """Digest of the valid rows of both feeds, by day. The sum does not depend on the order of rows."""
    def one(df: DataFrame, feed: str) -> DataFrame:
        row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns])
        return df.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(
            F.concat_ws(":", F.lit(feed), F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")).cast("string")).alias("d"))

    both = one(trips, "trips").unionByName(one(fares, "fares")).groupBy("day").agg(F.sort_array(F.collect_list("d")).alias("d"))
    return {r.day: "|".join(r.d) for r in both.collect()}  # a row per calendar day


def changed_days(digests: dict[date, str], known: dict[date, Day] | None) -> list[date]:
    return sorted(d for d, digest in digests.items() if known is None or d not in known or known[d].digest != digest)


def of_days(df: DataFrame, days: list[date], ts: str = "pickup_datetime") -> DataFrame:
    return df.filter(F.to_date(ts).isin(days)) if days else df.limit(0)


def _files(spark: SparkSession, table: str) -> list[str]:
    """Data files of the layout, below the table."""
    fs, p = _fs(spark, table)
    if not fs.exists(p):
        return []
    root = fs.getFileStatus(p).getPath().toUri().getPath().rstrip("/")
    out, walk = [], fs.listFiles(p, True)
    while walk.hasNext():
        path = walk.next().getPath().toUri().getPath()
        if _DAY_DIR.search(path) and not path.rsplit("/", 1)[1].startswith(("_", ".")) and "/_temporary/" not in path:
            out.append(path.removeprefix(root).lstrip("/"))
    return sorted(out)


def _day_of(file: str) -> date:
    return date(*map(int, _DAY_DIR.search(f"/{file}").groups()))


def publish(matched: DataFrame, table: str, days: list[date], digests: dict[date, str], pieces: DataFrame | None = None) -> None:
    """Write the matched rows of ``days`` and commit them. ``matched`` holds rows of these days only."""
    spark = matched.sparkSession
    known = current(spark, table)
    before = set(_files(spark, table))
    if known is None:  # a layout from before there was a manifest: its files count as they are
        known = {}
        for f in before:
            known.setdefault(_day_of(f), Day("", -1, ()))
        known = {d: Day("", -1, tuple(sorted(f for f in before if _day_of(f) == d))) for d in known}
    writers.write_processed(matched, table, pieces=pieces, mode="append")
    added: dict[date, list[str]] = {d: [] for d in days}
    for f in set(_files(spark, table)) - before:
        added.setdefault(_day_of(f), []).append(f)
    rows = {}
    if any(added.values()):
        new = [f"{table}/{f}" for files in added.values() for f in files]
        counts = spark.read.option("basePath", table).parquet(*new).groupBy(*writers.PARTITION_COLS).agg(F.count(F.lit(1)).alias("n"))
        rows = {date(r.year, r.month, r.day): r.n for r in counts.collect()}
    now = known | {d: Day(digests[d], rows.get(d, 0), tuple(sorted(added[d]))) for d in days}
    _commit(spark, table, now)
    named = {f for d in now.values() for f in d.files}
    for f in sorted(f for f in before if f not in named and _day_of(f) in set(days)):
        remove_path(spark, f"{table}/{f}")


def _commit(spark: SparkSession, table: str, days: dict[date, Day]) -> None:
    versions = _versions(spark, table)
    rows = [(d, x.digest, x.trips, list(x.files)) for d, x in sorted(days.items())]
    path = f"{manifest_root(table)}/version={(versions or [0])[-1] + 1}"
    spark.createDataFrame(rows, DDL).repartition(1).write.mode("overwrite").parquet(path)
    for old in versions[: -KEPT_VERSIONS or None]:
        remove_path(spark, f"{manifest_root(table)}/version={old}")


def read(spark: SparkSession, table: str) -> DataFrame | None:
    """The layout as the manifest names it, or None where there is no manifest. Files that it does not name (of a
    write that never committed) are left out."""
    known = current(spark, table)
    if known is None:
        return None
    named = sorted(f for d in known.values() for f in d.files)
    if not named:
        raise FileNotFoundError(f"the manifest of {table} names no file")
    if named == _files(spark, table):
        return spark.read.parquet(table)
    return spark.read.option("basePath", table).parquet(*[f"{table}/{f}" for f in named])


def summary(spark: SparkSession, table: str) -> DataFrame:
    """``day, trips, files`` of the current version."""
    known = current(spark, table) or {}
    return spark.createDataFrame([(d, x.trips, len(x.files)) for d, x in sorted(known.items())], "day date, trips bigint, files int")
