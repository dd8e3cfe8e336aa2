"""Writers. Large outputs are written by many tasks; only already-aggregated results
are collapsed to one file.

* processed trips: ``year/month/day`` Parquet, dynamic partition overwrite, dealt by hash of
  the day, and of a salt where a day has too many rows for one file;
* quarantine / unmatched: CSV written in parallel (no ``coalesce(1)``, which would pull
  the whole join into one task);
* small results (questions, KPIs, metrics): one CSV file each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.operators.enrich import add_ymd
from cabflow.schemas import KEY

PARTITION_COLS = ["year", "month", "day"]


# Rows of one file of the processed layout, about; a day with more is dealt to several tasks.
ROWS_PER_FILE = 2_000_000


def day_pieces(trips: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``year, month, day, pieces`` of the days that need more than one file, from a count over a
    table with ``pickup_datetime`` (at most one row per calendar day)."""
    counts = add_ymd(trips.select("pickup_datetime")).groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > rows_per_file).select(
        *PARTITION_COLS, F.ceil(F.col("n") / F.lit(rows_per_file)).alias("pieces"))


def write_processed(df: DataFrame, path: str, num_partitions: int | None = None, pieces: DataFrame | None = None,
                    mode: str = "overwrite") -> None:
    """Matched trips -> Parquet partitioned by pickup ``year, month, day`` (overwrite with
    dynamic partition mode: only the days present in ``df`` are replaced; ``append`` adds files).

    Rows are dealt by hash of the day, and of a salt from the key where ``pieces`` (see
    ``day_pieces``) gives the day several, so ``df`` (the match) is computed once: a range
    partitioning would run it once more to sample it."""
    spark = df.sparkSession
    out = add_ymd(df)
    salt = F.lit(0)
    if pieces is not None:
        out = out.join(F.broadcast(pieces), PARTITION_COLS, "left")
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in KEY]), F.coalesce("pieces", F.lit(1)))
    # An explicit count keeps AQE from collapsing the writers into one task.
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartition(n, *PARTITION_COLS, salt).sortWithinPartitions(*PARTITION_COLS, "pickup_datetime")
    out = out.select(*df.columns, *[c for c in PARTITION_COLS if c not in df.columns])
    # Per-write option: only this write uses dynamic overwrite, the session is left alone.
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLS).parquet(path)


def one_partition(df: DataFrame, sort_by: list[str] | None = None) -> DataFrame:
    """Move a SMALL result into one partition for a single output file.

    ``repartition(1)`` rather than ``coalesce(1)``: coalesce would pull the stage that
    produces the rows (e.g. the final aggregate over every map task's partial sketch)
    into one task; repartition keeps that stage parallel and moves only the result.
    ``sort_by`` restores an order the shuffle does not keep."""
    out = df.repartition(1)
    return out.sortWithinPartitions(*sort_by) if sort_by else out


def write_csv(df: DataFrame, path: str, single_file: bool = False, sort_by: list[str] | None = None) -> None:
    """CSV with header, overwrite, written by many tasks; ``single_file`` only for
    small, aggregated results (see ``one_partition``)."""
    out = one_partition(df, sort_by) if single_file else df
    out.write.option("header", True).mode("overwrite").csv(path)


def write_json_doc(df: DataFrame, path: str) -> None:
    """A one-row DataFrame as one JSON text line (non-ASCII kept)."""
    one_partition(df.select(F.to_json(F.struct(*df.columns)).alias("value"))).write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
