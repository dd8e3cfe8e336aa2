"""The run summary as a metrics table ``source, metric, value, pct`` (no console text):
rejected share of each feed's input, in all and by reason, and unmatched share of each side's
valid rows (0 when the denominator is 0). All inputs are one-row or few-row stats tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pct(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double")), F.lit(0.0))


def _feed_rows(stats: DataFrame) -> DataFrame:
    """Every metric of a feed's reject stats, reasons included; rejected rows and each reason as a
    share of the feed's input rows."""
    total = stats.filter(F.col("metric") == "total_records").select("source", F.col("value").alias("_total"))
    return stats.join(F.broadcast(total), "source", "left").select(
        "source",
        "metric",
        "value",
        F.when(F.col("metric") != "total_records", _pct(F.col("value"), F.col("_total"))).alias("pct"),
    )


def etl_report(trip_stats: DataFrame, fare_stats: DataFrame, match_stats: DataFrame) -> DataFrame:
    def row(metric: str, pct: Column | None = None) -> Column:
        return F.struct(F.lit(metric).alias("metric"), F.col(metric).alias("value"),
                        (pct if pct is not None else F.lit(None).cast("double")).alias("pct"))

    m = match_stats.select(
        F.lit("match").alias("source"),
        F.explode(F.array(
            row("valid_trips_for_join"),
            row("valid_fares_for_join"),
            row("matched_records"),
            row("trips_without_fare", _pct(F.col("trips_without_fare"), F.col("valid_trips_for_join"))),
            row("fares_without_trip", _pct(F.col("fares_without_trip"), F.col("valid_fares_for_join"))),
            row("incomplete_records"),
        )).alias("m"),
    ).select("source", "m.metric", "m.value", "m.pct")
    return _feed_rows(trip_stats).unionByName(_feed_rows(fare_stats)).unionByName(m)
