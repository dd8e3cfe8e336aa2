"""Dimension tables: US federal holidays (by rule, any years) and hourly weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.schemas import WEATHER_CSV_DDL, WEATHER_VALUE_COLUMNS

# US federal holidays as (name, month, weekday, nth).
# weekday None -> fixed day of month given by nth; weekday 1 = Sunday .. 7 = Saturday;
# nth -1 = last such weekday of the month.
US_FEDERAL_HOLIDAYS: list[tuple[str, int, int | None, int]] = [
    ("New Year's Day", 1, None, 1),
    ("Martin Luther King Jr. Day", 1, 2, 3),
    ("Presidents' Day", 2, 2, 3),
    ("Memorial Day", 5, 2, -1),
    ("Independence Day", 7, None, 4),
    ("Labor Day", 9, 2, 1),
    ("Columbus Day", 10, 2, 2),
    ("Veterans Day", 11, None, 11),
    ("Thanksgiving Day", 11, 5, 4),
    ("Christmas Day", 12, None, 25),
]


def holiday_name(d: Column) -> Column:
    """Name of the federal holiday on a date, or NULL."""
    m, dom, dow = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    nth = F.floor((dom - 1) / 7) + 1
    is_last = F.dayofmonth(F.last_day(d)) - dom < 7
    out = F.lit(None).cast("string")
    for name, month, weekday, n in reversed(US_FEDERAL_HOLIDAYS):
        if weekday is None:
            hit = (m == month) & (dom == n)
        elif n == -1:
            hit = (m == month) & (dow == weekday) & is_last
        else:
            hit = (m == month) & (dow == weekday) & (nth == n)
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def holidays_from_days(days: DataFrame, date_col: str = "date") -> DataFrame:
    """Keep the holiday rows of a one-column table of dates: ``date, is_holiday, holiday_name``."""
    named = days.select(F.col(date_col).alias("date")).withColumn("holiday_name", holiday_name(F.col("date")))
    return named.filter(F.col("holiday_name").isNotNull()).select(
        "date", F.lit(1).alias("is_holiday"), "holiday_name"
    )


def us_federal_holidays(spark: SparkSession, first_year: int = 2013, last_year: int | None = None) -> DataFrame:
    """Holidays of whole calendar years ``first_year..last_year`` (ten per year)."""
    last_year = first_year if last_year is None else last_year
    days = spark.range(1).select(
        F.explode(
            F.sequence(F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
                       F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))
        ).alias("date")
    )
    return holidays_from_days(days)


def holidays_covering(df: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """Holidays of every calendar year that ``df[ts]`` touches, derived lazily from one
    global min/max aggregate (no driver round trip). At most ten rows per year, so the
    result is always safe to broadcast."""
    span = df.agg(F.min(F.year(ts)).alias("y0"), F.max(F.year(ts)).alias("y1")).filter(F.col("y0").isNotNull())
    days = span.select(
        F.explode(F.sequence(F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31)))).alias("date")
    )
    return holidays_from_days(days)


def normalize_weather(csv_like: DataFrame) -> DataFrame:
    """Raw hourly CSV rows -> ``timestamp_hour_utc`` + four measures.

    ``try_to_timestamp`` turns malformed text into NULL instead of an ANSI error.
    """
    ts = F.try_to_timestamp(F.col("DATE"))
    return csv_like.select(
        F.date_trunc("hour", ts).alias("timestamp_hour_utc"), *[F.col(c) for c in WEATHER_VALUE_COLUMNS]
    )


def one_row_per_hour(weather: DataFrame) -> DataFrame:
    """Collapse duplicate hours (mean of each measure) so the left join cannot multiply trips.
    Rows with a NULL hour can never join and are dropped here."""
    return (
        weather.filter(F.col("timestamp_hour_utc").isNotNull())
        .groupBy("timestamp_hour_utc")
        .agg(*[F.avg(c).alias(c) for c in WEATHER_VALUE_COLUMNS])
    )


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", False).schema(WEATHER_CSV_DDL).csv(path)
