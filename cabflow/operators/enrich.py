"""Feature enrichment of matched trips: time, derived measures, flags, holidays,
region, weather. Each step is a projection, or a left join against a dimension (one row per
hour, or a given holiday table) that the planner broadcasts where it is small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions import features as fx
from cabflow.sources.dims import holiday_name, one_row_per_hour

def add_time_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"pickup_hour": fx.pickup_hour(), "pickup_dow": fx.pickup_dow()})


def add_derived_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns(fx.derived_metrics())


def add_time_flags(df: DataFrame) -> DataFrame:
    h, d = F.col("pickup_hour"), F.col("pickup_dow")
    return df.withColumns(
        {"is_weekend": fx.is_weekend(d), "day_part": fx.day_part(h), "is_evening_peak": fx.is_evening_peak(h)}
    )


def add_ymd(df: DataFrame) -> DataFrame:
    """``year, month, day`` of the pickup (already present on data read from the processed layout)."""
    missing = {k: v for k, v in fx.ymd().items() if k not in df.columns}
    return df.withColumns(missing) if missing else df


def add_borough(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_borough", fx.pickup_borough())


def add_holidays(df: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """``pickup_date`` and ``is_holiday`` (0 where no holiday matches). Without a holiday table the
    flag is a function of the date alone: no join, any year. A given table is de-duplicated
    by date and left-joined; the planner chooses how."""
    out = df.withColumn("pickup_date", F.to_date("pickup_datetime"))
    if holidays is None:
        return out.withColumn("is_holiday", F.when(holiday_name(F.col("pickup_date")).isNotNull(), 1).otherwise(0))
    h = holidays.groupBy(F.col("date").alias("_h_date")).agg(F.max("is_holiday").alias("_h_flag"))
    out = out.join(h, out["pickup_date"] == h["_h_date"], "left")
    return out.withColumn("is_holiday", F.coalesce(F.col("_h_flag"), F.lit(0))).drop("_h_date", "_h_flag")


def add_weather(df: DataFrame, weather: DataFrame, dedupe_hours: bool = True) -> DataFrame:
    """Left join on the pickup hour in UTC; adds the four measures and the three bins.
    With ``dedupe_hours`` (default) duplicate hours are averaged first so trips are never
    multiplied; ``False`` keeps the raw dimension as given."""
    w = one_row_per_hour(weather) if dedupe_hours else weather
    w = w.withColumnRenamed("timestamp_hour_utc", "_w_hour")  # adaptive execution broadcasts it where it is small
    out = df.withColumn("pickup_hour_utc", fx.pickup_hour_utc())
    out = out.join(w, out["pickup_hour_utc"] == w["_w_hour"], "left").drop("_w_hour")
    return out.withColumns(
        {"precip_bin": fx.precip_bin(), "wind_bin": fx.wind_bin(), "weather_condition_5": fx.weather_condition()}
    )


def analytics_base(df: DataFrame) -> DataFrame:
    """Derived measures + time features: the input of profiling and KPIs."""
    return add_time_features(add_derived_metrics(df))


def question_base(
    df: DataFrame,
    holidays: DataFrame | None = None,
    weather: DataFrame | None = None,
    with_holidays: bool = True,
) -> DataFrame:
    """derived -> time -> flags -> (holidays) -> region -> (weather); adds year/month/day
    when absent so month-grouped questions always resolve."""
    base = add_time_flags(add_time_features(add_derived_metrics(add_ymd(df))))
    if with_holidays:
        base = add_holidays(base, holidays)
    base = add_borough(base)
    if weather is not None:
        base = add_weather(base, weather)
    return base
