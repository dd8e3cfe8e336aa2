"""Column builders for trip features. Every one is a built-in expression (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabflow.functions.rules import first_match

PICKUP = "pickup_datetime"


def c(name: str) -> Column:
    return F.col(name)


# ---- time -------------------------------------------------------------------------

def pickup_hour(ts: str = PICKUP) -> Column:
    return F.hour(c(ts))


def pickup_dow(ts: str = PICKUP) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(c(ts))


def is_weekend(dow: Column) -> Column:
    return F.when(dow.isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def day_part(hour: Column) -> Column:
    return F.when(hour.between(0, 5), F.lit("night")).otherwise(F.lit("day"))


def is_evening_peak(hour: Column) -> Column:
    return F.when(hour.between(16, 19), F.lit(1)).otherwise(F.lit(0))


def ymd(ts: str = PICKUP) -> dict[str, Column]:
    """Partition columns of the processed layout."""
    return {"year": F.year(c(ts)), "month": F.month(c(ts)), "day": F.dayofmonth(c(ts))}


# The local zone of the pickup clock.
PICKUP_ZONE = "America/New_York"


def pickup_hour_utc(ts: str = PICKUP, zone: str = PICKUP_ZONE) -> Column:
    """Pickup wall-clock time (in ``zone``) converted to UTC and truncated to the hour."""
    return F.date_trunc("hour", F.to_utc_timestamp(c(ts), zone))


# ---- derived measures (guarded divisions: NULL instead of an ANSI error) ------------

def derived_metrics() -> dict[str, Column]:
    secs = c("trip_time_in_secs")
    dist = c("trip_distance")
    total = c("total_amount")
    duration_min = F.when(secs > 0, secs / F.lit(60.0))
    return {
        "trip_duration_min": duration_min,
        "avg_speed_kmh": F.when(duration_min > 0, dist / (duration_min / F.lit(60.0))),
        "cost_per_km": F.when(dist > 0, total / dist),
        "cost_per_min": F.when(duration_min > 0, total / duration_min),
    }


# ---- region boxes --------------------------------------------------------------------

# Region boxes (name, lon_min, lon_max, lat_min, lat_max), inclusive,
# overlapping; the first box that contains the point wins.
BOROUGH_BOXES: list[tuple[str, float, float, float, float]] = [
    ("Manhattan", -74.03, -73.93, 40.70, 40.88),
    ("Brooklyn", -74.04, -73.85, 40.57, 40.73),
    ("Queens", -73.96, -73.70, 40.54, 40.80),
    ("Bronx", -73.93, -73.77, 40.79, 40.91),
    ("Staten Island", -74.26, -74.05, 40.49, 40.65),
]
UNKNOWN_REGION = "Unknown"


def region_of(lon: Column, lat: Column, boxes=BOROUGH_BOXES, default: str = UNKNOWN_REGION) -> Column:
    rules = [
        (name, lon.between(F.lit(x0), F.lit(x1)) & lat.between(F.lit(y0), F.lit(y1)))
        for name, x0, x1, y0, y1 in boxes
    ]
    return first_match(rules, default)


def pickup_borough() -> Column:
    return region_of(c("pickup_longitude"), c("pickup_latitude"))


# ---- weather bins ----------------------------------------------------------------------

def precip_bin(precip: Column | None = None) -> Column:
    p = c("precip_mm_per_hr") if precip is None else precip
    return first_match(
        [
            ("0", p.isNull() | (p <= 0.0)),
            ("(0,1]", p <= 1.0),
            ("(1,4]", p <= 4.0),
            ("(4,10]", p <= 10.0),
        ],
        ">10",
    )


def wind_bin(wind: Column | None = None) -> Column:
    w = c("wind_speed_ms") if wind is None else wind
    return first_match(
        [
            ("[0,3)", w.isNull() | (w < 3.0)),
            ("[3,7)", w < 7.0),
            ("[7,12)", w < 12.0),
        ],
        ">=12",
    )


def weather_condition(precip: Column | None = None, temp: Column | None = None) -> Column:
    p = c("precip_mm_per_hr") if precip is None else precip
    t = c("temperature_C") if temp is None else temp
    return first_match(
        [
            ("unknown", p.isNull()),
            ("clear", p <= 0.0),
            ("snow", (t <= 0.5) & (p > 0.2)),
            ("drizzle", p <= 1.0),
            ("rain", p <= 4.0),
        ],
        "heavy_rain",
    )


# ---- geometry --------------------------------------------------------------------------

EARTH_RADIUS_KM = 6371.0
KM_TO_MILES = 0.621371


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Great-circle distance in km; ``least(1, a)`` guards asin against rounding above 1."""
    p1, l1, p2, l2 = (F.radians(c(x)) for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def trip_haversine_km() -> Column:
    return haversine_km("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
