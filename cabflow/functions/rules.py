"""Ordered validation rules folded into one ``CASE WHEN`` column.

Rules are data: ``(reason, predicate)`` pairs checked in order, first match wins.
A predicate over a NULL operand is NULL, never true, so rows with NULL operands
fall through to ``VALID`` (the reference behaves the same way).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

VALID = "VALID"

# Trip rules in evaluation order (reason, predicate).
TRIP_RULES: list[tuple[str, str]] = [
    ("invalid_passenger_count", "passenger_count <= 0"),
    ("excessive_passenger_count", "passenger_count > 6"),
    ("trip_too_short", "trip_time_in_secs < 60"),
    ("trip_too_long", "trip_time_in_secs > 43200"),
    ("zero_or_negative_distance", "trip_distance <= 0"),
    ("excessive_distance", "trip_distance > 200"),
    ("invalid_trip_duration", "pickup_datetime >= dropoff_datetime"),
]

# Fare rules in evaluation order (reason, predicate).
FARE_RULES: list[tuple[str, str]] = [
    ("amount_too_low", "total_amount < 2.5"),
    ("amount_too_high", "total_amount > 1000"),
    ("negative_fare_amount", "fare_amount < 0"),
]

# Defaults applied to the trip feed after dedup.
TRIP_DEFAULTS = {"rate_code": "UNK", "store_and_fwd_flag": "N"}


def first_match(rules: Sequence[tuple[str, str | Column]], default: str = VALID) -> Column:
    """Fold ordered ``(label, predicate)`` pairs into ``when(..).when(..).otherwise(default)``."""
    if not rules:
        return F.lit(default)

    def pred(p: str | Column) -> Column:
        return F.expr(p) if isinstance(p, str) else p

    head, *tail = rules
    chain = reduce(
        lambda acc, rule: acc.when(pred(rule[1]), F.lit(rule[0])),
        tail,
        F.when(pred(head[1]), F.lit(head[0])),
    )
    return chain.otherwise(F.lit(default))


def trip_rejection_reason() -> Column:
    return first_match(TRIP_RULES)


def fare_rejection_reason() -> Column:
    return first_match(FARE_RULES)
