"""Lazy building blocks shared by the jobs, the registered queries and the bench:
raw feeds -> validated -> split -> matched -> analytics / question base."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cabflow.operators import matching, quality
from cabflow.operators.enrich import add_ymd, analytics_base, question_base
from cabflow.session import SPLIT, configured, input_bytes, split_for_columnar, widen
from cabflow.sources import fixtures
from cabflow.sources.dims import normalize_weather


@dataclass
class Cleaned:
    tagged_trips: DataFrame  # deduplicated, filled, with rejection_reason and _rows
    tagged_fares: DataFrame
    good_trips: DataFrame
    bad_trips: DataFrame
    good_fares: DataFrame
    bad_fares: DataFrame


def clean(trips_raw: DataFrame, fares_raw: DataFrame) -> Cleaned:
    tt = quality.validated_trips(trips_raw, multiplicity=quality.MULTIPLICITY)
    tf = quality.validated_fares(fares_raw, multiplicity=quality.MULTIPLICITY)
    gt, bt = quality.split(tt)
    gf, bf = quality.split(tf)
    return Cleaned(tt, tf, gt, bt, gf, bf)


def fit_to_input(spark: SparkSession, sf_dir: str) -> int:
    """Shuffle width for the trip and fare feeds under ``sf_dir`` (``session.widen``); returns their input's bytes."""
    nbytes = input_bytes(spark, [f"{sf_dir.rstrip('/')}/lineitem.parquet"])
    widen(spark, nbytes)
    return nbytes


@contextmanager
def fine_splits(spark: SparkSession, sf_dir: str) -> Iterator[None]:
    """For queries that run their jobs when called: splits whose rows a task can sort in memory."""
    nbytes = fit_to_input(spark, sf_dir)
    current = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    with configured(spark, {SPLIT: str(split_for_columnar(nbytes, current))}):
        yield


def fixture_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    fit_to_input(spark, sf_dir)
    return fixtures.trips_raw(spark, sf_dir), fixtures.fares_raw(spark, sf_dir)


def fixture_clean(spark: SparkSession, sf_dir: str) -> Cleaned:
    return clean(*fixture_raw(spark, sf_dir))


def fixture_match(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = fixture_clean(spark, sf_dir)
    return matching.match(c.good_trips, c.good_fares)


def fixture_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_match(spark, sf_dir)[matching.MATCHED]


def fixture_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather as the job would read it: CSV-shaped text normalised to hours."""
    return normalize_weather(fixtures.weather_csv_frame(spark, sf_dir))


def fixture_analytics_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics_base(add_ymd(fixture_matched(spark, sf_dir)))


def fixture_question_base(spark: SparkSession, sf_dir: str, weather: bool = True) -> DataFrame:
    w = fixture_weather(spark, sf_dir) if weather else None
    return question_base(fixture_matched(spark, sf_dir), weather=w)
