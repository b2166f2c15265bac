"""Inputs of the registered queries: the fixture feed, its valid observations, hourly results."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemetra.constants import HOUR_MS
from telemetra.operators.decode import decode_observations, ok_observations
from telemetra.operators.windows import plain_window_results
from telemetra.fixtures.feed import observation_feed, read_events


def fixture_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observation_feed(read_events(spark, sf_dir))


def fixture_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ok_observations(decode_observations(fixture_feed(spark, sf_dir)))


def hourly_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detector input: plain one-hour window results over the fixture feed."""
    return plain_window_results(fixture_ok(spark, sf_dir), HOUR_MS)
