"""Reference tables shipped as CSV with the package."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from gaugeline.schema import LOCATION_METADATA, SEASON_MAPPINGS, WEATHER_THRESHOLDS

FOLDER = Path(__file__).parent / "data"


def _seed(spark: SparkSession, name: str, schema) -> DataFrame:
    """A seed is at most a dozen rows, and its file exists on the driver only, so it travels
    inside the plan rather than as a file scan."""
    with (FOLDER / f"{name}.csv").open(newline="") as lines:
        rows = list(csv.reader(lines))[1:]
    text = spark.createDataFrame(rows, ", ".join(f"{f.name} string" for f in schema))
    return text.select(*[text[f.name].cast(f.dataType).alias(f.name) for f in schema])


def location_metadata(spark: SparkSession) -> DataFrame:
    return _seed(spark, "location_metadata", LOCATION_METADATA)


def season_mappings(spark: SparkSession) -> DataFrame:
    return _seed(spark, "season_mappings", SEASON_MAPPINGS)


def weather_thresholds(spark: SparkSession) -> DataFrame:
    return _seed(spark, "weather_thresholds", WEATHER_THRESHOLDS)
