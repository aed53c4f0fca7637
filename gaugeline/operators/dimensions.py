"""Date and location dimensions, and joins to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.functions import calendar as cal
from gaugeline.operators.frames import with_positions
from gaugeline.schema import COUNTRY, SITE_REGIONS, TIMEZONE, SeriesSpec

def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Every day from ``start`` up to but not including ``end``."""
    days = F.sequence(F.lit(str(start)).cast("date"), F.date_sub(F.lit(str(end)).cast("date"), 1))
    return spark.range(1).select(F.explode(days).alias("date"))


def spine_of(df: DataFrame, day: str = "date") -> DataFrame:
    """The spine that covers the dates of ``df``, last day included."""
    span = df.agg(F.min(day).alias("a"), F.max(day).alias("b")).filter("a is not null")
    return span.select(F.explode(F.sequence(F.col("a").cast("date"), F.col("b").cast("date"))).alias("date"))


def date_dimension(spine: DataFrame) -> DataFrame:
    """Calendar attributes per day. A spine has one row per calendar day, so numbering it in a
    single task is cheap at any data size."""
    day = F.col("date")
    return spine.select(
        F.row_number().over(Window.orderBy("date")).alias("date_id"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        cal.day_of_week(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        cal.day_name(cal.day_of_week(day)).alias("day_name"),
        cal.month_name(F.month(day)).alias("month_name"),
        cal.weekend_flag(cal.day_of_week(day)).alias("is_weekend"),
        cal.season(F.month(day)).alias("season"),
    )


def location_dimension(raw: DataFrame, spec: SeriesSpec = SeriesSpec()) -> DataFrame:
    """One row per distinct (site, coordinates), numbered by name and then by coordinates so
    that ids are stable when a site has several."""
    known = F.create_map(*[F.lit(text) for pair in SITE_REGIONS.items() for text in pair])
    region = F.coalesce(F.try_element_at(known, F.col(spec.entity)), F.lit("Other"))
    key = [spec.entity, "latitude", "longitude"]
    distinct = raw.select(*key).distinct()
    numbered = with_positions(distinct, key, "location_id")
    return numbered.select(
        "location_id",
        spec.entity,
        "latitude",
        "longitude",
        F.lit(COUNTRY).alias("country"),
        region.alias("region"),
        F.lit(TIMEZONE).alias("timezone"),
    )


def join_dimension(fact: DataFrame, dimension: DataFrame, on, how: str = "left") -> DataFrame:
    """The choice of join is the optimizer's: at run time a dimension whose measured size is below
    ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a larger one is shuffled, and skewed
    partitions are split."""
    return fact.join(dimension, on, how)
