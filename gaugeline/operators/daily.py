"""Daily roll-up of enriched readings: one row per entity and day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import calendar as cal
from gaugeline.functions.keys import surrogate_key
from gaugeline.functions.rounding import round_half_up
from gaugeline.schema import SeriesSpec

WEATHER = SeriesSpec()


def until(df: DataFrame, as_of: dt.date | str | Column | None, day: str = "date") -> DataFrame:
    """Rows dated no later than ``as_of``; today when it is not given."""
    bound = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return df.filter(F.col(day) <= bound)


# Output name and SQL aggregate of each rounded daily measure.
MEASURES = {
    "avg_temperature": "avg(temperature)",
    "max_temperature": "max(temperature)",
    "min_temperature": "min(temperature)",
    "temp_std_dev": "stddev_samp(temperature)",
    "temp_range": "max(temperature) - min(temperature)",
    **{
        f"{part.lower()}_temp": f"avg(temperature) FILTER (WHERE time_of_day = '{part}')"
        for part in ("Morning", "Afternoon", "Evening", "Night")
    },
    "total_precipitation": "sum(precipitation)",
    "max_hourly_precipitation": "max(precipitation)",
    "avg_precipitation": "avg(precipitation)",
    "avg_wind_speed": "avg(wind_speed)",
    "max_wind_speed": "max(wind_speed)",
    "min_wind_speed": "min(wind_speed)",
    "dominant_wind_direction": "avg(wind_direction)",
    "avg_humidity": "avg(humidity)",
    "max_humidity": "max(humidity)",
    "min_humidity": "min(humidity)",
    "avg_pressure": "avg(pressure)",
    "max_pressure": "max(pressure)",
    "min_pressure": "min(pressure)",
    "avg_cloud_cover": "avg(cloud_cover)",
    "avg_temp_humidity_index": "avg(temp_humidity_index)",
    "avg_wind_chill_index": "avg(wind_chill_index)",
    "avg_data_quality_score": "avg(data_quality_score)",
}
COUNTS = {
    "hours_with_rain": "sum(is_raining)",
    "hours_hot": "sum(is_hot)",
    "hours_cold": "sum(is_cold)",
    "hours_humid": "sum(is_humid)",
    "hours_windy": "sum(is_windy)",
    "hours_cloudy": "sum(is_cloudy)",
    "total_hourly_records": "count(1)",
}
# Mean direction on the circle, in [0, 360): an alternative to the arithmetic mean.
CIRCULAR_DIRECTION = (
    "pmod(degrees(atan2(avg(sin(radians(wind_direction))), avg(cos(radians(wind_direction))))) + 360.0D, 360.0D)"
)


def day_attributes(day: str = "date") -> dict[str, Column]:
    """What the date alone determines; derived after the grouping rather than carried through
    it, which keeps the aggregation numeric and narrow."""
    dow, month = cal.day_of_week(day), F.month(day)
    return {
        "day_of_week": dow,
        "day_name": cal.day_name(dow),
        "month": month,
        "month_name": cal.month_name(month),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "season": cal.season(month),
        "is_weekend": cal.weekend_flag(dow),
    }


def daily_rollup(
    enriched: DataFrame,
    spec: SeriesSpec = WEATHER,
    as_of: dt.date | str | None = None,
    circular_wind: bool = False,
) -> DataFrame:
    """All daily columns, with ``daily_id`` first."""
    measures = dict(MEASURES)
    if circular_wind:
        measures["circular_wind_direction"] = CIRCULAR_DIRECTION
    rolled = (
        until(enriched, as_of, spec.day)
        .groupBy(spec.entity, spec.day)
        .agg(*[F.expr(sql).alias(name) for name, sql in {**measures, **COUNTS}.items()])
    )
    attributes = [column.alias(name) for name, column in day_attributes(spec.day).items()]
    return rolled.select(
        surrogate_key(spec.entity, spec.day).alias("daily_id"),
        spec.entity,
        spec.day,
        *attributes,
        *[round_half_up(name).alias(name) for name in measures],
        *COUNTS,
    )


def stamped(df: DataFrame, *names: str) -> DataFrame:
    """Load-time stamps for a stored mart; kept apart so results stay reproducible."""
    return df.withColumns({name: F.current_timestamp() for name in names or ("created_at", "updated_at")})
