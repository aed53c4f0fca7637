"""Forecast features from the daily mart. Every feature of a day uses earlier days only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gaugeline.functions.keys import surrogate_key
from gaugeline.functions.rounding import round_half_up, rounded
from gaugeline.operators import frames
from gaugeline.operators.daily import until
from gaugeline.schema import TARGET, SeriesSpec

WEATHER = SeriesSpec(time="date")

# Name stem of a lag feature, its source, and how many rows it looks back.
LAGS = (
    ("temp", "avg_temperature", (1, 2, 3, 7, 14)),
    ("max_temp", "max_temperature", (1,)),
    ("min_temp", "min_temperature", (1,)),
    ("temp_range", "temp_range", (1,)),
    ("temp_std_dev", "temp_std_dev", (1,)),
    ("morning_temp", "morning_temp", (1,)),
    ("afternoon_temp", "afternoon_temp", (1,)),
    ("evening_temp", "evening_temp", (1,)),
    ("night_temp", "night_temp", (1,)),
    ("precip", "total_precipitation", (1, 3, 7)),
    ("hours_rain", "hours_with_rain", (1,)),
    ("wind_speed", "avg_wind_speed", (1,)),
    ("max_wind_speed", "max_wind_speed", (1,)),
    ("wind_direction", "dominant_wind_direction", (1,)),
    ("humidity", "avg_humidity", (1,)),
    ("max_humidity", "max_humidity", (1,)),
    ("pressure", "avg_pressure", (1,)),
    ("max_pressure", "max_pressure", (1,)),
    ("min_pressure", "min_pressure", (1,)),
    ("cloud_cover", "avg_cloud_cover", (1,)),
    ("hours_hot", "hours_hot", (1,)),
    ("hours_cold", "hours_cold", (1,)),
    ("hours_humid", "hours_humid", (1,)),
    ("hours_windy", "hours_windy", (1,)),
    ("hours_cloudy", "hours_cloudy", (1,)),
    ("temp_humidity_index", "avg_temp_humidity_index", (1,)),
    ("wind_chill_index", "avg_wind_chill_index", (1,)),
)

# Rolling feature, aggregate, source, rows in the frame that ends one row back.
ROLLING = (
    ("temp_rolling_7d_prev", "avg", "avg_temperature", 7),
    ("temp_rolling_14d_prev", "avg", "avg_temperature", 14),
    ("temp_rolling_30d_prev", "avg", "avg_temperature", 30),
    ("temp_rolling_std_7d_prev", "stddev_samp", "avg_temperature", 7),
    ("temp_rolling_std_30d_prev", "stddev_samp", "avg_temperature", 30),
    ("temp_rolling_min_7d_prev", "min", "avg_temperature", 7),
    ("temp_rolling_max_7d_prev", "max", "avg_temperature", 7),
    ("precip_rolling_7d_prev", "avg", "total_precipitation", 7),
    ("precip_rolling_30d_prev", "avg", "total_precipitation", 30),
    ("precip_sum_7d_prev", "sum", "total_precipitation", 7),
    ("total_rain_hours_7d_prev", "sum", "hours_with_rain", 7),
    ("humidity_rolling_7d_prev", "avg", "avg_humidity", 7),
    ("humidity_rolling_30d_prev", "avg", "avg_humidity", 30),
    ("pressure_rolling_7d_prev", "avg", "avg_pressure", 7),
    ("pressure_rolling_30d_prev", "avg", "avg_pressure", 30),
    ("pressure_rolling_std_7d_prev", "stddev_samp", "avg_pressure", 7),
    ("wind_speed_rolling_7d_prev", "avg", "avg_wind_speed", 7),
    ("max_wind_speed_7d_prev", "max", "max_wind_speed", 7),
    ("cloud_cover_rolling_7d_prev", "avg", "avg_cloud_cover", 7),
)

# Derived feature, minuend, subtrahend, divisor.
DIFFERENCES = (
    ("temp_change_1d_to_2d", "temp_lag_1d", "temp_lag_2d", 1.0),
    ("temp_change_1d_to_3d", "temp_lag_1d", "temp_lag_3d", 1.0),
    ("temp_change_1d_to_7d", "temp_lag_1d", "temp_lag_7d", 1.0),
    ("temp_diff_from_7d_avg", "temp_lag_1d", "temp_rolling_7d_prev", 1.0),
    ("temp_diff_from_30d_avg", "temp_lag_1d", "temp_rolling_30d_prev", 1.0),
    ("precip_change_1d_to_7d", "precip_lag_1d", "precip_lag_7d", 1.0),
    ("precip_diff_from_7d_avg", "precip_lag_1d", "precip_rolling_7d_prev", 1.0),
    ("humidity_diff_from_7d_avg", "humidity_lag_1d", "humidity_rolling_7d_prev", 1.0),
    ("humidity_diff_from_30d_avg", "humidity_lag_1d", "humidity_rolling_30d_prev", 1.0),
    ("pressure_diff_from_7d_avg", "pressure_lag_1d", "pressure_rolling_7d_prev", 1.0),
    ("pressure_diff_from_30d_avg", "pressure_lag_1d", "pressure_rolling_30d_prev", 1.0),
    ("temp_trend_3d", "temp_lag_1d", "temp_lag_3d", 2.0),
    ("temp_trend_7d", "temp_lag_1d", "temp_lag_7d", 6.0),
    ("wind_speed_diff_from_7d_avg", "wind_speed_lag_1d", "wind_speed_rolling_7d_prev", 1.0),
)
VOLATILITY = (
    ("temp_volatility_7d", "temp_rolling_std_7d_prev"),
    ("temp_volatility_30d", "temp_rolling_std_30d_prev"),
)

IDENTITY = ("location_name", "date", "month", "year", "quarter", "day_of_week", "is_weekend", "season", TARGET)
LONGEST_LOOK_BACK = max(max(k for _, _, ks in LAGS for k in ks), max(n for *_, n in ROLLING))

LAG_NAMES = tuple(f"{stem}_lag_{k}d" for stem, _, ks in LAGS for k in ks)
ROLLING_NAMES = tuple(name for name, *_ in ROLLING)
CHANGE_NAMES = tuple(name for name, *_ in DIFFERENCES) + tuple(name for name, _ in VOLATILITY)
# Sums and lags of whole hours stay integers; everything else is rounded to two digits.
WHOLE_NUMBERS = {n for n in LAG_NAMES if n.startswith("hours_")} | {"total_rain_hours_7d_prev"}


def lag_columns(window: WindowSpec, lags=LAGS) -> dict[str, Column]:
    return {f"{stem}_lag_{k}d": F.lag(source, k).over(window) for stem, source, ks in lags for k in ks}


def rolling_columns(window: WindowSpec, rolling=ROLLING) -> dict[str, Column]:
    frames_ending_yesterday = {rows: window.rowsBetween(-rows, -1) for *_, rows in rolling}
    return {
        name: getattr(F, aggregate)(source).over(frames_ending_yesterday[rows])
        for name, aggregate, source, rows in rolling
    }


def change_columns() -> dict[str, Column]:
    changes = {name: f"({left} - {right}) / {divisor}D" for name, left, right, divisor in DIFFERENCES}
    return {name: F.expr(rounded(sql)) for name, sql in (changes | dict(VOLATILITY)).items()}


def _add(df: DataFrame, spec: SeriesSpec, build, limit, block_rows) -> DataFrame:
    return frames.over_rows(
        df, [spec.entity], spec.order, build, before=LONGEST_LOOK_BACK, limit=limit, block_rows=block_rows
    )


def lag_features(df: DataFrame, spec: SeriesSpec = WEATHER, lags=LAGS, limit=None, block_rows=frames.BLOCK_ROWS) -> DataFrame:
    return _add(df, spec, lambda w: lag_columns(w, lags), limit, block_rows)


def rolling_features(df: DataFrame, spec: SeriesSpec = WEATHER, rolling=ROLLING, limit=None, block_rows=frames.BLOCK_ROWS) -> DataFrame:
    return _add(df, spec, lambda w: rolling_columns(w, rolling), limit, block_rows)


def feature_mart(
    daily: DataFrame,
    spec: SeriesSpec = WEATHER,
    as_of=None,
    limit: int | None = None,
    block_rows: int = frames.BLOCK_ROWS,
) -> DataFrame:
    """Lags, rolling frames and their differences; an entity's first day has no history and is
    left out.

    A daily mart holds one row per entity and calendar day, so an entity's series is tens of
    thousands of rows at most and ``limit`` defaults to "known to be small". Pass a limit for
    series of finer grain.
    """

    def build(window: WindowSpec) -> dict[str, Column]:
        return lag_columns(window) | rolling_columns(window)

    windowed = _add(daily, spec, build, limit, block_rows)
    kept = until(windowed.filter(F.col("temp_lag_1d").isNotNull()), as_of, spec.time)
    # Differences use the unrounded frames, so they are added before anything is rounded.
    changed = kept.withColumns(change_columns())
    plain = [F.col(n) if n in WHOLE_NUMBERS else round_half_up(n).alias(n) for n in LAG_NAMES + ROLLING_NAMES]
    return changed.select(
        surrogate_key(spec.entity, spec.time).alias("feature_id"), *IDENTITY, *plain, *CHANGE_NAMES
    )


def regular_days(daily: DataFrame, spec: SeriesSpec = WEATHER) -> DataFrame:
    """Insert the missing calendar days of each entity (measures NULL), so that row lags become
    calendar lags. The span of an entity is bounded by the calendar."""
    spans = daily.groupBy(spec.entity).agg(F.min(spec.time).alias("_a"), F.max(spec.time).alias("_b"))
    spine = spans.select(spec.entity, F.explode(F.sequence("_a", "_b")).alias(spec.time))
    return spine.join(daily, [spec.entity, spec.time], "left")
