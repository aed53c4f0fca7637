"""Column roles, table schemas and the fixed values of the weather models."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns play which role. ``tie_break`` makes the row order total when several
    rows of an entity carry the same time."""

    entity: str = "location_name"
    time: str = "datetime"
    day: str = "date"
    tie_break: tuple[str, ...] = field(default_factory=tuple)

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.tie_break)


MEASURES = ("temperature", "humidity", "precipitation", "pressure", "wind_speed", "wind_direction", "cloud_cover")


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()

RAW_READINGS = _struct(
    record_id=_S,
    datetime=T.TimestampNTZType(),
    location_name=_S,
    latitude=_D,
    longitude=_D,
    **{name: _D for name in MEASURES},
    extract_date=T.DateType(),
)

PREDICTIONS = _struct(
    prediction_id=_S,
    location_name=_S,
    prediction_date=T.DateType(),
    forecast_date=T.DateType(),
    days_ahead=_I,
    predicted_temperature=_D,
    predicted_precipitation=_D,
    predicted_humidity=_D,
    actual_temperature=_D,
    actual_precipitation=_D,
    actual_humidity=_D,
    model_name=_S,
    model_version=_S,
    confidence_score=_D,
    temperature_error=_D,
    precipitation_error=_D,
    absolute_error=_D,
    created_at=T.TimestampNTZType(),
    updated_at=T.TimestampNTZType(),
)
PREDICTION_KEY = ("location_name", "prediction_date", "forecast_date", "model_name")

PERFORMANCE = _struct(
    performance_id=T.LongType(),
    model_name=_S,
    model_version=_S,
    evaluation_date=T.DateType(),
    rmse=_D,
    mae=_D,
    r_squared=_D,
    mape=_D,
    mse=_D,
    median_absolute_error=_D,
    max_error=_D,
    training_records=_I,
    test_records=_I,
    validation_records=_I,
    locations_covered=_I,
    date_range_start=T.DateType(),
    date_range_end=T.DateType(),
    model_type=_S,
    hyperparameters=_S,
    features_used=_S,
    created_at=T.TimestampNTZType(),
    created_by=_S,
)
PERFORMANCE_KEY = ("model_name", "model_version", "evaluation_date")

LOCATION_METADATA = _struct(
    location_name=_S,
    country=_S,
    region=_S,
    timezone=_S,
    population=_I,
    elevation_meters=_D,
    climate_zone=_S,
    description=_S,
)
SEASON_MAPPINGS = _struct(month=_I, season=_S, season_type=_S, avg_temp_range=_S, rainfall_level=_S)
WEATHER_THRESHOLDS = _struct(metric=_S, min_value=_D, max_value=_D, unit=_S, description=_S)

# Tokens that stand for NULL in delimited files.
NULL_TOKENS = ("NULL", "null", "", "N/A", "NA")

# Calendar names, week starting on Sunday.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
DRY_MONTHS = (11, 12, 1, 2, 3, 4)

# Region of each known site.
SITE_REGIONS = {
    "Hanoi": "Northern Vietnam",
    "Ho Chi Minh City": "Southern Vietnam",
    "Da Nang": "Central Vietnam",
    "Can Tho": "Mekong Delta",
    "Hai Phong": "Northern Vietnam",
}
COUNTRY = "Vietnam"
TIMEZONE = "Asia/Ho_Chi_Minh"

# The 40 model inputs, in order, and the target.
TARGET = "avg_temperature"
MODEL_FEATURES = (
    "temp_lag_1d", "temp_lag_2d", "temp_lag_3d", "temp_lag_7d", "temp_lag_14d",
    "max_temp_lag_1d", "min_temp_lag_1d", "precip_lag_1d", "precip_lag_7d",
    "humidity_lag_1d", "pressure_lag_1d", "wind_speed_lag_1d", "cloud_cover_lag_1d",
    "temp_rolling_7d_prev", "temp_rolling_14d_prev", "temp_rolling_30d_prev",
    "temp_rolling_std_7d_prev", "temp_rolling_std_30d_prev",
    "temp_rolling_min_7d_prev", "temp_rolling_max_7d_prev",
    "precip_rolling_7d_prev", "precip_rolling_30d_prev",
    "humidity_rolling_7d_prev", "pressure_rolling_7d_prev", "wind_speed_rolling_7d_prev",
    "temp_change_1d_to_2d", "temp_change_1d_to_7d", "temp_diff_from_7d_avg", "temp_diff_from_30d_avg",
    "precip_change_1d_to_7d", "humidity_diff_from_7d_avg", "pressure_diff_from_7d_avg",
    "temp_trend_3d", "temp_trend_7d", "temp_volatility_7d", "temp_volatility_30d",
    "month", "day_of_week", "quarter", "is_weekend",
)
