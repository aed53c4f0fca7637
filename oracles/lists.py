"""The names and definitions of the feature mart and of the model inputs, kept apart from
the engine's own so that a wrong name on either side shows."""

LAGS = (("temp", "avg_temperature", (1, 2, 3, 7, 14)), ("max_temp", "max_temperature", (1,)), ("min_temp", "min_temperature", (1,)),
 ("temp_range", "temp_range", (1,)), ("temp_std_dev", "temp_std_dev", (1,)), ("morning_temp", "morning_temp", (1,)),
 ("afternoon_temp", "afternoon_temp", (1,)), ("evening_temp", "evening_temp", (1,)), ("night_temp", "night_temp", (1,)),
 ("precip", "total_precipitation", (1, 3, 7)), ("hours_rain", "hours_with_rain", (1,)), ("wind_speed", "avg_wind_speed", (1,)),
 ("max_wind_speed", "max_wind_speed", (1,)), ("wind_direction", "dominant_wind_direction", (1,)), ("humidity", "avg_humidity", (1,)),
 ("max_humidity", "max_humidity", (1,)), ("pressure", "avg_pressure", (1,)), ("max_pressure", "max_pressure", (1,)),
 ("min_pressure", "min_pressure", (1,)), ("cloud_cover", "avg_cloud_cover", (1,)), ("hours_hot", "hours_hot", (1,)),
 ("hours_cold", "hours_cold", (1,)), ("hours_humid", "hours_humid", (1,)), ("hours_windy", "hours_windy", (1,)),
 ("hours_cloudy", "hours_cloudy", (1,)), ("temp_humidity_index", "avg_temp_humidity_index", (1,)),
 ("wind_chill_index", "avg_wind_chill_index", (1,)))

ROLLING = (("temp_rolling_7d_prev", "avg", "avg_temperature", 7), ("temp_rolling_14d_prev", "avg", "avg_temperature", 14),
 ("temp_rolling_30d_prev", "avg", "avg_temperature", 30), ("temp_rolling_std_7d_prev", "stddev_samp", "avg_temperature", 7),
 ("temp_rolling_std_30d_prev", "stddev_samp", "avg_temperature", 30), ("temp_rolling_min_7d_prev", "min", "avg_temperature", 7),
 ("temp_rolling_max_7d_prev", "max", "avg_temperature", 7), ("precip_rolling_7d_prev", "avg", "total_precipitation", 7),
 ("precip_rolling_30d_prev", "avg", "total_precipitation", 30), ("precip_sum_7d_prev", "sum", "total_precipitation", 7),
 ("total_rain_hours_7d_prev", "sum", "hours_with_rain", 7), ("humidity_rolling_7d_prev", "avg", "avg_humidity", 7),
 ("humidity_rolling_30d_prev", "avg", "avg_humidity", 30), ("pressure_rolling_7d_prev", "avg", "avg_pressure", 7),
 ("pressure_rolling_30d_prev", "avg", "avg_pressure", 30), ("pressure_rolling_std_7d_prev", "stddev_samp", "avg_pressure", 7),
 ("wind_speed_rolling_7d_prev", "avg", "avg_wind_speed", 7), ("max_wind_speed_7d_prev", "max", "max_wind_speed", 7),
 ("cloud_cover_rolling_7d_prev", "avg", "avg_cloud_cover", 7))

DIFFERENCES = (("temp_change_1d_to_2d", "temp_lag_1d", "temp_lag_2d", 1.0), ("temp_change_1d_to_3d", "temp_lag_1d", "temp_lag_3d", 1.0),
 ("temp_change_1d_to_7d", "temp_lag_1d", "temp_lag_7d", 1.0), ("temp_diff_from_7d_avg", "temp_lag_1d", "temp_rolling_7d_prev", 1.0),
 ("temp_diff_from_30d_avg", "temp_lag_1d", "temp_rolling_30d_prev", 1.0), ("precip_change_1d_to_7d", "precip_lag_1d", "precip_lag_7d", 1.0),
 ("precip_diff_from_7d_avg", "precip_lag_1d", "precip_rolling_7d_prev", 1.0),
 ("humidity_diff_from_7d_avg", "humidity_lag_1d", "humidity_rolling_7d_prev", 1.0),
 ("humidity_diff_from_30d_avg", "humidity_lag_1d", "humidity_rolling_30d_prev", 1.0),
 ("pressure_diff_from_7d_avg", "pressure_lag_1d", "pressure_rolling_7d_prev", 1.0),
 ("pressure_diff_from_30d_avg", "pressure_lag_1d", "pressure_rolling_30d_prev", 1.0), ("temp_trend_3d", "temp_lag_1d", "temp_lag_3d", 2.0),
 ("temp_trend_7d", "temp_lag_1d", "temp_lag_7d", 6.0),
 ("wind_speed_diff_from_7d_avg", "wind_speed_lag_1d", "wind_speed_rolling_7d_prev", 1.0))

VOLATILITY = (("temp_volatility_7d", "temp_rolling_std_7d_prev"), ("temp_volatility_30d", "temp_rolling_std_30d_prev"))

WHOLE_NUMBERS = ("hours_cloudy_lag_1d", "hours_cold_lag_1d", "hours_hot_lag_1d", "hours_humid_lag_1d", "hours_rain_lag_1d", "hours_windy_lag_1d",
 "total_rain_hours_7d_prev")

LAG_NAMES = ("temp_lag_1d", "temp_lag_2d", "temp_lag_3d", "temp_lag_7d", "temp_lag_14d", "max_temp_lag_1d", "min_temp_lag_1d", "temp_range_lag_1d",
 "temp_std_dev_lag_1d", "morning_temp_lag_1d", "afternoon_temp_lag_1d", "evening_temp_lag_1d", "night_temp_lag_1d", "precip_lag_1d",
 "precip_lag_3d", "precip_lag_7d", "hours_rain_lag_1d", "wind_speed_lag_1d", "max_wind_speed_lag_1d", "wind_direction_lag_1d",
 "humidity_lag_1d", "max_humidity_lag_1d", "pressure_lag_1d", "max_pressure_lag_1d", "min_pressure_lag_1d", "cloud_cover_lag_1d",
 "hours_hot_lag_1d", "hours_cold_lag_1d", "hours_humid_lag_1d", "hours_windy_lag_1d", "hours_cloudy_lag_1d", "temp_humidity_index_lag_1d",
 "wind_chill_index_lag_1d")

ROLLING_NAMES = ("temp_rolling_7d_prev", "temp_rolling_14d_prev", "temp_rolling_30d_prev", "temp_rolling_std_7d_prev", "temp_rolling_std_30d_prev",
 "temp_rolling_min_7d_prev", "temp_rolling_max_7d_prev", "precip_rolling_7d_prev", "precip_rolling_30d_prev", "precip_sum_7d_prev",
 "total_rain_hours_7d_prev", "humidity_rolling_7d_prev", "humidity_rolling_30d_prev", "pressure_rolling_7d_prev",
 "pressure_rolling_30d_prev", "pressure_rolling_std_7d_prev", "wind_speed_rolling_7d_prev", "max_wind_speed_7d_prev",
 "cloud_cover_rolling_7d_prev")

CHANGE_NAMES = ("temp_change_1d_to_2d", "temp_change_1d_to_3d", "temp_change_1d_to_7d", "temp_diff_from_7d_avg", "temp_diff_from_30d_avg",
 "precip_change_1d_to_7d", "precip_diff_from_7d_avg", "humidity_diff_from_7d_avg", "humidity_diff_from_30d_avg",
 "pressure_diff_from_7d_avg", "pressure_diff_from_30d_avg", "temp_trend_3d", "temp_trend_7d", "wind_speed_diff_from_7d_avg",
 "temp_volatility_7d", "temp_volatility_30d")

MODEL_FEATURES = ("temp_lag_1d", "temp_lag_2d", "temp_lag_3d", "temp_lag_7d", "temp_lag_14d", "max_temp_lag_1d", "min_temp_lag_1d", "precip_lag_1d",
 "precip_lag_7d", "humidity_lag_1d", "pressure_lag_1d", "wind_speed_lag_1d", "cloud_cover_lag_1d", "temp_rolling_7d_prev",
 "temp_rolling_14d_prev", "temp_rolling_30d_prev", "temp_rolling_std_7d_prev", "temp_rolling_std_30d_prev", "temp_rolling_min_7d_prev",
 "temp_rolling_max_7d_prev", "precip_rolling_7d_prev", "precip_rolling_30d_prev", "humidity_rolling_7d_prev", "pressure_rolling_7d_prev",
 "wind_speed_rolling_7d_prev", "temp_change_1d_to_2d", "temp_change_1d_to_7d", "temp_diff_from_7d_avg", "temp_diff_from_30d_avg",
 "precip_change_1d_to_7d", "humidity_diff_from_7d_avg", "pressure_diff_from_7d_avg", "temp_trend_3d", "temp_trend_7d", "temp_volatility_7d",
 "temp_volatility_30d", "month", "day_of_week", "quarter", "is_weekend")

REGIONS = {
    "Hanoi": "Northern Vietnam",
    "Ho Chi Minh City": "Southern Vietnam",
    "Da Nang": "Central Vietnam",
    "Can Tho": "Mekong Delta",
    "Hai Phong": "Northern Vietnam",
}
