"""Oracle SQL per query name. Names without a text are not expressible this way."""

from __future__ import annotations

from oracles import lists as ft
from oracles import models
from oracles.base import CONDITIONS, FLAGS, PART, SEASON, cols, full, normal_quantile, p_normal, p_t, poly, rnd

MODEL_FEATURES = ft.MODEL_FEATURES
REGION = "case location_name " + " ".join(f"when '{s}' then '{r}'" for s, r in ft.REGIONS.items()) + " else 'Other' end"
ORACLES: dict[str, str] = {}
MEASURES = ("temperature", "humidity", "precipitation", "pressure", "wind_speed", "wind_direction", "cloud_cover")
GATED = MEASURES[:5]
DAILY_VARIABLES = ("avg_temperature", "total_precipitation", "avg_humidity", "avg_pressure", "avg_wind_speed")
CORRELATED = (
    "avg_temperature", "max_temperature", "min_temperature", "total_precipitation", "avg_humidity", "avg_pressure",
    "avg_wind_speed", "max_wind_speed", "avg_cloud_cover", "avg_temp_humidity_index", "avg_wind_chill_index",
)
HOURLY_CORRELATED = ("temperature", "humidity", "precipitation", "pressure", "wind_speed", "cloud_cover")
PAIRS = (
    ("avg_temperature", "avg_humidity"), ("avg_temperature", "total_precipitation"), ("avg_temperature", "avg_pressure"),
    ("avg_humidity", "total_precipitation"), ("avg_wind_speed", "total_precipitation"),
)


def add(name: str, spec: str, source: str, digits: int = 6, **extra: str) -> None:
    ORACLES[name] = full(f"select {cols(spec, digits)} from ({source})", **extra)


def fs(names, kind: str = "f") -> str:
    return ", ".join(f"{n} {kind}" for n in names)


def stack(names, source: str, keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return " union all ".join(f"select {k}'{n}' as variable, cast({n} as double) as value from {source} where {n} is not null" for n in names)


# -- A
add("A01_csv_reader", "event_id i, location_name, temperature f", "from readings")
add("A02_json_reader", "event_id i, location_name, temperature f",
    "select event_id, location_name, temperature from readings union all select event_id, location_name, temperature * 2 from readings")
add("A03_unpack_payload", "vec_id i, epoch i, temperature f, humidity f",
    """select vec_id, 1704067200 + vec_id * 86400 + 3600 * (i - 1) as epoch, cast(embedding[i] as double) as temperature,
       cast(embedding[i + 1] as double) as humidity from (select *, unnest(range(1, len(embedding) + 1)) as i from embeddings)""")
add("A04_tag_sites", "event_id i, wind_speed f, location_name", "from readings")
add("A05_prepare_batch", f"record_id, location_name, latitude f, longitude f, {fs(MEASURES)}, extract_date d",
    "select * replace (location_name || '_' || strftime(datetime, '%Y-%m-%d %H:%M:%S') as record_id, date '2024-02-01' as extract_date) from readings")
add("A06_incremental_append", "date d, location_name, records i, ids i",
    "select cast(datetime as date) as date, location_name, count(*) as records, sum(event_id) as ids from readings group by all")
add("A06_new_rows", "event_id i, date d", "select event_id, cast(datetime as date) as date from readings where datetime >= timestamp '2024-01-16 12:00:00'")
add("A07_full_replace", "event_id i, location_name, wind_speed f", "from readings where wind_speed > 10")
add("A08_table_modes", "location_name, records i", "select location_name, 2 * count(*) as records from readings group by all")
add("A09_result_csv", "location_name, wind_speed_count i, wind_speed_min f, wind_speed_max f",
    "select location_name, count(wind_speed) as wind_speed_count, min(wind_speed) as wind_speed_min, max(wind_speed) as wind_speed_max from readings group by all")
# The season of each month and its attributes.
SEASON_ROWS = """(select * from (values (1, 'Dry Season', 'Cool', '15-25', 'Low'), (2, 'Dry Season', 'Cool', '16-26', 'Low'),
  (3, 'Dry Season', 'Warm', '18-28', 'Low'), (4, 'Dry Season', 'Hot', '22-33', 'Low'), (5, 'Rainy Season', 'Hot', '24-34', 'Medium'),
  (6, 'Rainy Season', 'Hot', '25-34', 'High'), (7, 'Rainy Season', 'Hot', '25-34', 'High'), (8, 'Rainy Season', 'Hot', '25-33', 'High'),
  (9, 'Rainy Season', 'Hot', '24-32', 'High'), (10, 'Rainy Season', 'Warm', '23-31', 'Medium'), (11, 'Dry Season', 'Cool', '20-29', 'Low'),
  (12, 'Dry Season', 'Cool', '17-26', 'Low')) as t(month, season, season_type, avg_temp_range, rainfall_level))"""
add("A10_seed_loader", "month i, records i, season, season_type, avg_temp_range, rainfall_level",
    f"select * from (select month(l_shipdate) as month, count(*) as records from lineitem group by all) join {SEASON_ROWS} using (month)")
add("A11_sql_query", "location_name, days i, strongest_wind f",
    "select location_name, count(*) as days, max(max_wind_speed) as strongest_wind from daily where hours_with_rain > 0 group by all")
add("A12_filtered_scan", "location_name, date d, avg_temperature f", "from ldaily where date >= date '1998-01-01'")
add("A13_prediction_store", "location_name, forecast_date d, model_version, predicted_temperature f",
    "select location_name, date as forecast_date, if(date >= date '1999-01-01', '2', '1') as model_version, temp_lag_1d as predicted_temperature from lfeatures")


def metric_sql(source: str, prediction: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    return f"""select {g}count(*) as n, avg(e * e) as mse, sqrt(avg(e * e)) as rmse, avg(abs(e)) as mae,
      1 - sum(e * e) / (var_pop(y) * count(*)) as r2, avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)) * 100 as mape,
      median(abs(e)) as median_ae, max(abs(e)) as max_error
      from (select *, avg_temperature as y, avg_temperature - ({prediction}) as e from {source}) {'group by all' if by else ''}"""


METRICS = "n i, mse f, rmse f, mae f, r2 f, mape f, median_ae f, max_error f"
add("A14_performance_store",
    "model_name, model_version, evaluation_date d, rmse f, mae f, r_squared f, mape f, mse f, median_absolute_error f, max_error f, test_records i",
    f"""select 'last_value' as model_name, cast(year as varchar) as model_version, make_date(year, 12, 31) as evaluation_date, *,
    r2 as r_squared, median_ae as median_absolute_error, n as test_records from ({metric_sql('lfeatures', 'temp_lag_1d', 'year')})""")

# -- B
add("B01_require_keys", "event_id i, location_name", "from readings where event_id % 211 <> 0 and event_id % 307 <> 0")
PARTS = "date d, hour i, day i, month i, year i, day_of_week i, week_of_year i, quarter i"
add("B02_calendar_parts", f"{PARTS}, weekday_from_monday i, n i",
    "select date, hour, day, month, year, day_of_week, week_of_year, quarter, isodow(date) - 1 as weekday_from_monday, count(*) as n from lstaged group by all")
add("B03_missing_flags", "event_id i, has_missing_temperature i, has_missing_humidity i, has_missing_precipitation i",
    "select event_id, no_t as has_missing_temperature, no_h as has_missing_humidity, no_p as has_missing_precipitation from staged")
add("B04_outlier_flags", f"event_id i, {fs(FLAGS, 'i')}", "from flagged")
add("B05_clean_outliers", f"event_id i, {fs(GATED)}", "from cleaned")
add("B06_quality_score", "event_id i, data_quality_score i", "from checked")
add("B07_season", "month i, season, n i", f"select month, {SEASON} as season, count(*) as n from lstaged group by all")
add("B08_time_of_day", "event_id i, hour i, time_of_day", f"select event_id, hour, {PART} as time_of_day from staged")
add("B09_day_and_month_names", "date d, day_name, month_name, n i",
    "select date, dayname(date) as day_name, monthname(date) as month_name, count(*) as n from lstaged group by all")
add("B10_condition_flags", "event_id i, is_raining i, is_hot i, is_cold i, is_humid i, is_windy i, is_cloudy i", f"select event_id, {CONDITIONS} from readings")
add("B11_weekend_flag", "event_id i, is_weekend i", "select event_id, isodow(datetime) >= 6 as is_weekend from readings")
add("B12_comfort_indices", "event_id i, temp_humidity_index f, wind_chill_index f",
    "select event_id, temperature + humidity / 100e0 * 5 as temp_humidity_index, temperature - wind_speed / 10e0 as wind_chill_index from readings")
add("B13_precipitation_intensity", "event_id i, precipitation_intensity",
    """select event_id, if(precipitation = 0, 'No Rain', if(precipitation < 2.5, 'Light Rain', if(precipitation < 10, 'Moderate Rain',
       if(precipitation < 50, 'Heavy Rain', 'Very Heavy Rain')))) as precipitation_intensity from readings""")
add("B14_rain_classes", "rain_class, n i",
    """select c as rain_class, count(*) as n from ldaily join (values (0, 1, 'Light'), (1, 10, 'Moderate'), (10, 50, 'Heavy'), (50, 200, 'Very Heavy')) as t(lo, hi, c)
       on total_precipitation > lo and total_precipitation <= hi group by all""")
add("B15_no_future", "event_id i, date d", "from staged where date <= date '2024-01-15'")
add("B16_history_required", "location_name, date d, temp_lag_1d f", "from windowed where temp_lag_1d is not null")
add("B17_numeric_coercion", "event_id i, reading f", "select event_id, if(event_id % 13 = 0, null, value) as reading from events")
add("B18_quarter_label", "month_group, n i", "select 'Q' || quarter as month_group, count(*) as n from ldaily group by all")
HOT = """select *, avg_temperature > t as is_hot, avg_humidity > h as is_very_humid from ldaily,
  (select quantile_cont(avg_temperature, 0.75) as t, quantile_cont(avg_humidity, 0.75) as h from ldaily)"""
add("B19_above_quantile", "location_name, date d, is_hot i, is_very_humid i", HOT)
# The valid range of each measure.
LIMITS = "(values ('temperature', -50, 60), ('humidity', 0, 100), ('precipitation', 0, 500), ('pressure', 950, 1050), ('wind_speed', 0, 150), ('cloud_cover', 0, 100)) as b(metric, lo, hi)"
add("B20_threshold_table", "event_id i, metric, value f",
    f"select event_id, metric, value from ({stack(MEASURES, 'readings', 'event_id')}) s join {LIMITS} on s.variable = metric where value < lo or value > hi")
add("B21_model_columns", f"location_name, date d, label f, {fs(MODEL_FEATURES)}", "select *, avg_temperature as label from lfeatures")
add("B22_entity_slice", "date d, avg_temperature f, season", "from ldaily where location_name = 'Hanoi'")

# -- C
add("C01_missing_sites", "location_name",
    "select v as location_name from unnest(['Hanoi', 'Ho Chi Minh City', 'Da Nang', 'Can Tho', 'Hai Phong']) as t(v) where v not in (select location_name from ldaily)")
add("C02_keys_not_in_set", "key i", "select o_orderkey as key from orders where o_orderkey not in (select l_orderkey from lineitem)")
add("C03_star_join", "location_id i, date_id i, region, weekday, avg_temperature f",
    f"""select dense_rank() over (order by location_name) as location_id, datediff('day', min(date) over (), date) + 1 as date_id,
       {REGION} as region,
       day_name as weekday, avg_temperature from ldaily""")
add("C04_season_attributes", "season_type, rainfall_level, days i, avg_temperature f",
    f"select season_type, rainfall_level, count(*) as days, avg(avg_temperature) as avg_temperature from ldaily join {SEASON_ROWS} s using (month) group by all")
add("C05_site_attributes", "location_name, avg_temperature_mean f, population i, elevation_meters f, climate_zone",
    """select location_name, avg(avg_temperature) as avg_temperature_mean, any_value(p) as population, any_value(e) as elevation_meters, any_value(c) as climate_zone
       from ldaily join (values ('Hanoi', 8246600, 12, 'Subtropical'), ('Ho Chi Minh City', 9077158, 19, 'Tropical'), ('Da Nang', 1230000, 3, 'Tropical monsoon')) as t(s, p, e, c)
       on s = location_name group by location_name""")
add("C06_global_threshold", "location_name, date d, max_temperature f, temp_high f",
    "select * from (select *, quantile_cont(max_temperature, 0.95) over () as temp_high from ldaily) where max_temperature >= temp_high")
add("C07_complete_pairs", "event_id i, temperature f, humidity f", "from readings where temperature is not null and humidity is not null")
add("C08_verify_forecasts",
    "location_name, forecast_date d, predicted_temperature f, actual_temperature f, actual_precipitation f, actual_humidity f, temperature_error f, precipitation_error f, absolute_error f",
    """select location_name, date as forecast_date, temp_lag_1d as predicted_temperature, avg_temperature as actual_temperature,
       total_precipitation as actual_precipitation, avg_humidity as actual_humidity, temp_lag_1d - avg_temperature as temperature_error,
       precip_lag_1d - total_precipitation as precipitation_error, abs(temp_lag_1d - avg_temperature) as absolute_error
       from (select * , lag(avg_temperature) over w as temp_lag_1d, lag(total_precipitation) over w as precip_lag_1d from ldaily
       window w as (partition by location_name order by date)) where temp_lag_1d is not null""")

# -- D
DAILY_COLUMNS = (
    "daily_id, location_name, date d, day_of_week i, day_name, month i, month_name, year i, quarter i, season, is_weekend i, "
    "avg_temperature f, max_temperature f, min_temperature f, temp_std_dev f, temp_range f, morning_temp f, afternoon_temp f, "
    "evening_temp f, night_temp f, total_precipitation f, max_hourly_precipitation f, avg_precipitation f, hours_with_rain i, "
    "avg_wind_speed f, max_wind_speed f, min_wind_speed f, dominant_wind_direction f, avg_humidity f, max_humidity f, min_humidity f, "
    "avg_pressure f, max_pressure f, min_pressure f, avg_cloud_cover f, hours_hot i, hours_cold i, hours_humid i, hours_windy i, "
    "hours_cloudy i, avg_temp_humidity_index f, avg_wind_chill_index f, avg_data_quality_score f, total_hourly_records i"
)
add("D01_daily_rollup", DAILY_COLUMNS, "from daily")
add("D01_daily_rollup_long", DAILY_COLUMNS, "from ldaily")
add("D01e_circular_wind", "location_name, date d, dominant_wind_direction f2, circular_wind_direction f2",
    """select location_name, date, avg(wind_direction) as dominant_wind_direction,
       (degrees(atan2(avg(sin(radians(wind_direction))), avg(cos(radians(wind_direction))))) + 360) % 360 as circular_wind_direction from enriched group by all""")
add("D02_surrogate_key", "event_id i, key",
    "select event_id, md5(concat_ws('-', if(event_id % 7 = 0, '_dbt_utils_surrogate_key_null_', location_name), extract_date)) as key from readings")


def agg_sql(by: str, wanted: dict, source: str) -> str:
    f = {"count": "count", "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "sum": "sum"}
    return f"select {by}, " + ", ".join(f"{f[s]}({c}) as {c}_{s}" for c, ss in wanted.items() for s in ss) + f" from {source} group by {by}"


def agg_cols(wanted: dict) -> str:
    return ", ".join(f"{c}_{s} {'i' if s == 'count' else 'f'}" for c, ss in wanted.items() for s in ss)


def add_grouped(name: str, by: str, by_cols: str, wanted: dict, source: str, digits: int = 6) -> None:
    add(name, f"{by_cols}, {agg_cols(wanted)}", agg_sql(by, wanted, source), digits)


add_grouped("D03_site_statistics", "location_name", "location_name",
            {"temperature": ("count", "mean", "std", "min", "max"), "precipitation": ("sum", "mean"), "humidity": ("mean",), "wind_speed": ("mean",)}, "readings", 2)
add("D04_value_counts", "attribute, value, n i",
    " union all ".join(f"select '{c}' as attribute, cast({c} as varchar) as value, count(*) as n from lstaged group by {c}" for c in ("location_name", "hour", "day_of_week", "month", "year")))
add("D05_load_summary", "total_records i, locations i, unique_days i, unique_hours i, span_days i",
    """select count(*) as total_records, count(distinct location_name) as locations, count(distinct cast(datetime as date)) as unique_days,
       count(distinct date_trunc('hour', datetime)) as unique_hours, floor(epoch(max(datetime) - min(datetime)) / 86400) as span_days from readings""")
add("D05_load_by_site", "location_name, records i, first_date d, last_date d",
    "select location_name, count(*) as records, min(extract_date) as first_date, max(extract_date) as last_date from readings group by all")
add("D06_extract_profile", "date d, records i, sites i, expected i, is_complete i",
    "select date, count(*) as records, count(distinct location_name) as sites, 120 as expected, count(*) >= 120 as is_complete from staged group by all")
add("D06_null_shares", "column_name, nulls i, null_pct f",
    " union all ".join(f"select '{c}' as column_name, count(*) - count({c}) as nulls, (count(*) - count({c})) * 100e0 / count(*) as null_pct from readings" for c in MEASURES))
add("D07_completeness", "total_records i, missing_values i, duplicate_records i, missing_pct f",
    """select n as total_records, m as missing_values, n - u as duplicate_records, m * 100e0 / (n * 5) as missing_pct from
       (select count(*) as n, sum((temperature is null)::int + (humidity is null)::int + (precipitation is null)::int) as m from readings),
       (select count(*) as u from (select distinct location_name, temperature, humidity, precipitation, cloud_cover from readings))""")
add("D08_mean_of_daily_totals", "average_daily f, days_with_rain i",
    "select avg(t) as average_daily, count(*) filter (t > 0) as days_with_rain from (select date, sum(precipitation) as t from staged group by date)")
DESCRIBE = "count i, mean f, std f, min f, p25 f, p50 f, p75 f, max f"


def describe_sql(names, source: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    return f"""select {g}variable, count(*) as count, avg(value) as mean, stddev_samp(value) as std, min(value) as min,
      quantile_cont(value, 0.25) as p25, quantile_cont(value, 0.5) as p50, quantile_cont(value, 0.75) as p75, max(value) as max
      from ({stack(names, source, by)}) group by all"""


add("D09_describe", f"variable, {DESCRIBE}", describe_sql(MEASURES, "readings"))
add("D10_describe_categories", "attribute, count i, unique i, top, freq i",
    " union all ".join(
        f"""select '{c}' as attribute, sum(n) as count, count(*) as "unique", first({c} order by n desc, {c}) as top, max(n) as freq
            from (select {c}, count(*) as n from orders group by {c})""" for c in ("o_orderstatus", "o_orderpriority")))
ORACLES["D10_describe_categories"] = ORACLES["D10_describe_categories"].replace("cast(unique as bigint) as unique", 'cast("unique" as bigint) as "unique"')
add("D11_grouped_describe", f"location_name, variable, {DESCRIBE}", describe_sql(("avg_temperature", "total_precipitation", "avg_wind_speed"), "ldaily", "location_name"))
SEASONAL = {"avg_temperature": ("mean", "std"), "total_precipitation": ("sum",), "avg_humidity": ("mean",), "avg_wind_speed": ("mean",)}
add_grouped("D12_season_month", "season, month", "season, month i", SEASONAL, "ldaily")
add_grouped("D13_season_statistics", "season", "season", SEASONAL | {"avg_temperature": ("mean", "std", "min", "max"), "total_precipitation": ("sum", "mean")}, "ldaily")
add_grouped("D14_month_statistics", "month", "month i",
            {"avg_temperature": ("mean",), "max_temperature": ("max",), "min_temperature": ("min",), "total_precipitation": ("sum",), "avg_wind_speed": ("mean",)}, "ldaily")
add_grouped("D15_site_month_profile", "location_name, month", "location_name, month i", {"avg_temperature": ("mean",)}, "ldaily")
CITY_COLUMNS = ("Hanoi", "Ho Chi Minh City", "Da Nang")
ORACLES["D16_pivot_precipitation"] = full(
    "select cast(month as bigint) as month, "
    + ", ".join(f"""{rnd(f"sum(total_precipitation) filter (location_name = '{c}')")} as "{c}" """ for c in CITY_COLUMNS)
    + " from ldaily group by month")
ORACLES["D17_pivot_temperature"] = full(
    "select location_name, " + ", ".join(f'{rnd(f"avg(avg_temperature) filter (month = {m})")} as "{m}"' for m in range(1, 13)) + " from ldaily group by location_name")
add("D18_rainy_days", "location_name, rainy_days i", "select location_name, count(*) as rainy_days from ldaily where total_precipitation > 0 group by all")
add("D18_windy_days", "location_name, windy_days i", "select location_name, count(*) as windy_days from ldaily where hours_windy > 0 group by all")
add_grouped("D19_site_means", "location_name", "location_name", {"avg_temperature": ("mean",), "total_precipitation": ("mean",), "hours_with_rain": ("mean",)}, "ldaily")
for key in ("D20_exact_quantiles", "D20_exact_quantiles_by_position"):
    add(key, "location_name, variable, probability f, quantile f",
        " union all ".join(f"select location_name, variable, {p}e0 as probability, quantile_cont(value, {p}) as quantile from ({stack(('temperature', 'wind_speed'), 'readings', 'location_name')}) group by all"
                           for p in (0.05, 0.25, 0.5, 0.75, 0.95)))
add("D21_extreme_days", "location_name, hot_days i, cold_days i, heavy_rain_days i, high_wind_days i",
    """select location_name, count(*) filter (max_temperature >= a) as hot_days, count(*) filter (min_temperature <= b) as cold_days,
       count(*) filter (total_precipitation >= c) as heavy_rain_days, count(*) filter (max_wind_speed >= d) as high_wind_days
       from ldaily, (select quantile_cont(max_temperature, 0.95) as a, quantile_cont(min_temperature, 0.05) as b,
       quantile_cont(total_precipitation, 0.95) as c, quantile_cont(max_wind_speed, 0.95) as d from ldaily) group by all""")


def histogram_sql(source: str, bins: int, by: str = "") -> str:
    over = f"over (partition by {by + ', ' if by else ''}variable)"
    return f"""select {by + ', ' if by else ''}variable, least(floor((value - lo) / ((hi - lo) / {bins})), {bins - 1}) as bin, count(*) as n
      from (select *, min(value) {over} as lo, max(value) {over} as hi from ({source})) group by all"""


add("D22_histogram", "variable, bin i, n i", histogram_sql(stack(MEASURES, "readings"), 50))
add("D22_grouped_histogram", "location_name, variable, bin i, n i", histogram_sql(stack(("avg_wind_speed",), "ldaily", "location_name"), 30, "location_name"))
add("D23_iqr_outliers", "variable, outliers i, outlier_pct f",
    f"""select variable, count(*) filter (value < a - 1.5 * (b - a) or value > b + 1.5 * (b - a)) as outliers,
        outliers * 100e0 / (select count(*) from readings) as outlier_pct
        from (select *, quantile_cont(value, 0.25) over w as a, quantile_cont(value, 0.75) over w as b from ({stack(MEASURES, 'readings')}) window w as (partition by variable)) group by variable""")


def box_sql(by: str, value: str) -> str:
    return f"""select {by}, a as q1, m as median, b as q3, min(v) filter (v between a - 1.5 * (b - a) and b + 1.5 * (b - a)) as whisker_low,
      max(v) filter (v between a - 1.5 * (b - a) and b + 1.5 * (b - a)) as whisker_high,
      count(*) filter (v not between a - 1.5 * (b - a) and b + 1.5 * (b - a)) as outliers
      from (select {by}, {value} as v, quantile_cont({value}, 0.25) over w as a, quantile_cont({value}, 0.5) over w as m,
      quantile_cont({value}, 0.75) over w as b from ldaily window w as (partition by {by})) group by all"""


BOX = "q1 f, median f, q3 f, whisker_low f, whisker_high f, outliers i"
add("D24_box_summary", f"location_name, {BOX}", box_sql("location_name", "avg_temperature"))
add("D24_box_summary_by_season", f"season, {BOX}", box_sql("season", "avg_wind_speed"))


def corr_sql(names, source: str) -> str:
    return " union all ".join(f"select '{a}' as variable_1, '{b}' as variable_2, corr({a}, {b}) as correlation from {source}" for a in names for b in names)


MATRIX = "variable_1, variable_2, correlation f"
add("D25_correlation_matrix", MATRIX, corr_sql(CORRELATED, "ldaily"))
add("D25_hourly_correlation_matrix", MATRIX, corr_sql(HOURLY_CORRELATED, "readings"))
add("D26_strong_pairs", MATRIX, " union all ".join(
    f"select '{a}' as variable_1, '{b}' as variable_2, corr({a}, {b}) as correlation from ldaily having abs(corr({a}, {b})) > 0.6"
    for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:]))
add("D27_top_correlations", MATRIX, f"select * from ({corr_sql(HOURLY_CORRELATED, 'readings')}) where variable_1 <> variable_2 order by round(abs(correlation), 12) desc, variable_1, variable_2 limit 3")
add("D28_contingency", "is_hot i, not_very_humid i, very_humid i",
    f"select is_hot, count(*) filter (not is_very_humid) as not_very_humid, count(*) filter (is_very_humid) as very_humid from ({HOT}) group by is_hot")
add("D29_fitted_lines", "variable_1, variable_2, n i, slope f, intercept f",
    " union all ".join(f"select '{x}' as variable_1, '{y}' as variable_2, regr_count({y}, {x}) as n, regr_slope({y}, {x}) as slope, regr_intercept({y}, {x}) as intercept from ldaily" for x, y in PAIRS))
add("D30_headline", "total_records i, locations i, first_date d, last_date d, avg_temperature f, total_precipitation f, avg_humidity f, avg_wind_speed f",
    """select count(*) as total_records, count(distinct location_name) as locations, min(date) as first_date, max(date) as last_date,
       avg(avg_temperature) as avg_temperature, sum(total_precipitation) as total_precipitation, avg(avg_humidity) as avg_humidity, avg(avg_wind_speed) as avg_wind_speed from ldaily""")
add("D31_kpis", "avg_temperature f, max_temperature f, avg_humidity f, total_precipitation f, rainy_days i, total_locations i",
    """select avg(avg_temperature) as avg_temperature, max(max_temperature) as max_temperature, avg(avg_humidity) as avg_humidity,
       sum(total_precipitation) as total_precipitation, count(*) filter (total_precipitation > 0) as rainy_days, count(distinct location_name) as total_locations from ldaily""")
add_grouped("D32_month_site_trend", "year, month, location_name", "year i, month i, location_name", {"avg_temperature": ("mean",)}, "ldaily")
add_grouped("D32_wind_by_season_site", "season, location_name", "season, location_name", {"avg_wind_speed": ("mean",)}, "ldaily")
add("D33_daily_detail", "date d, location_name, avg_temperature f, total_precipitation f, avg_humidity f, avg_wind_speed f, quality_indicator",
    "select *, if(avg_data_quality_score >= 95, 'Good', if(avg_data_quality_score >= 80, 'Fair', 'Poor')) as quality_indicator from daily")

# -- E
LAG_COLUMNS = ", ".join(f"{n} {'i' if n in ft.WHOLE_NUMBERS else 'f'}" for n in ft.LAG_NAMES)
ROLLING_COLUMNS = ", ".join(f"{n} {'i' if n in ft.WHOLE_NUMBERS else 'f'}" for n in ft.ROLLING_NAMES)
add("E01_row_numbers", "event_id i, wind_speed f, position i", "select event_id, wind_speed, row_number() over (order by wind_speed, event_id) as position from readings")
add("E02_lag_features", f"location_name, date d, {LAG_COLUMNS}", "from windowed")
add("E03_rolling_features", f"location_name, date d, {ROLLING_COLUMNS}", "from windowed")
for key in ("E04_gap_fill", "E04_gap_fill_in_blocks"):
    add(key, f"event_id i, {fs(GATED)}", "from filled")
add("E05_change_features", f"location_name, date d, {fs(n for n, _, r, _ in ft.DIFFERENCES if '_lag_' in r)}", "from features")
add("E06_deviation_features", f"location_name, date d, {fs(n for n, _, r, _ in ft.DIFFERENCES if '_rolling_' in r)}", "from features")
add("E07_volatility", "location_name, date d, temp_volatility_7d f, temp_volatility_30d f", "from features")
MART = (
    "feature_id, location_name, date d, month i, year i, quarter i, day_of_week i, is_weekend i, season, avg_temperature f, "
    f"{LAG_COLUMNS}, {ROLLING_COLUMNS}, {fs(ft.CHANGE_NAMES)}"
)
add("E08_feature_mart", MART, "from features")
add("E08_feature_mart_long", MART, "from lfeatures")
add("E08_feature_mart_in_blocks", MART, "from lfeatures")
GAPS = "select location_name, date, lag(date) over (partition by location_name order by date) as prev_date, datediff('day', lag(date) over (partition by location_name order by date), date) as day_gap from orders_daily"
add("E09_day_gaps", "location_name, date d, prev_date d, day_gap i", GAPS)
RELAG = "select location_name, date, temp_lag_1d, lag(avg_temperature) over (partition by location_name order by date) as actual_yesterday_temp, abs(temp_lag_1d - lag(avg_temperature) over (partition by location_name order by date)) as difference from {0}"
add("E10_recomputed_lag", "location_name, date d, temp_lag_1d f, actual_yesterday_temp f, difference f", RELAG.format("lfeatures"))


def trend_sql(value: str, period: int) -> str:
    h = period // 2
    ends = f" - (lag({value}, {h}) over s + lead({value}, {h}) over s) / 2e0" if period % 2 == 0 else ""
    return f"""select location_name, date, {value} as o, (row_number() over s - 1) % {period} as phase,
      if(count(*) over f = {2 * h + 1}, (sum({value}) over f{ends}) / {period}e0, null) as trend
      from ldaily where {value} is not null
      window s as (partition by location_name order by date), f as (partition by location_name order by date rows between {h} preceding and {h} following)"""


PHASES = "select location_name, phase, m - avg(m) over (partition by location_name) as seasonal from (select location_name, phase, avg(o - trend) as m from tr group by all)"
for key, value, period in (("E11_seasonal_decompose", "avg_temperature", 365), ("E11_seasonal_decompose_even_period", "avg_humidity", 30)):
    add(key, "location_name, date d, observed f, trend f, seasonal f, resid f",
        "select location_name, date, o as observed, trend, seasonal, o - trend - seasonal as resid from tr join ph using (location_name, phase)",
        tr=trend_sql(value, period), ph=PHASES)
add("E12_average_ranks", "value f, n i, rank f",
    "select value, count(*) as n, any_value(r) + (count(*) - 1) / 2e0 as rank from (select value, rank() over (order by value) as r from events) group by value")
add("E13_cumulative_share", "n_90 i, n_95 i",
    """select min(p) filter (c >= 0.9) as n_90, min(p) filter (c >= 0.95) as n_95 from (select row_number() over o as p, sum(w) over o / sum(w) over () as c
       from (select user_id, sum(value) as w from events group by all) window o as (order by w desc, user_id rows unbounded preceding))""")
add("E14_latest_per_site", "location_name, date d, avg_temperature f, avg_humidity f",
    "select * from ldaily qualify row_number() over (partition by location_name order by date desc) = 1")
add("E15_ordered_series", "location_name, date d, avg_temperature f", "from ldaily")

# -- F, G, H
add("F01_order_by", "o_orderpriority, o_orderkey i", "from orders")
add("F02_limit", "records i, different i, known i",
    "select least(count(*), 1000) as records, least(count(*), 1000) as different, least(count(*), 1000) as known from readings")
add("F03_head", "event_id i, location_name", "select * from readings order by datetime, event_id limit 10")
add("F03_tail", "event_id i, location_name", "select * from readings order by datetime desc, event_id desc limit 10")
SAMPLE = "select * from readings order by md5(event_id || '|{seed}'), event_id limit {n}"
add("F03_sample", "event_id i, location_name", SAMPLE.format(seed=7, n=10))
add("F04_hash_sample", "event_id i, wind_speed f", SAMPLE.format(seed=42, n=5000))
add("F05_top_k", "o_orderkey i, o_totalprice f", "select * from orders order by o_totalprice desc, o_orderkey limit 20")
add("G01_union_all", "event_id i, location_name", "select event_id, location_name from readings union all select event_id, location_name from readings")
add("G02_distinct", "location_name, latitude f, longitude f", "select distinct location_name, latitude, longitude from readings")
add("G03_difference", "custkey i", "select c_custkey as custkey from customer except select if(o_custkey % 7 = 0, o_custkey + 1, o_custkey) from orders")
add("H01_date_spine", "date d", "select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from ldaily")
add("H02_date_dimension", "date_id i, date d, day i, month i, year i, quarter i, day_of_week i, week_of_year i, day_name, month_name, is_weekend i, season",
    f"""select row_number() over (order by date) as date_id, date, day(date) as day, month(date) as month, year(date) as year, quarter(date) as quarter,
        dayofweek(date) as day_of_week, week(date) as week_of_year, dayname(date) as day_name, monthname(date) as month_name, isodow(date) >= 6 as is_weekend,
        {SEASON.replace('month', 'month(date)')} as season from (select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from ldaily)""")
add("H03_location_dimension", "location_id i, location_name, latitude f, longitude f, country, region, timezone",
    f"""select row_number() over (order by location_name, latitude) as location_id, *, 'Vietnam' as country,
       {REGION} as region,
       'Asia/Ho_Chi_Minh' as timezone from (select distinct location_name, latitude, longitude from shipments)""")
add("H04_regular_days", "location_name, date d, orders i",
    """select s.location_name, s.date, o.orders from (select location_name, cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date
       from orders_daily group by location_name) s left join orders_daily o on o.location_name = s.location_name and o.date = s.date""")

# -- I
add("I01_unique", "l_orderkey i, n_records i", "select l_orderkey, count(*) as n_records from lineitem group by all having count(*) > 1")
add("I02_not_null", "event_id i", "from readings where temperature is null")
add("I03_accepted_values", "event_type, invalid_count i", "select event_type, count(*) as invalid_count from events where event_type not in ('click', 'view', 'purchase') group by all")
add("I04_non_negative", "c_acctbal f, invalid_count i", "select c_acctbal, count(*) as invalid_count from customer where c_acctbal < 0 group by all")
add("I05_valid_humidity", "humidity f, invalid_count i", "select humidity, count(*) as invalid_count from readings where humidity not between 0 and 100 group by all")
add("I06_valid_temperature", "temperature f, invalid_count i", "select temperature, count(*) as invalid_count from readings where temperature not between -50 and 60 group by all")
add("I07_enough_days", "location_name, day_count i, date_range_days i, status",
    """select *, 'Too few records' as status from (select location_name, count(distinct date) as day_count, datediff('day', min(date), max(date)) as date_range_days
       from (select location_name, if(day(date) in (3, 7, 11, 19), cast(date_trunc('month', date) as date), date) as date from orders_daily) group by all) where day_count < date_range_days * 0.9""")
add("I08_quality_at_least", "location_name, avg_quality_score f, min_quality_score i, total_records i",
    """select location_name, avg(data_quality_score) as avg_quality_score, min(data_quality_score) as min_quality_score, count(*) as total_records
       from checked group by all having avg(data_quality_score) < 91""")
add("I09_continuous_days", "location_name, date d, prev_date d, day_gap i", f"select * from ({GAPS}) where day_gap > 1")
add("I10_consistent_lag", "location_name, date d, temp_lag_1d f, actual_yesterday_temp f, difference f",
    f"select * from ({RELAG.format('(select * replace (if(day(date) = 5, temp_lag_1d + 0.5e0, temp_lag_1d) as temp_lag_1d) from features)')}) where difference > 0.1")
add("I11_all_present", "location_name", "select 'n' || n_nationkey as location_name from nation where n_nationkey not in (select if(s_nationkey % 5 = 0, s_nationkey + 1, s_nationkey) from supplier)")
add("I12_one_row_per_day", "location_name, date d, record_count i", "select location_name, date, count(*) as record_count from staged group by all having count(*) > 1")
add("I13_no_future_dates", "location_name, date d, record_count i", "select location_name, date, count(*) as record_count from daily where date > date '2024-01-20' group by all")
add("I14_non_negative_totals", "location_name, date d, total_precipitation f",
    f"select location_name, date, {rnd('sum(p)', 2)} as total_precipitation from (select *, if(day(date) % 5 = 0, -precipitation, precipitation) as p from staged) group by all having sum(p) < 0")
add("I15_plausible_rolling_means", "location_name, date d, avg_temperature f, temp_rolling_7d_prev f, temp_rolling_30d_prev f",
    "from features where abs(avg_temperature - temp_rolling_7d_prev) > 1.5 or abs(avg_temperature - temp_rolling_30d_prev) > 2.0")
add("I16_ordered_temperatures", "location_name, date d, min_temperature f, avg_temperature f, max_temperature f",
    "select * replace (max_temperature + 1 as avg_temperature) from daily where day(date) % 7 = 0")
add("I17_batch_shape", "missing_columns, records i, expected i, is_complete i",
    "select 'pressure' as missing_columns, count(*) as records, 3600 as expected, count(*) >= 3600 as is_complete from readings")

SITES_DIM = "(select row_number() over (order by location_name) as location_id, location_name from (select distinct location_name from readings))"
DATES_DIM = "(select row_number() over (order by date) as date_id, date from (select distinct date from daily))"
DECLARED = {
    "raw": ("readings", ["record_id"], ["record_id", "datetime", "location_name", "temperature"]),
    "staged": ("staged", ["record_id"], ["record_id", "datetime", "temperature", "pressure"]),
    "daily": ("daily", ["daily_id"], ["daily_id", "location_name", "date", "avg_temperature"]),
    "features": ("features", ["feature_id"], ["feature_id"]),
    "dim_location": (SITES_DIM, ["location_id", "location_name"], ["location_id", "location_name"]),
    "dim_date": (DATES_DIM, ["date_id", "date"], ["date_id", "date"]),
}
FOUND = {f"unique_{t}_{c}": f"select {c} from {source} where {c} is not null group by {c} having count(*) > 1" for t, (source, keys, _) in DECLARED.items() for c in keys}
FOUND |= {f"not_null_{t}_{c}": f"select 1 from {source} where {c} is null" for t, (source, _, required) in DECLARED.items() for c in required}
FOUND |= {
    "valid_temperature_staged": "select distinct temperature from staged where temperature not between -50 and 60",
    "valid_humidity_staged": "select distinct humidity from staged where humidity not between 0 and 100",
    "non_negative_staged_precipitation": "select distinct precipitation from staged where precipitation < 0",
    "non_negative_staged_wind_speed": "select distinct wind_speed from staged where wind_speed < 0",
    "enough_days": "select 1 from daily group by location_name having count(distinct date) < datediff('day', min(date), max(date)) * 0.9",
    "quality_at_least": "select 1 from checked group by location_name having avg(data_quality_score) < 80",
    "continuous_days": "select 1 from daily qualify datediff('day', lag(date) over (partition by location_name order by date), date) > 1",
    "consistent_lag": "select 1 from features qualify abs(temp_lag_1d - lag(avg_temperature) over (partition by location_name order by date)) > 0.1",
    "all_present": "select 1 from unnest(['Hanoi', 'Ho Chi Minh City', 'Da Nang', 'Can Tho', 'Hai Phong']) as t(v) where v not in (select location_name from daily)",
    "one_row_per_day": "select 1 from daily group by location_name, date having count(*) > 1",
    "no_future_dates": "select 1 from daily where date > date '2030-01-01'",
    "non_negative_totals": "select 1 from daily where total_precipitation < 0",
    "plausible_rolling_means": "select 1 from features where abs(avg_temperature - temp_rolling_7d_prev) > 15 or abs(avg_temperature - temp_rolling_30d_prev) > 20",
    "ordered_temperatures": "select 1 from daily where min_temperature > avg_temperature or avg_temperature > max_temperature",
}
add("I18_check_suite", "check_name, violations i, status",
    "select *, if(violations = 0, 'pass', 'fail') as status from ("
    + " union all ".join(f"select '{name}' as check_name, count(*) as violations from ({sql})" for name, sql in FOUND.items()) + ")")

# -- J
add("J01_dagostino", "variable, n i, skew f, kurt f, k2 f, p_value f",
    f"""select *, pow(d * ln(y / a + sqrt(pow(y / a, 2) + 1)), 2) + pow((1 - 2 / (9 * g) - pow((1 - 2 / g) / (1 + x * sqrt(2 / (g - 4))), 1e0 / 3)) / sqrt(2 / (9 * g)), 2) as k2, exp(-k2 / 2) as p_value
    from (select *, 1 / sqrt(0.5e0 * ln(w)) as d, sqrt(2 / (w - 1)) as a, 6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) as g from (
    select *, skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) as y,
      sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 as w,
      (kurt + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) as x,
      6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) as s from (
    select variable, cast(count(*) as double) as n, avg(pow(value - mu, 3)) / pow(avg(pow(value - mu, 2)), 1.5e0) as skew,
      avg(pow(value - mu, 4)) / pow(avg(pow(value - mu, 2)), 2) - 3 as kurt
    from (select *, avg(value) over (partition by variable) as mu from ({stack(DAILY_VARIABLES, 'ldaily')})) group by variable)))""")


def anova_sql(source: str, value: str, by: str) -> str:
    return f"""select (sb / (k - 1)) / (sw / (n - k)) as f, k - 1 as df_between, n - k as df_within from (select sum(pow(gm - m, 2)) as sb, sum(pow(v - gm, 2)) as sw,
      cast(count(*) as double) as n, cast(count(distinct g) as double) as k
      from (select {value} as v, {by} as g, avg({value}) over (partition by {by}) as gm, avg({value}) over () as m from ({source}) where {value} is not null))"""


SPREAD = "select {by}, abs({v} - median({v}) over (partition by {by})) as deviation from ldaily"
LEVENE_T = anova_sql(SPREAD.format(by="season", v="avg_temperature"), "deviation", "season")
add("J04_levene", "w f, df_between f, df_within f, p_value f", f"select *, {p_t('sqrt(w)', 'df_within')} as p_value from (select f as w, df_between, df_within from ({LEVENE_T}))")
LEVENE_W = anova_sql(SPREAD.format(by="season", v="avg_wind_speed"), "deviation", "season")
TWO = """select count({v}) filter (season = 'Dry Season') as n1, count({v}) filter (season = 'Rainy Season') as n2,
  avg({v}) filter (season = 'Dry Season') as m1, avg({v}) filter (season = 'Rainy Season') as m2,
  var_samp({v}) filter (season = 'Dry Season') as v1, var_samp({v}) filter (season = 'Rainy Season') as v2 from ldaily"""
add("J05_t_test", "t f, df f, levene_p f, equal_variances, p_value f",
    f"""select *, {p_t('t', 'df')} as p_value from (select levene_p, if(levene_p > 0.05, 'Yes', 'No') as equal_variances,
    (m1 - m2) / if(levene_p > 0.05, sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1e0 / n1 + 1e0 / n2)), sqrt(v1 / n1 + v2 / n2)) as t,
    if(levene_p > 0.05, n1 + n2 - 2, pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1))) as df
    from ({TWO.format(v='avg_wind_speed')}), (select {p_t('sqrt(f)', 'df_within')} as levene_p from ({LEVENE_W})))""")
RANKED = "select {by} as g, rank() over (order by {v}) + (count(*) over (partition by {v}) - 1) / 2e0 as r from ldaily where {v} is not null"
TIES = "(select sum(cast(t * t * t - t as double)) as ties, cast(sum(t) as double) as n from (select cast(count(*) as double) as t from ldaily where {v} is not null group by {v}))"
add("J06_mann_whitney", "u f, z f, p_value f",
    f"""select u, z, {p_normal('z')} as p_value from (select u, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5e0) / sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))) as z
    from (select rs - n1 * (n1 + 1) / 2 as u, n1, n2 from (select sum(r) filter (g = 'Dry Season') as rs, cast(count(*) filter (g = 'Dry Season') as double) as n1,
    cast(count(*) filter (g = 'Rainy Season') as double) as n2 from ({RANKED.format(by='season', v='avg_wind_speed')}))), {TIES.format(v='avg_wind_speed')})""")
add("J07_cohens_d", "d f, effect",
    f"""select d, if(abs(d) < 0.2, 'Small', if(abs(d) < 0.5, 'Medium', 'Large')) as effect from
    (select (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) as d from ({TWO.format(v='avg_temperature')}))""")
add("J08_anova", "f f, df_between f, df_within f, p_value f",
    f"select *, pow(1 + 2 * f / df_within, -df_within / 2) as p_value from ({anova_sql('from ldaily', 'avg_temperature', 'location_name')})")
add("J09_kruskal", "h f, df f, p_value f",
    f"""select h, 2 as df, exp(-h / 2) as p_value from (select (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) as h
    from (select sum(rs * rs / c) as s from (select g, sum(r) as rs, count(*) as c from ({RANKED.format(by='location_name', v='avg_temperature')}) group by g)), {TIES.format(v='avg_temperature')})""")
QQ = f"""select i as position, {normal_quantile('pos')} as theoretical, v as ordered from (select *, case when i = n then pow(0.5e0, 1e0 / n)
  when i = 1 then 1 - pow(0.5e0, 1e0 / n) else (i - 0.3175e0) / (n + 0.365e0) end as pos from (select avg_temperature as v,
  row_number() over (order by avg_temperature, location_name, date) as i, count(*) over () as n from ldaily where avg_temperature is not null))"""
add("J03_qq_points", "position i, theoretical f, ordered f", QQ)
add("J03_qq_line", "n i, slope f, intercept f, r f",
    f"select count(*) as n, regr_slope(ordered, theoretical) as slope, regr_intercept(ordered, theoretical) as intercept, corr(ordered, theoretical) as r from ({QQ})")
LAST, SECOND = "0e0 0.221157e0 -0.147981e0 -2.071190e0 4.434685e0 -2.706056e0", "0e0 0.042981e0 -0.293762e0 -1.752461e0 5.682633e0 -3.582633e0"
Z = f"((ln(greatest(1 - w, 1e-300)) - ({poly('-1.5861e0 -0.31082e0 -0.083751e0 0.0038915e0', 'ln(n)')})) / exp({poly('-0.4803e0 -0.082676e0 0.0030302e0', 'ln(n)')}))"
add("J02_shapiro", "variable, n i, w f, p_value f",
    f"""select variable, n, w, if(z >= 0, {p_normal('z')} / 2, 1 - {p_normal('z')} / 2) as p_value from (select *, {Z} as z from (
    select variable, n, least(1, pow(sum(value * case when i = n then l when i = 1 then -l when i = n - 1 then s when i = 2 then -s else m / sqrt(phi) end), 2) / any_value(ss)) as w
    from (select *, (mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * l * l - 2 * s * s) as phi from (
      select *, m1 / sqrt(mm) + {poly(LAST, '(1 / sqrt(n))')} as l, m2 / sqrt(mm) + {poly(SECOND, '(1 / sqrt(n))')} as s from (
        select *, sum(m * m) over v as mm, max(m) over v as m1, max(m) filter (i = n - 1) over v as m2, var_pop(value) over v * n as ss from (
          select *, {normal_quantile('((i - 0.375e0) / (n + 0.25e0))')} as m from (
            select variable, value, row_number() over (partition by variable order by value) as i, count(*) over (partition by variable) as n
            from ({stack(DAILY_VARIABLES, 'ldaily')}))) window v as (partition by variable)))) group by variable, n))""")
add("J10_tukey_differences", "group1, group2, mean_diff f",
    """select a.g as group1, b.g as group2, b.m - a.m as mean_diff from (select location_name as g, avg(avg_temperature) as m from ldaily group by all) a
       join (select location_name as g, avg(avg_temperature) as m from ldaily group by all) b on a.g < b.g""")
add("J11_proportion_test", "x1 i, n1 i, x2 i, n2 i, z f, p_value f",
    f"""select *, {p_normal('z')} as p_value from (select *, (x1 / n1 - x2 / n2) / sqrt((x1 + x2) / (n1 + n2) * (1 - (x1 + x2) / (n1 + n2)) * (1 / n1 + 1 / n2)) as z from
    (select count(*) filter (season = 'Dry Season' and total_precipitation > 0)::double as x1, count(*) filter (season = 'Dry Season')::double as n1,
    count(*) filter (season = 'Rainy Season' and total_precipitation > 0)::double as x2, count(*) filter (season = 'Rainy Season')::double as n2 from ldaily))""")
add("J12_pearson", "variable_1, variable_2, n i, r f, p_value f, significant, strength",
    f"""select *, {p_t('t', '(n - 2)')} as p_value, if({p_t('t', '(n - 2)')} < 0.05, 'Yes', 'No') as significant,
    if(abs(r) < 0.3, 'Weak', if(abs(r) < 0.7, 'Moderate', 'Strong')) as strength from (select *, r * sqrt((n - 2) / (1 - r * r)) as t from ("""
    + " union all ".join(f"select '{x}' as variable_1, '{y}' as variable_2, cast(regr_count({x}, {y}) as double) as n, corr({x}, {y}) as r from ldaily" for x, y in PAIRS) + "))")
add("J13_spearman", "variable_1, variable_2, n i, rho f, p_value f",
    f"select *, {p_t('rho * sqrt((n - 2) / (1 - rho * rho))', '(n - 2)')} as p_value from ("
    + " union all ".join(
        f"""select '{x}' as variable_1, '{y}' as variable_2, count(*) as n, corr(rx, ry) as rho from (select rank() over (order by {x}) + (count(*) over (partition by {x}) - 1) / 2e0 as rx,
        rank() over (order by {y}) + (count(*) over (partition by {y}) - 1) / 2e0 as ry from ldaily where {x} is not null and {y} is not null)""" for x, y in PAIRS) + ")")


def kendall_sql(x: str, y: str) -> str:
    ties = lambda c: f"(select sum(t * (t - 1) / 2) as a, sum(t * (t - 1) * (t - 2)) as b, sum(t * (t - 1) * (2 * t + 5)) as c from (select cast(count(*) as double) as t from ldaily group by {c}))"
    return f"""select '{x}' as variable_1, '{y}' as variable_2, n, s / sqrt((n * (n - 1) / 2 - tx.a) * (n * (n - 1) / 2 - ty.a)) as tau,
      s / sqrt((n * (n - 1) * (2 * n + 5) - tx.c - ty.c) / 18 + 2 * tx.a * ty.a / (n * (n - 1)) + tx.b * ty.b / (9 * n * (n - 1) * (n - 2))) as z
      from (select cast(sum(sign(p.{x} - q.{x}) * sign(p.{y} - q.{y})) as double) / 2 as s from ldaily p, ldaily q),
      (select cast(count(*) as double) as n from ldaily), {ties(x)} tx, {ties(y)} ty"""


add("J14_kendall", "variable_1, variable_2, n i, tau f, z f, p_value f", f"select *, {p_normal('z')} as p_value from (" + " union all ".join(kendall_sql(x, y) for x, y in PAIRS) + ")")
Z = 1.959963984540054
T_SERIES = f"({Z} + {(Z**3 + Z) / 4!r} / v + {(5 * Z**5 + 16 * Z**3 + 3 * Z) / 96!r} / (v * v) + {(3 * Z**7 + 19 * Z**5 + 17 * Z**3 - 15 * Z) / 384!r} / (v * v * v))"
add("J15_confidence_intervals", "location_name, variable, n i, mean f, lower f, upper f",
    f"""select *, mean - margin as lower, mean + margin as upper from (select *, sd / sqrt(n) * {T_SERIES} as margin from (select location_name, variable, count(*) as n, cast(count(*) - 1 as double) as v,
    avg(value) as mean, stddev_samp(value) as sd from ({stack(('avg_temperature', 'total_precipitation', 'avg_humidity'), 'ldaily', 'location_name')}) group by all))""")
CELLS = f"""select is_hot, is_very_humid, count(*)::double as o, (sum(count(*)) over (partition by is_hot))::double * (sum(count(*)) over (partition by is_very_humid))::double
  / (sum(count(*)) over ())::double as e from ({HOT}) group by is_hot, is_very_humid"""
add("J16_chi_square", "chi2 f, dof i, p_value f",
    f"select chi2, 1 as dof, {p_normal('sqrt(chi2)')} as p_value from (select sum(pow(abs(o - e) - least(0.5e0, abs(o - e)), 2) / e) as chi2 from ({CELLS}))")
add("J16_expected_counts", "is_hot i, is_very_humid i, observed i, expected f", f"select *, o as observed, e as expected from ({CELLS})")
add("J17_labels", "variable_1, variable_2, strength, effect",
    f"""select *, if(abs(correlation) < 0.3, 'Weak', if(abs(correlation) < 0.7, 'Moderate', 'Strong')) as strength,
    if(abs(correlation) < 0.2, 'Small', if(abs(correlation) < 0.5, 'Medium', 'Large')) as effect from ({corr_sql(CORRELATED, 'ldaily')})""")
add("J18_group_descriptions", "season, n i, mean f, median f, sd f, mean_minus_sd f, mean_plus_sd f",
    """select season, count(*) as n, avg(total_precipitation) as mean, median(total_precipitation) as median, stddev_samp(total_precipitation) as sd,
       mean - sd as mean_minus_sd, mean + sd as mean_plus_sd from ldaily group by season""")

# -- K
add("K01_target_summary", "n i, mean f, std f, min f, max f",
    "select count(avg_temperature) as n, avg(avg_temperature) as mean, stddev_samp(avg_temperature) as std, min(avg_temperature) as min, max(avg_temperature) as max from lfeatures")
add("K02_mean_imputation", "location_name, date d, label f, temp_lag_14d f, temp_rolling_std_7d_prev f",
    """select location_name, date, avg_temperature as label, coalesce(temp_lag_14d, avg(temp_lag_14d) over ()) as temp_lag_14d,
       coalesce(temp_rolling_std_7d_prev, avg(temp_rolling_std_7d_prev) over ()) as temp_rolling_std_7d_prev from lfeatures""")
add("K03_time_split", "split, records i, first_date d, last_date d, pct f",
    "select split, count(*) as records, min(date) as first_date, max(date) as last_date, count(*) * 100e0 / (select count(*) from parted) as pct from parted group by split")
add("K04_standardise", "location_name, date d, label f, temp_lag_1d f, precip_lag_1d f, split",
    """select location_name, date, avg_temperature as label, (temp_lag_1d - a) / b as temp_lag_1d, (precip_lag_1d - c) / d as precip_lag_1d, split
       from parted, (select avg(temp_lag_1d) as a, stddev_pop(temp_lag_1d) as b, avg(precip_lag_1d) as c, stddev_pop(precip_lag_1d) as d from parted where split = 'train')""")
TEST = "(select *, avg(avg_temperature) filter (split = 'train') over () as base from parted)"
add("K05_mean_baseline", METRICS, metric_sql(f"(select * from {TEST} where split = 'test')", "base"))
add("K06_last_value_baseline", METRICS, metric_sql("(select * from parted where split = 'test')", "temp_lag_1d"))
add("K07_single_input_line", "location_name, date d, label f, prediction f",
    """select location_name, date, avg_temperature as label, i + s * temp_rolling_7d_prev as prediction from parted,
       (select regr_slope(avg_temperature, temp_rolling_7d_prev) as s, regr_intercept(avg_temperature, temp_rolling_7d_prev) as i from parted where split = 'train') where split = 'test'""")
for key, weights in (
    ("K07_least_squares", models.ridge(0.0, 1e-12)), ("K08_ridge", models.ridge(1.0)), ("K09_lasso", models.descent(0.1, 0.0)), ("K10_elastic_net", models.descent(0.05, 0.05)),
):
    add(key, METRICS, metric_sql(f"({models.PREDICTED})", "prediction"), **models.moments(), **weights)
add("K18_linear_folds", "fold i, rmse f", models.FOLD_ERRORS, **models.fold_moments(), **models.ridge(0.0, 1e-12, "t,"))
add("K14_metrics_by_site", f"location_name, {METRICS}", metric_sql("lfeatures", "temp_lag_1d", "location_name"))
add("F06_best_baseline", "model",
    f"""select arg_min(model, rmse) as model from (select 'Mean Baseline' as model, rmse from ({metric_sql(f"(select * from {TEST} where split = 'test')", 'base')})
    union all select 'Last Value Baseline', rmse from ({metric_sql("(select * from parted where split = 'test')", 'temp_lag_1d')}))""")
RESIDUALS = "select date, location_name as location, avg_temperature as actual_temperature, temp_lag_1d as predicted_temperature, avg_temperature - temp_lag_1d as residual, abs(avg_temperature - temp_lag_1d) as absolute_error from parted where split = 'test'"
add("K17_residuals", "date d, location, actual_temperature f, predicted_temperature f, residual f, absolute_error f", RESIDUALS)
add("K17_residual_summary", "mean f, std f, min f, max f", f"select avg(residual) as mean, stddev_samp(residual) as std, min(residual) as min, max(residual) as max from ({RESIDUALS})")
add("K18_time_blocks", "fold i, records i, first_date d, last_date d",
    """select fold, sum(c) as records, min(date) as first_date, max(date) as last_date from (select date, c, least(5, floor((sum(c) over (order by date) - c) * 6 / sum(c) over ())) as fold
       from (select date, count(*) as c from lfeatures group by date)) group by fold""")

# -- L
add("L01_distinct_stream", "location_name, records i, ids i", "select location_name, count(*) as records, sum(event_id) as ids from readings group by all")
STREAMED = GATED
add("L02_daily_stream", "date d, location_name, total_hourly_records i, " + ", ".join(f"sum_{m} f, min_{m} f, max_{m} f, avg_{m} f" for m in STREAMED),
    "select date, location_name, count(*) as total_hourly_records, " + ", ".join(f"sum({m}) as sum_{m}, min({m}) as min_{m}, max({m}) as max_{m}, avg({m}) as avg_{m}" for m in STREAMED)
    + " from staged group by all")
add("L03_upsert_stream", "date d, location_name, total_hourly_records i, strongest_wind f",
    "select cast(datetime as date) as date, location_name, count(*) as total_hourly_records, max(wind_speed + if(datetime >= timestamp '2024-01-10', 1e0, 0e0)) as strongest_wind from readings group by all")
