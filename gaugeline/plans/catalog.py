"""Every operator as a query over the shared test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions import calendar as cal
from gaugeline.functions import keys, labels
from gaugeline.operators import checks as ck
from gaugeline.operators import daily as dy
from gaugeline.operators import decompose, dimensions
from gaugeline.operators import features as ft
from gaugeline.operators import inference as inf
from gaugeline.operators import profile as pf
from gaugeline.operators import quantiles as qt
from gaugeline.operators import ranks
from gaugeline.operators import regression as rg
from gaugeline.operators import staging as st
from gaugeline.operators.frames import beside
from gaugeline.plans import fixtures as fx
from gaugeline.plans.portable import portable
from gaugeline.schema import (
    MEASURES,
    PERFORMANCE_KEY,
    PREDICTION_KEY,
    RAW_READINGS,
)
from gaugeline.session import written
from gaugeline.sources import readers, seeds, tables
from gaugeline.streaming import flows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT_SITES = ("click", "error", "purchase", "signup", "view")
CITIES = tuple(fx.FLAG_SITES.values())
SEASONS = ("Dry Season", "Rainy Season")
DAILY_VARIABLES = ("avg_temperature", "total_precipitation", "avg_humidity", "avg_pressure", "avg_wind_speed")
# The daily columns correlated with each other, and the pairs that are tested.
CORRELATED = (
    "avg_temperature", "max_temperature", "min_temperature", "total_precipitation", "avg_humidity", "avg_pressure",
    "avg_wind_speed", "max_wind_speed", "avg_cloud_cover", "avg_temp_humidity_index", "avg_wind_chill_index",
)
HOURLY_CORRELATED = ("temperature", "humidity", "precipitation", "pressure", "wind_speed", "cloud_cover")
TESTED_PAIRS = (
    ("avg_temperature", "avg_humidity"),
    ("avg_temperature", "total_precipitation"),
    ("avg_temperature", "avg_pressure"),
    ("avg_humidity", "total_precipitation"),
    ("avg_wind_speed", "total_precipitation"),
)


def query(name: str, digits: int = 6):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir), digits)
        return fn

    return register


def mart(spark, sf, *columns: str) -> DataFrame:
    """The long daily mart as a written table, for queries that read it more than once."""
    daily = fx.long_daily(spark, sf)
    return written(daily.select(*columns) if columns else daily, "daily")


def feature_mart(spark, sf, *columns: str) -> DataFrame:
    features = fx.long_features(spark, sf)
    return written(features.select("location_name", "date", "avg_temperature", *columns) if columns else features, "features")


# -- A: sources and sinks ----------------------------------------------------------------------

SENSOR_TEXT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
])


@query("A01_csv_reader")
def _(spark, sf):
    path = tables.scratch(spark, "csv")
    tokens = F.array(*[F.lit(t) for t in ("NULL", "null", "", "N/A", " NA ")])
    token = F.element_at(tokens, (F.col("event_id") % 5 + 1).cast("int"))
    text = F.coalesce(F.concat(F.lit(" "), F.col("temperature").cast("string"), F.lit(" ")), token)
    fx.readings(spark, sf).select("event_id", "location_name", text.alias("temperature")).write.csv(path, header=True)
    return readers.read_csv(spark, path, SENSOR_TEXT)


@query("A02_json_reader")
def _(spark, sf):
    path = tables.scratch(spark, "json")
    row = F.struct("event_id", "location_name", "temperature")
    doubled = F.struct("event_id", "location_name", (F.col("temperature") * 2).alias("temperature"))
    lines = fx.readings(spark, sf).select(F.to_json(F.array(row, doubled)).alias("value"))
    lines.write.text(path)
    return readers.read_json(spark, path, SENSOR_TEXT)


@query("A03_unpack_payload")
def _(spark, sf):
    vector = F.col("embedding").cast("array<double>")
    start = F.lit(1704067200).cast("long") + F.col("vec_id") * 86400
    payload = fx.table(spark, sf, "embeddings").select(
        "vec_id", vector.alias("v"), start.alias("start"),
        (start + F.size("embedding") * 3600).alias("end"), F.lit(3600).cast("long").alias("interval"),
    )
    rows = readers.unpack_payload(
        payload, {"temperature": F.col("v"), "humidity": F.slice(F.col("v"), F.lit(2), F.size("v"))}, keep=["vec_id"]
    )
    return rows.select("vec_id", F.unix_seconds("datetime").alias("epoch"), "temperature", "humidity")


@query("A04_tag_sites")
def _(spark, sf):
    raw = fx.readings(spark, sf)
    extracts = {s: raw.filter(F.col("location_name") == s).select("event_id", "wind_speed") for s in EVENT_SITES}
    return readers.tag_sites(extracts)


@query("A05_prepare_batch")
def _(spark, sf):
    batch = readers.prepare_batch(fx.readings(spark, sf).drop("record_id", "extract_date"), "2024-02-01")
    return batch.select(*[c for c in RAW_READINGS.names if c != "datetime"])


@query("A06_incremental_append")
def _(spark, sf):
    path = tables.scratch(spark, "raw")
    raw = fx.readings(spark, sf)
    tables.append_new(raw.filter("datetime < '2024-01-16'"), path)
    tables.append_new(raw.filter("datetime >= '2024-01-10'"), path)  # six days are sent again
    stored = spark.read.parquet(path)
    return stored.groupBy("date", "location_name").agg(F.count(F.lit(1)).alias("records"), F.sum("event_id").alias("ids"))


@query("A06_new_rows")
def _(spark, sf):
    raw = fx.readings(spark, sf).withColumn("date", F.to_date("datetime"))
    return tables.new_rows(
        raw.filter("datetime >= '2024-01-10'"), raw.filter("datetime < '2024-01-16 12:00:00'")
    ).select("event_id", "date")


@query("A07_full_replace")
def _(spark, sf):
    path = tables.scratch(spark, "replaced")
    raw = fx.readings(spark, sf).select("event_id", "location_name", "wind_speed")
    tables.save_table(raw, path)
    tables.replace_table(spark.read.parquet(path).filter("wind_speed > 10"), path)
    return spark.read.parquet(path)


@query("A08_table_modes")
def _(spark, sf):
    path = tables.scratch(spark, "modes")
    raw = fx.readings(spark, sf).select("event_id", "location_name")
    tables.save_table(raw, path, "fail")
    tables.save_table(raw, path, "append")
    return spark.read.parquet(path).groupBy("location_name").agg(F.count(F.lit(1)).alias("records"))


@query("A09_result_csv")
def _(spark, sf):
    path = tables.scratch(spark, "result")
    result = pf.grouped(fx.readings(spark, sf), ["location_name"], {"wind_speed": ("count", "min", "max")})
    tables.save_result(result, path)
    schema = "location_name string, wind_speed_count bigint, wind_speed_min double, wind_speed_max double"
    return spark.read.schema(schema).csv(path, header=True)


@query("A10_seed_loader")
def _(spark, sf):
    months = fx.shipments(spark, sf).groupBy(F.month("datetime").alias("month")).agg(F.count(F.lit(1)).alias("records"))
    return months.join(F.broadcast(seeds.season_mappings(spark)), "month")


@query("A11_sql_query")
def _(spark, sf):
    return tables.query(
        spark,
        """SELECT location_name, count(*) AS days, max(max_wind_speed) AS strongest_wind
           FROM {fct_daily} WHERE hours_with_rain > 0 GROUP BY location_name""",
        fct_daily=fx.daily(spark, sf),
    )


@query("A12_filtered_scan")
def _(spark, sf):
    recent = fx.long_daily(spark, sf).filter(F.col("date") >= F.lit("1998-01-01").cast("date"))
    return recent.select("location_name", "date", "avg_temperature").orderBy("location_name", "date")


def _predictions(spark, sf, version: str):
    """Tomorrow is like today: the last-value forecast as stored predictions."""
    return fx.long_features(spark, sf).select(
        keys.surrogate_key("location_name", "date").alias("prediction_id"),
        "location_name",
        F.date_sub("date", 1).alias("prediction_date"),
        F.col("date").alias("forecast_date"),
        F.lit(1).alias("days_ahead"),
        F.col("temp_lag_1d").alias("predicted_temperature"),
        F.col("precip_lag_1d").alias("predicted_precipitation"),
        F.col("humidity_lag_1d").alias("predicted_humidity"),
        *[F.lit(None).cast("double").alias(c) for c in ("actual_temperature", "actual_precipitation", "actual_humidity")],
        F.lit("last_value").alias("model_name"),
        F.lit(version).alias("model_version"),
        *[F.lit(None).cast("double").alias(c) for c in ("temperature_error", "precipitation_error", "absolute_error")],
    )


@query("A13_prediction_store")
def _(spark, sf):
    path = tables.scratch(spark, "predictions")
    monthly = _predictions(spark, sf, "1").withColumn("forecast_month", F.trunc("forecast_date", "month"))
    rows = written(monthly, "forecasts")
    tables.upsert(rows.filter("forecast_date < '2000-01-01'"), path, PREDICTION_KEY, ["model_version"], "forecast_month")
    again = rows.filter("forecast_date >= '1999-01-01'").withColumn("model_version", F.lit("2"))
    stored = tables.upsert(again, path, PREDICTION_KEY, ["model_version"], "forecast_month")
    return stored.select("location_name", "forecast_date", "model_version", "predicted_temperature")


@query("A14_performance_store")
def _(spark, sf):
    path = tables.scratch(spark, "performance")
    frame = rg.last_value_baseline(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",)))
    by_year = rg.metrics(frame.withColumn("year", F.year("date")), ["year"]).select(
        F.lit("last_value").alias("model_name"), F.col("year").cast("string").alias("model_version"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("evaluation_date"), "rmse", "mae", F.col("r2").alias("r_squared"),
        "mape", "mse", F.col("median_ae").alias("median_absolute_error"), "max_error", F.col("n").alias("test_records"),
    )
    first = written(by_year, "scores")
    # The first evaluation is stored with a wrong error; the second, of equal size, must win.
    tables.upsert(first.withColumn("rmse", F.col("rmse") + 1), path, PERFORMANCE_KEY, ["test_records"], "evaluation_date")
    return tables.upsert(first, path, PERFORMANCE_KEY, ["test_records"], "evaluation_date")


# -- B: projections and filters ----------------------------------------------------------------


@query("B01_require_keys")
def _(spark, sf):
    raw = fx.readings(spark, sf).withColumns(
        {
            "location_name": F.when(F.col("event_id") % 211 != 0, F.col("location_name")),
            "datetime": F.when(F.col("event_id") % 307 != 0, F.col("datetime")),
        }
    )
    return st.require_keys(raw).select("event_id", "location_name")


@query("B02_calendar_parts")
def _(spark, sf):
    parts = ("date", "hour", "day", "month", "year", "day_of_week", "week_of_year", "quarter")
    return st.calendar_parts(fx.shipments(spark, sf)).select(
        *parts, cal.weekday_from_monday("date").alias("weekday_from_monday")
    ).groupBy(*parts, "weekday_from_monday").agg(F.count(F.lit(1)).alias("n"))


@query("B03_missing_flags")
def _(spark, sf):
    return st.missing_flags(fx.readings(spark, sf)).select(
        "event_id", "has_missing_temperature", "has_missing_humidity", "has_missing_precipitation"
    )


@query("B04_outlier_flags")
def _(spark, sf):
    return st.outlier_flags(fx.readings(spark, sf)).select("event_id", *[g.flag for g in st.GATES])


@query("B05_clean_outliers")
def _(spark, sf):
    cleaned = st.clean_outliers(st.outlier_flags(fx.readings(spark, sf)))
    return cleaned.select("event_id", *[g.measure for g in st.GATES])


@query("B06_quality_score")
def _(spark, sf):
    scored = st.quality_score(st.outlier_flags(fx.readings(spark, sf)))
    return st.keep_reliable(scored).select("event_id", "data_quality_score")


@query("B07_season")
def _(spark, sf):
    return fx.shipments(spark, sf).groupBy(F.month("datetime").alias("month"), cal.season(F.month("datetime")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


@query("B08_time_of_day")
def _(spark, sf):
    hour = F.hour("datetime")
    return fx.readings(spark, sf).select("event_id", hour.alias("hour"), cal.time_of_day(hour).alias("time_of_day"))


@query("B09_day_and_month_names")
def _(spark, sf):
    dow = cal.day_of_week("datetime")
    return fx.shipments(spark, sf).groupBy(
        F.to_date("datetime").alias("date"), cal.day_name(dow).alias("day_name"), cal.month_name(F.month("datetime")).alias("month_name")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("B10_condition_flags")
def _(spark, sf):
    flags = ("is_raining", "is_hot", "is_cold", "is_humid", "is_windy", "is_cloudy")
    return st.condition_flags(fx.readings(spark, sf)).select("event_id", *flags)


@query("B11_weekend_flag")
def _(spark, sf):
    return fx.readings(spark, sf).select("event_id", cal.weekend_flag(cal.day_of_week("datetime")).alias("is_weekend"))


@query("B12_comfort_indices")
def _(spark, sf):
    return st.comfort_indices(fx.readings(spark, sf)).select("event_id", "temp_humidity_index", "wind_chill_index")


@query("B13_precipitation_intensity")
def _(spark, sf):
    return st.precipitation_intensity(fx.readings(spark, sf)).select("event_id", "precipitation_intensity")


@query("B14_rain_classes")
def _(spark, sf):
    return pf.value_counts(fx.long_daily(spark, sf).select(pf.rain_class().alias("rain_class")), "rain_class")


@query("B15_no_future")
def _(spark, sf):
    return dy.until(fx.staged(spark, sf), "2024-01-15").select("event_id", "date")


@query("B16_history_required")
def _(spark, sf):
    lagged = ft.lag_features(fx.daily(spark, sf), lags=(("temp", "avg_temperature", (1,)),))
    return lagged.filter(F.col("temp_lag_1d").isNotNull()).select("location_name", "date", "temp_lag_1d")


@query("B17_numeric_coercion")
def _(spark, sf):
    text = F.when(F.col("event_id") % 13 == 0, F.lit("n/a?")).otherwise(F.col("value").cast("string"))
    return pf.numeric(fx.table(spark, sf, "events").select("event_id", text.alias("reading")), ["reading"])


@query("B18_quarter_label")
def _(spark, sf):
    return pf.value_counts(fx.long_daily(spark, sf).select(cal.quarter_label("month").alias("month_group")), "month_group")


HOT_HUMID = {("avg_temperature", 0.75): "is_hot", ("avg_humidity", 0.75): "is_very_humid"}


@query("B19_above_quantile")
def _(spark, sf):
    return pf.above_quantile(mart(spark, sf, "location_name", "date", "avg_temperature", "avg_humidity"), HOT_HUMID).select("location_name", "date", "is_hot", "is_very_humid")


@query("B20_threshold_table")
def _(spark, sf):
    return pf.outside_thresholds(fx.readings(spark, sf), seeds.weather_thresholds(spark), ["event_id"])


@query("B21_model_columns")
def _(spark, sf):
    return rg.model_frame(fx.long_features(spark, sf))


@query("B22_entity_slice")
def _(spark, sf):
    return fx.long_daily(spark, sf).filter(F.col("location_name") == "Hanoi").select("date", "avg_temperature", "season")


# -- C: joins ----------------------------------------------------------------------------------


@query("C01_missing_sites")
def _(spark, sf):
    return ck.all_present(seeds.location_metadata(spark), fx.long_daily(spark, sf))


@query("C02_keys_not_in_set")
def _(spark, sf):
    orders, items = fx.table(spark, sf, "orders"), fx.table(spark, sf, "lineitem")
    batch = orders.select(F.col("o_orderkey").alias("key"))
    return tables.new_rows(batch, items.select(F.col("l_orderkey").alias("key")), ["key"], day=None)


@query("C03_star_join")
def _(spark, sf):
    daily = mart(spark, sf)
    sites = dimensions.location_dimension(fx.shipments(spark, sf)).select("location_id", "location_name", "region")
    dates = dimensions.date_dimension(dimensions.spine_of(daily)).select("date_id", "date", F.col("day_name").alias("weekday"))
    joined = dimensions.join_dimension(dimensions.join_dimension(daily, sites, "location_name", "inner"), dates, "date", "inner")
    return joined.select("location_id", "date_id", "region", "weekday", "avg_temperature")


@query("C04_season_attributes")
def _(spark, sf):
    attributes = seeds.season_mappings(spark).select("month", "season_type", "rainfall_level")
    joined = fx.long_daily(spark, sf).join(F.broadcast(attributes), "month")
    return joined.groupBy("season_type", "rainfall_level").agg(
        F.count(F.lit(1)).alias("days"), F.avg("avg_temperature").alias("avg_temperature")
    )


@query("C05_site_attributes")
def _(spark, sf):
    metadata = seeds.location_metadata(spark).select("location_name", "population", "elevation_meters", "climate_zone")
    sites = pf.grouped(fx.long_daily(spark, sf), ["location_name"], {"avg_temperature": ("mean",)})
    return sites.join(F.broadcast(metadata), "location_name", "left")


@query("C06_global_threshold")
def _(spark, sf):
    daily = mart(spark, sf, "location_name", "date", "max_temperature")
    bound = qt.thresholds(daily, {("max_temperature", 0.95): "temp_high"})
    return beside(daily, bound).filter("max_temperature >= temp_high").select("location_name", "date", "max_temperature", "temp_high")


@query("C07_complete_pairs")
def _(spark, sf):
    return fx.readings(spark, sf).dropna(subset=["temperature", "humidity"]).select("event_id", "temperature", "humidity")


@query("C08_verify_forecasts")
def _(spark, sf):
    verified = rg.verify_forecasts(_predictions(spark, sf, "1"), fx.long_daily(spark, sf))
    return verified.select(
        "location_name", "forecast_date", "predicted_temperature", "actual_temperature", "actual_precipitation",
        "actual_humidity", "temperature_error", "precipitation_error", "absolute_error",
    )


# -- D: aggregates -----------------------------------------------------------------------------


@query("D01_daily_rollup")
def _(spark, sf):
    return fx.daily(spark, sf)


@query("D01_daily_rollup_long")
def _(spark, sf):
    return fx.long_daily(spark, sf)


@query("D01e_circular_wind")
def _(spark, sf):
    rolled = dy.daily_rollup(fx.enriched(spark, sf), as_of=fx.AS_OF, circular_wind=True)
    return rolled.select("location_name", "date", "dominant_wind_direction", "circular_wind_direction")


@query("D02_surrogate_key")
def _(spark, sf):
    named = fx.readings(spark, sf).withColumn("site", F.when(F.col("event_id") % 7 != 0, F.col("location_name")))
    return named.select("event_id", keys.surrogate_key("site", "extract_date").alias("key"))


@query("D03_site_statistics", digits=2)
def _(spark, sf):
    wanted = {
        "temperature": ("count", "mean", "std", "min", "max"), "precipitation": ("sum", "mean"),
        "humidity": ("mean",), "wind_speed": ("mean",),
    }
    return pf.grouped(fx.readings(spark, sf), ["location_name"], wanted)


@query("D04_value_counts")
def _(spark, sf):
    rows = st.calendar_parts(fx.shipments(spark, sf))
    return pf.value_counts_of(rows, ["location_name", "hour", "day_of_week", "month", "year"])


@query("D05_load_summary")
def _(spark, sf):
    summary = pf.load_summary(fx.readings(spark, sf))
    return summary.select("total_records", "locations", "unique_days", "unique_hours", "span_days")


@query("D05_load_by_site")
def _(spark, sf):
    return pf.load_by_site(fx.readings(spark, sf))


@query("D06_extract_profile")
def _(spark, sf):
    return pf.extract_profile(fx.staged(spark, sf), len(EVENT_SITES))


@query("D06_null_shares")
def _(spark, sf):
    return pf.null_shares(fx.readings(spark, sf), list(MEASURES))


@query("D07_completeness")
def _(spark, sf):
    columns = ["location_name", "temperature", "humidity", "precipitation", "cloud_cover"]
    return pf.completeness(fx.readings(spark, sf), columns)


@query("D08_mean_of_daily_totals")
def _(spark, sf):
    return pf.mean_of_daily_totals(fx.staged(spark, sf))


@query("D09_describe")
def _(spark, sf):
    return pf.describe(fx.readings(spark, sf), list(MEASURES))


@query("D10_describe_categories")
def _(spark, sf):
    return pf.describe_categories(fx.table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("D11_grouped_describe")
def _(spark, sf):
    daily = mart(spark, sf, "location_name", "avg_temperature", "total_precipitation", "avg_wind_speed")
    return pf.describe(daily, ["avg_temperature", "total_precipitation", "avg_wind_speed"], ["location_name"])


SEASONAL = {
    "avg_temperature": ("mean", "std"), "total_precipitation": ("sum",), "avg_humidity": ("mean",), "avg_wind_speed": ("mean",),
}


@query("D12_season_month")
def _(spark, sf):
    return pf.grouped(fx.long_daily(spark, sf), ["season", "month"], SEASONAL)


@query("D13_season_statistics")
def _(spark, sf):
    wanted = SEASONAL | {"avg_temperature": ("mean", "std", "min", "max"), "total_precipitation": ("sum", "mean")}
    return pf.grouped(fx.long_daily(spark, sf), ["season"], wanted)


@query("D14_month_statistics")
def _(spark, sf):
    wanted = {
        "avg_temperature": ("mean",), "max_temperature": ("max",), "min_temperature": ("min",),
        "total_precipitation": ("sum",), "avg_wind_speed": ("mean",),
    }
    return pf.grouped(fx.long_daily(spark, sf), ["month"], wanted)


@query("D15_site_month_profile")
def _(spark, sf):
    return pf.grouped(fx.long_daily(spark, sf), ["location_name", "month"], {"avg_temperature": ("mean",)})


@query("D16_pivot_precipitation")
def _(spark, sf):
    return pf.pivot_sum(fx.long_daily(spark, sf), "month", "location_name", "total_precipitation", CITIES)


@query("D17_pivot_temperature")
def _(spark, sf):
    return pf.pivot_mean(fx.long_daily(spark, sf), "location_name", "month", "avg_temperature", range(1, 13))


@query("D18_rainy_days")
def _(spark, sf):
    return pf.count_where(fx.long_daily(spark, sf), F.col("total_precipitation") > 0, ["location_name"], "rainy_days")


@query("D18_windy_days")
def _(spark, sf):
    return pf.count_where(fx.long_daily(spark, sf), F.col("hours_windy") > 0, ["location_name"], "windy_days")


@query("D19_site_means")
def _(spark, sf):
    wanted = {"avg_temperature": ("mean",), "total_precipitation": ("mean",), "hours_with_rain": ("mean",)}
    return pf.grouped(fx.long_daily(spark, sf), ["location_name"], wanted).orderBy("avg_temperature_mean")


@query("D20_exact_quantiles")
def _(spark, sf):
    return qt.quantiles(fx.readings(spark, sf), ["temperature", "wind_speed"], (0.05, 0.25, 0.5, 0.75, 0.95), ["location_name"])


@query("D20_exact_quantiles_by_position")
def _(spark, sf):
    """The way taken when a column has too many distinct values for counters."""
    return qt.quantiles(fx.readings(spark, sf), ["temperature", "wind_speed"], (0.05, 0.25, 0.5, 0.75, 0.95), ["location_name"], limit=0)


@query("D21_extreme_days")
def _(spark, sf):
    return pf.extreme_days(mart(spark, sf, "location_name", *[c for c, _ in pf.EXTREMES]))


@query("D22_histogram")
def _(spark, sf):
    return pf.histogram(fx.readings(spark, sf), list(MEASURES), 50)


@query("D22_grouped_histogram")
def _(spark, sf):
    return pf.histogram(mart(spark, sf, "location_name", "avg_wind_speed"), ["avg_wind_speed"], 30, ["location_name"])


@query("D23_iqr_outliers")
def _(spark, sf):
    return pf.iqr_outliers(fx.readings(spark, sf), list(MEASURES))


@query("D24_box_summary")
def _(spark, sf):
    return pf.box_summary(mart(spark, sf, "location_name", "avg_temperature"), "location_name", "avg_temperature")


@query("D24_box_summary_by_season")
def _(spark, sf):
    return pf.box_summary(mart(spark, sf, "season", "avg_wind_speed"), "season", "avg_wind_speed")


@query("D25_correlation_matrix")
def _(spark, sf):
    return pf.correlation_matrix(fx.long_daily(spark, sf), CORRELATED)


@query("D25_hourly_correlation_matrix")
def _(spark, sf):
    return pf.correlation_matrix(fx.readings(spark, sf), HOURLY_CORRELATED)


@query("D26_strong_pairs")
def _(spark, sf):
    return pf.strong_pairs(pf.correlation_matrix(fx.long_daily(spark, sf), CORRELATED), CORRELATED, 0.6)


@query("D27_top_correlations")
def _(spark, sf):
    return pf.top_correlations(pf.correlation_matrix(fx.readings(spark, sf), HOURLY_CORRELATED), 3)


@query("D28_contingency")
def _(spark, sf):
    table = pf.contingency(pf.above_quantile(mart(spark, sf, "location_name", "date", "avg_temperature", "avg_humidity"), HOT_HUMID), "is_hot", "is_very_humid", [0, 1])
    return table.withColumnsRenamed({"0": "not_very_humid", "1": "very_humid"})


@query("D29_fitted_lines")
def _(spark, sf):
    return pf.fitted_lines(fx.long_daily(spark, sf), TESTED_PAIRS)


@query("D30_headline")
def _(spark, sf):
    return pf.headline(fx.long_daily(spark, sf))


@query("D31_kpis")
def _(spark, sf):
    return pf.kpis(mart(spark, sf, "location_name", "avg_temperature", "max_temperature", "avg_humidity", "total_precipitation"))


@query("D32_month_site_trend")
def _(spark, sf):
    return pf.grouped(fx.long_daily(spark, sf), ["year", "month", "location_name"], {"avg_temperature": ("mean",)})


@query("D32_wind_by_season_site")
def _(spark, sf):
    return pf.grouped(fx.long_daily(spark, sf), ["season", "location_name"], {"avg_wind_speed": ("mean",)})


@query("D33_daily_detail")
def _(spark, sf):
    return pf.daily_detail(fx.daily(spark, sf))


# -- E: windows --------------------------------------------------------------------------------


@query("E01_row_numbers")
def _(spark, sf):
    from gaugeline.operators.frames import with_positions

    return with_positions(fx.readings(spark, sf).select("event_id", "wind_speed"), ["wind_speed", "event_id"])


@query("E02_lag_features")
def _(spark, sf):
    return ft.lag_features(fx.daily(spark, sf)).select("location_name", "date", *ft.LAG_NAMES)


@query("E03_rolling_features")
def _(spark, sf):
    return ft.rolling_features(fx.daily(spark, sf)).select("location_name", "date", *ft.ROLLING_NAMES)


@query("E04_gap_fill")
def _(spark, sf):
    cleaned = st.clean_outliers(st.outlier_flags(fx.staged(spark, sf)))
    return st.fill_gaps(cleaned, fx.EVENT_SPEC).select("event_id", *[g.measure for g in st.GATES])


@query("E04_gap_fill_in_blocks")
def _(spark, sf):
    """The way taken when a site's day is too large for one task."""
    cleaned = st.clean_outliers(st.outlier_flags(fx.staged(spark, sf)))
    filled = st.fill_gaps(cleaned, fx.EVENT_SPEC, limit=0, block_rows=16)
    return filled.select("event_id", *[g.measure for g in st.GATES])


@query("E05_change_features")
def _(spark, sf):
    names = [n for n, _, right, _ in ft.DIFFERENCES if "_lag_" in right]
    return fx.features(spark, sf).select("location_name", "date", *names)


@query("E06_deviation_features")
def _(spark, sf):
    names = [n for n, _, right, _ in ft.DIFFERENCES if "_rolling_" in right]
    return fx.features(spark, sf).select("location_name", "date", *names)


@query("E07_volatility")
def _(spark, sf):
    return fx.features(spark, sf).select("location_name", "date", *[n for n, _ in ft.VOLATILITY])


@query("E08_feature_mart")
def _(spark, sf):
    return fx.features(spark, sf)


@query("E08_feature_mart_long")
def _(spark, sf):
    return fx.long_features(spark, sf)


@query("E08_feature_mart_in_blocks")
def _(spark, sf):
    """Features of a series too long for one task per entity."""
    return ft.feature_mart(fx.long_daily(spark, sf), as_of=fx.AS_OF, limit=0, block_rows=64)


@query("E09_day_gaps")
def _(spark, sf):
    return ck.day_gaps(fx.orders_daily(spark, sf))


@query("E10_recomputed_lag")
def _(spark, sf):
    return ck.recomputed_lag(fx.long_features(spark, sf))


@query("E11_seasonal_decompose")
def _(spark, sf):
    return decompose.seasonal_decompose(mart(spark, sf, "location_name", "date", "avg_temperature"), "avg_temperature")


@query("E11_seasonal_decompose_even_period")
def _(spark, sf):
    return decompose.seasonal_decompose(mart(spark, sf, "location_name", "date", "avg_humidity"), "avg_humidity", period=30)


@query("E12_average_ranks")
def _(spark, sf):
    return ranks.value_ranks(fx.table(spark, sf, "events"), "value")


@query("E13_cumulative_share")
def _(spark, sf):
    totals = fx.table(spark, sf, "events").groupBy("user_id").agg(F.sum("value").alias("w"))
    shares = beside(totals, totals.agg(F.sum("w").alias("_all"))).select(
        F.concat(F.lit("user_"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("name"), (F.col("w") / F.col("_all")).alias("importance")
    )
    return pf.count_to_reach(pf.running_share(shares, "importance", "name"))


@query("E14_latest_per_site")
def _(spark, sf):
    return pf.latest_per_entity(fx.long_daily(spark, sf), values=["avg_temperature", "avg_humidity"])


@query("E15_ordered_series")
def _(spark, sf):
    return fx.long_daily(spark, sf).select("location_name", "date", "avg_temperature").orderBy("location_name", "date")


# -- F, G: order, limits, samples, sets --------------------------------------------------------


@query("F01_order_by")
def _(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderpriority", "o_orderkey").orderBy("o_orderpriority", "o_orderkey")


@query("F02_limit")
def _(spark, sf):
    # Any rows may come: what is checked is their number, and that each of them is a reading.
    readings = fx.readings(spark, sf).select("event_id", "location_name")
    taken = written(readings.limit(1000), "limited")
    known = taken.join(readings, ["event_id", "location_name"], "left_semi").agg(F.count(F.lit(1)).alias("known"))
    return beside(taken.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("event_id").alias("different")), known)


@query("F03_head")
def _(spark, sf):
    return fx.readings(spark, sf).orderBy("datetime", "event_id").select("event_id", "location_name").limit(10)


@query("F03_tail")
def _(spark, sf):
    return fx.readings(spark, sf).orderBy(F.desc("datetime"), F.desc("event_id")).select("event_id", "location_name").limit(10)


@query("F03_sample")
def _(spark, sf):
    return pf.hash_sample(fx.readings(spark, sf), ["event_id"], 10, seed=7).select("event_id", "location_name")


@query("F04_hash_sample")
def _(spark, sf):
    return pf.hash_sample(fx.readings(spark, sf), ["event_id"], 5000).select("event_id", "wind_speed")


@query("F05_top_k")
def _(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("G01_union_all")
def _(spark, sf):
    raw = fx.readings(spark, sf).select("event_id", "location_name")
    sites = [raw.filter(F.col("location_name") == site) for site in EVENT_SITES[1:]]
    united = raw.filter(F.col("location_name") == EVENT_SITES[0])
    for site in sites:
        united = united.unionByName(site.select("location_name", "event_id"))  # by name, whatever the order
    return united.unionByName(raw)


@query("G02_distinct")
def _(spark, sf):
    return fx.readings(spark, sf).select("location_name", "latitude", "longitude").distinct()


@query("G03_difference")
def _(spark, sf):
    customers = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    # Orders of one customer in seven are booked on another key, which leaves some customers without.
    booked = F.when(F.col("o_custkey") % 7 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return ck.all_present(customers, fx.table(spark, sf, "orders").select(booked.alias("custkey")), "custkey")


# -- H: dimensions -----------------------------------------------------------------------------


@query("H01_date_spine")
def _(spark, sf):
    return dimensions.spine_of(fx.long_daily(spark, sf))


@query("H02_date_dimension")
def _(spark, sf):
    return dimensions.date_dimension(dimensions.spine_of(fx.long_daily(spark, sf)))


@query("H03_location_dimension")
def _(spark, sf):
    return dimensions.location_dimension(fx.shipments(spark, sf))


@query("H04_regular_days")
def _(spark, sf):
    return ft.regular_days(fx.orders_daily(spark, sf).select("location_name", "date", "orders"))


# -- I: data quality ---------------------------------------------------------------------------


@query("I01_unique")
def _(spark, sf):
    return ck.unique(fx.table(spark, sf, "lineitem"), "l_orderkey")


@query("I02_not_null")
def _(spark, sf):
    return ck.not_null(fx.readings(spark, sf), "temperature").select("event_id")


@query("I03_accepted_values")
def _(spark, sf):
    return ck.accepted_values(fx.table(spark, sf, "events"), "event_type", ["click", "view", "purchase"])


@query("I04_non_negative")
def _(spark, sf):
    return ck.non_negative(fx.table(spark, sf, "customer"), "c_acctbal")


@query("I05_valid_humidity")
def _(spark, sf):
    return ck.valid_humidity(fx.readings(spark, sf))


@query("I06_valid_temperature")
def _(spark, sf):
    return ck.valid_temperature(fx.readings(spark, sf))


@query("I07_enough_days")
def _(spark, sf):
    daily = fx.orders_daily(spark, sf)
    on_first = F.when(F.dayofmonth("date").isin(3, 7, 11, 19), F.trunc("date", "month")).otherwise(F.col("date"))
    moved = daily.withColumn("date", on_first)
    return ck.enough_days(
        # Four days of each month are booked on the first, so that days are missing.
        moved.groupBy("location_name", "date").agg(F.sum("orders").alias("orders"))
    )


@query("I08_quality_at_least")
def _(spark, sf):
    return ck.quality_at_least(fx.checked(spark, sf), 91.0)


@query("I09_continuous_days")
def _(spark, sf):
    return ck.continuous_days(fx.orders_daily(spark, sf))


@query("I10_consistent_lag")
def _(spark, sf):
    shifted = F.when(F.dayofmonth("date") == 5, F.col("temp_lag_1d") + 0.5).otherwise(F.col("temp_lag_1d"))
    return ck.consistent_lag(fx.features(spark, sf).withColumn("temp_lag_1d", shifted))


@query("I11_all_present")
def _(spark, sf):
    nations = fx.table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("location_name"))
    # Suppliers of every fifth nation are entered under another one.
    nation = F.when(F.col("s_nationkey") % 5 == 0, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey"))
    suppliers = fx.table(spark, sf, "supplier").select(F.concat(F.lit("n"), nation).alias("location_name"))
    return ck.all_present(nations, suppliers)


@query("I12_one_row_per_day")
def _(spark, sf):
    return ck.one_row_per_day(fx.staged(spark, sf))


@query("I13_no_future_dates")
def _(spark, sf):
    return ck.no_future_dates(fx.daily(spark, sf), "2024-01-20")


@query("I14_non_negative_totals")
def _(spark, sf):
    ungated = st.enrich(st.quality_score(st.outlier_flags(fx.staged(spark, sf))))
    # On every fifth day the gauge counts backwards.
    turned = F.when(F.dayofmonth("date") % 5 == 0, -F.col("precipitation")).otherwise(F.col("precipitation"))
    return ck.non_negative_totals(dy.daily_rollup(ungated.withColumn("precipitation", turned), as_of=fx.AS_OF))


@query("I15_plausible_rolling_means")
def _(spark, sf):
    return ck.plausible_rolling_means(fx.features(spark, sf), week=1.5, month=2.0)


@query("I16_ordered_temperatures")
def _(spark, sf):
    tampered = F.when(F.dayofmonth("date") % 7 == 0, F.col("max_temperature") + 1).otherwise(F.col("avg_temperature"))
    return ck.ordered_temperatures(fx.daily(spark, sf).withColumn("avg_temperature", tampered))


@query("I17_batch_shape")
def _(spark, sf):
    return ck.batch_shape(fx.readings(spark, sf).drop("pressure"), RAW_READINGS.names, 5 * 24 * 30)


@query("I18_check_suite")
def _(spark, sf):
    staged, checked = fx.staged(spark, sf), fx.checked(spark, sf)
    daily = written(fx.daily(spark, sf), "daily")
    features = written(ft.feature_mart(daily, as_of=fx.AS_OF), "features")
    sites = dimensions.location_dimension(fx.readings(spark, sf))
    dates = dimensions.date_dimension(dimensions.spine_of(daily))
    suite = ck.mart_checks(
        spark, fx.readings(spark, sf), checked, daily, features, sites, dates, seeds.location_metadata(spark), staged, fx.AS_OF
    )
    return ck.run_checks(suite)


# -- J: inference ------------------------------------------------------------------------------


@query("J01_dagostino")
def _(spark, sf):
    return inf.dagostino(fx.long_daily(spark, sf), list(DAILY_VARIABLES))


@query("J02_shapiro")
def _(spark, sf):
    return inf.shapiro(mart(spark, sf, "location_name", "date", *DAILY_VARIABLES), list(DAILY_VARIABLES), ["location_name", "date"])


@query("J03_qq_points")
def _(spark, sf):
    return inf.qq_points(mart(spark, sf, "location_name", "date", "avg_temperature"), "avg_temperature", ["location_name", "date"])


@query("J03_qq_line")
def _(spark, sf):
    return inf.qq_line(inf.qq_points(mart(spark, sf, "location_name", "date", "avg_temperature"), "avg_temperature", ["location_name", "date"]))


@query("J04_levene")
def _(spark, sf):
    return inf.levene(mart(spark, sf, "season", "avg_temperature"), "avg_temperature", "season")


@query("J05_t_test")
def _(spark, sf):
    return inf.t_test(mart(spark, sf, "season", "avg_wind_speed"), "avg_wind_speed", "season", *SEASONS)


@query("J06_mann_whitney")
def _(spark, sf):
    return inf.mann_whitney(mart(spark, sf, "season", "avg_wind_speed"), "avg_wind_speed", "season", *SEASONS)


@query("J07_cohens_d")
def _(spark, sf):
    return inf.cohens_d(fx.long_daily(spark, sf), "avg_temperature", "season", *SEASONS)


@query("J08_anova")
def _(spark, sf):
    return inf.anova(mart(spark, sf, "location_name", "avg_temperature"), "avg_temperature", "location_name")


@query("J09_kruskal")
def _(spark, sf):
    return inf.kruskal(mart(spark, sf, "location_name", "avg_temperature"), "avg_temperature", "location_name")


@query("J10_tukey_hsd")
def _(spark, sf):
    return inf.tukey_hsd(mart(spark, sf, "location_name", "avg_temperature"), "avg_temperature", "location_name")


@query("J10_tukey_differences")
def _(spark, sf):
    return inf.tukey_hsd(mart(spark, sf, "location_name", "avg_temperature"), "avg_temperature", "location_name").select("group1", "group2", "mean_diff")


@query("J11_proportion_test")
def _(spark, sf):
    return inf.proportion_test(fx.long_daily(spark, sf), F.col("total_precipitation") > 0, "season", *SEASONS)


@query("J12_pearson")
def _(spark, sf):
    return inf.pearson(fx.long_daily(spark, sf), TESTED_PAIRS)


@query("J13_spearman")
def _(spark, sf):
    return inf.spearman(fx.long_daily(spark, sf), TESTED_PAIRS)


@query("J14_kendall")
def _(spark, sf):
    return inf.kendall(fx.long_daily(spark, sf), TESTED_PAIRS)


@query("J15_confidence_intervals")
def _(spark, sf):
    return inf.confidence_intervals(fx.long_daily(spark, sf), ["avg_temperature", "total_precipitation", "avg_humidity"], "location_name")


@query("J16_chi_square")
def _(spark, sf):
    return inf.chi_square(pf.above_quantile(mart(spark, sf, "location_name", "date", "avg_temperature", "avg_humidity"), HOT_HUMID), "is_hot", "is_very_humid")


@query("J16_expected_counts")
def _(spark, sf):
    return inf.expected_counts(pf.above_quantile(mart(spark, sf, "location_name", "date", "avg_temperature", "avg_humidity"), HOT_HUMID), "is_hot", "is_very_humid")


@query("J17_labels")
def _(spark, sf):
    matrix = pf.correlation_matrix(fx.long_daily(spark, sf), CORRELATED)
    return matrix.select("variable_1", "variable_2", labels.strength("correlation").alias("strength"), labels.effect_size("correlation").alias("effect"))


@query("J18_group_descriptions")
def _(spark, sf):
    return inf.group_descriptions(mart(spark, sf, "season", "total_precipitation"), "total_precipitation", "season")


# -- K: regression -----------------------------------------------------------------------------


def _frame(spark, sf):
    return rg.model_frame(feature_mart(spark, sf))


def _split(spark, sf, scaled: bool = False):
    """(train, test) after a time split and imputation with training means."""
    split = rg.split_by_time(_frame(spark, sf))
    filled = written(rg.impute_means(split, split.filter("split = 'train'")), "split")
    if scaled:
        filled = rg.standardise(filled, filled.filter("split = 'train'"))
    return filled.filter("split = 'train'"), filled.filter("split = 'test'")


def _scored(spark, sf, make, scaled: bool = False):
    train, test = _split(spark, sf, scaled)
    model = make(train).fit(rg.training_set(train))
    return model.transform(rg.assemble(test))


@query("K01_target_summary")
def _(spark, sf):
    return rg.target_summary(rg.model_frame(fx.long_features(spark, sf)))


@query("K02_mean_imputation")
def _(spark, sf):
    columns = ("temp_lag_14d", "temp_rolling_std_7d_prev")
    return rg.impute_means(rg.model_frame(feature_mart(spark, sf, *columns), columns), columns=columns)


@query("K03_time_split")
def _(spark, sf):
    return rg.split_summary(rg.split_by_time(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",))))


@query("K04_standardise")
def _(spark, sf):
    columns = ("temp_lag_1d", "precip_lag_1d")
    split = rg.split_by_time(rg.model_frame(feature_mart(spark, sf, *columns), columns))
    return rg.standardise(split, split.filter("split = 'train'"), columns)


@query("K05_mean_baseline")
def _(spark, sf):
    split = rg.split_by_time(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",)))
    return rg.metrics(rg.mean_baseline(split.filter("split = 'train'"), split.filter("split = 'test'")))


@query("K06_last_value_baseline")
def _(spark, sf):
    split = rg.split_by_time(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",)))
    return rg.metrics(rg.last_value_baseline(split.filter("split = 'test'")))


@query("K07_least_squares")
def _(spark, sf):
    train, test = _split(spark, sf, scaled=True)
    return rg.metrics(rg.with_line(test, *rg.solved(rg.moments(train)[0])))


@query("K07_single_input_line")
def _(spark, sf):
    columns = ("temp_rolling_7d_prev",)
    split = rg.split_by_time(rg.model_frame(feature_mart(spark, sf, *columns), columns))
    train, test = (rg.assemble(split.filter(f"split = '{part}'"), columns) for part in ("train", "test"))
    return rg.least_squares().fit(train).transform(test).select("location_name", "date", "label", "prediction")


@query("K08_ridge")
def _(spark, sf):
    return rg.metrics(_scored(spark, sf, lambda train: rg.ridge(*rg.label_scale(train)), scaled=True))


@query("K09_lasso")
def _(spark, sf):
    return rg.metrics(_scored(spark, sf, lambda train: rg.lasso(*rg.label_scale(train)), scaled=True))


@query("K10_elastic_net")
def _(spark, sf):
    return rg.metrics(_scored(spark, sf, lambda train: rg.elastic_net(*rg.label_scale(train)), scaled=True))


@query("K11_decision_tree")
def _(spark, sf):
    return rg.metrics(_scored(spark, sf, lambda train: rg.decision_tree()))


@query("K12_random_forest")
def _(spark, sf):
    return rg.metrics(_scored(spark, sf, lambda train: rg.random_forest()))


@query("K13_gradient_boosting")
def _(spark, sf):
    return rg.metrics(_scored(spark, sf, lambda train: rg.gradient_boosting()))


@query("K14_metrics_by_site")
def _(spark, sf):
    frame = rg.last_value_baseline(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",)))
    return rg.metrics(frame, ["location_name"])


def _all_predictions(spark, sf):
    """(model, label, prediction) of all nine models on the test part, written once."""
    raw_train, raw_test = _split(spark, sf)
    train, test = (written(rg.standardise(part, raw_train), "scaled") for part in (raw_train, raw_test))
    scale = rg.label_scale(train)
    # The models' names.
    linear = {
        "Linear Regression": rg.least_squares(), "Ridge Regression": rg.ridge(*scale),
        "Lasso Regression": rg.lasso(*scale), "ElasticNet": rg.elastic_net(*scale),
    }
    trees = {"Decision Tree": rg.decision_tree(), "Random Forest": rg.random_forest(), "Gradient Boosting": rg.gradient_boosting()}
    scored = {}
    for models, fitted_on, held_out in ((linear, train, test), (trees, raw_train, raw_test)):
        inputs, rows = written(rg.training_set(fitted_on), "inputs"), rg.assemble(held_out)
        scored |= {name: model.fit(inputs).transform(rows) for name, model in models.items()}
    scored["Mean Baseline"] = rg.mean_baseline(raw_train, raw_test)
    scored["Last Value Baseline"] = rg.last_value_baseline(raw_test)
    rows = [frame.select(F.lit(name).alias("model"), "label", "prediction") for name, frame in scored.items()]
    return written(inf.union_all(rows), "predictions")


def _comparison(spark, sf):
    """All nine models, scored on the test part in one grouped pass."""
    return rg.compare(_all_predictions(spark, sf))


@query("K15_model_comparison")
def _(spark, sf):
    return _comparison(spark, sf)


@query("F06_best_model")
def _(spark, sf):
    return rg.best(_comparison(spark, sf)).select("model")


@query("F06_best_baseline")
def _(spark, sf):
    train, test = _split(spark, sf)
    scored = {"Mean Baseline": rg.mean_baseline(train, test), "Last Value Baseline": rg.last_value_baseline(test)}
    rows = [frame.select(F.lit(name).alias("model"), "label", "prediction") for name, frame in scored.items()]
    return rg.best(rg.compare(inf.union_all(rows))).select("model")


@query("K16_feature_importance")
def _(spark, sf):
    train, _ = _split(spark, sf)
    model = rg.random_forest().fit(rg.training_set(train))
    shares = written(rg.importances(spark, model), "importances")
    return beside(shares.filter("position <= 20"), rg.features_to_reach(shares))


@query("K17_residuals")
def _(spark, sf):
    split = rg.split_by_time(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",)))
    return rg.residuals(rg.last_value_baseline(split.filter("split = 'test'")))


@query("K17_residual_summary")
def _(spark, sf):
    split = rg.split_by_time(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",)))
    return rg.residual_summary(rg.residuals(rg.last_value_baseline(split.filter("split = 'test'"))))


@query("K18_time_blocks")
def _(spark, sf):
    blocks = rg.time_blocks(rg.model_frame(feature_mart(spark, sf, "temp_lag_1d"), ("temp_lag_1d",)), 6)
    return blocks.groupBy("fold").agg(F.count(F.lit(1)).alias("records"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("K18_linear_folds")
def _(spark, sf):
    return rg.linear_cv(_split(spark, sf, scaled=True)[0])


@query("K18_expanding_cv")
def _(spark, sf):
    train, _ = _split(spark, sf)
    models = {
        "Linear Regression": rg.least_squares(), "Random Forest": rg.random_forest(trees=50, depth=10),
        "Gradient Boosting": rg.gradient_boosting(rounds=50),
    }
    return rg.cv_summary(rg.expanding_cv(rg.training_set(train), models))


#: Where the search's score table of a session and data folder is stored.
_SEARCHES: dict[tuple[str, str], str] = {}


def _searched(spark, sf):
    """The scores of the whole declared grid, ``rg.FOREST_GRID``, searched once and stored."""
    key = spark.sparkContext.applicationId, sf
    if key not in _SEARCHES:
        train = rg.split_by_time(_frame(spark, sf)).filter("split = 'train'").drop("split")
        path = tables.scratch(spark, "search")
        rg.forest_search(train).write.parquet(path)
        _SEARCHES[key] = path
    return spark.read.parquet(_SEARCHES[key])


@query("K19_grid_search")
def _(spark, sf):
    return _searched(spark, sf)


@query("K20_stored_pipeline")
def _(spark, sf):
    """The best of the search, refitted on all training rows, stored with its record, loaded and scored."""
    split = written(rg.split_by_time(_frame(spark, sf)), "split")
    scores, path = _searched(spark, sf), tables.scratch(spark, "model")
    model = rg.forecast_pipeline(split.filter("split = 'train'"), rg.best_forest(scores))
    rg.save_model(model, f"{path}/model")
    rg.model_record(spark, model, scores).write.parquet(f"{path}/record")
    scored = rg.load_model(f"{path}/model").transform(split.filter("split = 'test'"))
    return rg.metrics(scored.select("label", "prediction"))


# -- L: streaming ------------------------------------------------------------------------------


def _batches(spark, sf):
    """The readings as two arriving files that overlap by six days."""
    path = tables.scratch(spark, "arrivals")
    raw = fx.readings(spark, sf)
    raw.filter("datetime < '2024-01-16'").write.mode("append").parquet(path)
    raw.filter("datetime >= '2024-01-10'").write.mode("append").parquet(path)
    return flows.read_batches(spark, path, raw.schema)


@query("L01_distinct_stream")
def _(spark, sf):
    path = tables.scratch(spark, "deduplicated")
    flows.start_append(flows.distinct_readings(_batches(spark, sf), late="60 days"), path).awaitTermination()
    return spark.read.parquet(path).groupBy("location_name").agg(F.count(F.lit(1)).alias("records"), F.sum("event_id").alias("ids"))


@query("L02_daily_stream")
def _(spark, sf):
    source, path = tables.scratch(spark, "arrivals"), tables.scratch(spark, "daily-stream")
    raw = fx.readings(spark, sf)
    raw.write.parquet(source)
    totals = flows.daily_totals(flows.read_batches(spark, source, raw.schema))
    flows.start_daily_store(totals, path, tables.scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(path).drop("_batch")


@query("L03_upsert_stream")
def _(spark, sf):
    raw_path, mart_path, arrivals = (tables.scratch(spark, x) for x in ("raw", "mart", "arrivals"))
    raw = fx.readings(spark, sf)
    raw.filter("datetime < '2024-01-16'").write.parquet(f"{arrivals}/1")
    # The second file sends six days again with corrected wind speeds.
    raw.filter("datetime >= '2024-01-10'").withColumn("wind_speed", F.col("wind_speed") + 1).write.parquet(f"{arrivals}/2")

    def day_rows(readings):
        return readings.groupBy("date", "location_name").agg(
            F.count(F.lit(1)).alias("total_hourly_records"), F.max("wind_speed").alias("strongest_wind")
        )

    for i in (1, 2):
        stream = flows.read_batches(spark, f"{arrivals}/{i}", raw.schema)
        place = tables.scratch(spark, "checkpoint")
        flows.start_daily_mart(stream, raw_path, mart_path, ["record_id"], "datetime", day_rows, place).awaitTermination()
    return spark.read.parquet(mart_path).select("date", "location_name", "total_hourly_records", "strongest_wind")
