"""Column helpers, readings rules at their bounds, distribution functions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import calendar as cal
from gaugeline.functions import cdf, keys, labels
from gaugeline.functions.rounding import round_half_up
from gaugeline.operators import daily as dy
from gaugeline.operators import dimensions
from gaugeline.operators import profile as pf
from gaugeline.operators import staging as st


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.r for r in rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_rounding_ties_and_zero(spark):
    values = [1.005, -1.005, 2.675, 0.125, -0.001, None, 28.31, 1e15]
    got = column(spark, values, "double", round_half_up)
    assert got == [1.01, -1.01, 2.68, 0.13, 0.0, None, 28.31, 1e15]
    assert math.copysign(1, got[4]) == 1.0
    text = column(spark, values, "double", lambda v: F.expr("rint(v * 1)") * 0 + round_half_up("v"))
    assert text[:4] == got[:4]


def test_calendar(spark):
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 11, 2)]
    assert column(spark, days, "date", cal.day_of_week) == [0, 1, 6]
    assert column(spark, days, "date", lambda d: cal.day_name(cal.day_of_week(d))) == ["Sunday", "Monday", "Saturday"]
    assert column(spark, days, "date", lambda d: cal.month_name(F.month(d))) == ["January", "January", "November"]
    assert column(spark, days, "date", lambda d: cal.weekend_flag(cal.day_of_week(d))) == [1, 0, 1]
    assert column(spark, [4, 5, 10, 11], "int", cal.season) == ["Dry Season", "Rainy Season", "Rainy Season", "Dry Season"]
    assert column(spark, [4, 5, 11, 12, 16, 17, 20, 21], "int", cal.time_of_day) == [
        "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night",
    ]
    assert column(spark, [1, 3, 4, 12], "int", cal.quarter_label) == ["Q1", "Q1", "Q2", "Q4"]


def test_local_time(spark):
    utc = [dt.datetime(2024, 1, 1, 20, 0)]
    assert column(spark, utc, "timestamp_ntz", lambda t: cal.local_time(t, "Asia/Ho_Chi_Minh")) == [dt.datetime(2024, 1, 2, 3, 0)]


def test_gates_at_their_bounds(spark):
    rows = [(-50.0, 0.0, 0.0, 950.0, 0.0), (60.0, 100.0, 500.0, 1050.0, 150.0), (60.1, 100.5, -0.1, 949.9, 150.1), (None,) * 5]
    df = spark.createDataFrame(rows, "temperature double, humidity double, precipitation double, pressure double, wind_speed double")
    scored = st.quality_score(st.outlier_flags(df))
    assert [r.data_quality_score for r in scored.collect()] == [100, 100, 0, 100]
    cleaned = st.clean_outliers(st.outlier_flags(df)).collect()[2]
    assert (cleaned.temperature, cleaned.humidity, cleaned.precipitation, cleaned.pressure, cleaned.wind_speed) == (None, None, 0.0, None, None)


def test_intensity_and_rain_classes(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 2.4, 2.5, 10.0, 50.0)], "precipitation double")
    assert [r.precipitation_intensity for r in st.precipitation_intensity(df).collect()] == [
        "No Rain", "Light Rain", "Moderate Rain", "Heavy Rain", "Very Heavy Rain",
    ]
    values = [0.0, 0.5, 1.0, 1.1, 10.0, 50.0, 200.0, 200.1, None]
    assert column(spark, values, "double", lambda v: pf.rain_class("v")) == [
        None, "Light", "Light", "Moderate", "Moderate", "Heavy", "Very Heavy", None, None,
    ]


def test_one_row_day(spark):
    df = spark.createDataFrame(
        [("a", "r1", dt.datetime(2024, 1, 6, 5, 0), 20.004, 50.0, 0.0, 1000.0, 3.0, 350.0, 10.0)],
        "location_name string, record_id string, datetime timestamp_ntz, temperature double, humidity double, precipitation double, "
        "pressure double, wind_speed double, wind_direction double, cloud_cover double",
    )
    row = dy.daily_rollup(st.enrich(st.check_quality(st.stage(df))), as_of="2030-01-01").first()
    assert row.temp_std_dev is None and row.afternoon_temp is None and row.morning_temp == 20.0
    assert row.total_hourly_records == 1 and row.is_weekend == 1 and row.day_name == "Saturday"
    assert row.daily_id == __import__("hashlib").md5(b"a-2024-01-06").hexdigest()
    assert dy.daily_rollup(st.enrich(st.check_quality(st.stage(df))), as_of="2024-01-05").count() == 0


def test_circular_wind(spark):
    df = spark.createDataFrame([(350.0,), (10.0,)], "wind_direction double")
    assert df.agg(F.expr(dy.CIRCULAR_DIRECTION).alias("d")).first().d % 360 == pytest.approx(0.0, abs=1e-9)


def test_keys(spark):
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 2, 3, 4, 5))], "a string, t timestamp_ntz")
    row = df.select(keys.surrogate_key("a").alias("k"), F.lit("x").alias("s"), "t").withColumn("id", keys.record_id("s", "t")).first()
    assert row.k == __import__("hashlib").md5(b"_dbt_utils_surrogate_key_null_").hexdigest()
    assert row.id == "x_2024-01-02 03:04:05"


def test_site_with_two_coordinates(spark):
    rows = [("Hanoi", 21.0, 105.8), ("Hanoi", 21.1, 105.8), ("Atlantis", 0.0, 0.0), ("Hanoi", 21.0, 105.8)]
    got = dimensions.location_dimension(spark.createDataFrame(rows, "location_name string, latitude double, longitude double")).orderBy("location_id").collect()
    assert [(r.location_id, r.location_name, r.latitude, r.region) for r in got] == [
        (1, "Atlantis", 0.0, "Other"), (2, "Hanoi", 21.0, "Northern Vietnam"), (3, "Hanoi", 21.1, "Northern Vietnam"),
    ]


def test_date_spine_excludes_its_end(spark):
    days = [r.date for r in dimensions.date_spine(spark, "2023-12-30", "2024-01-02").orderBy("date").collect()]
    assert days == [dt.date(2023, 12, 30), dt.date(2023, 12, 31), dt.date(2024, 1, 1)]


def test_join_dimension_is_broadcast_by_size_alone(spark):
    fact = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    dim = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(key)
    try:
        for limit, kind in (("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set(key, limit)
            joined = dimensions.join_dimension(fact, dim, "k")
            assert joined.filter("d = k * 2").count() == 100
            assert kind in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, usual)



def test_labels(spark):
    assert column(spark, [0.1, -0.3, 0.5], "double", labels.effect_size) == ["Small", "Medium", "Large"]
    assert column(spark, [0.29, -0.3, 0.7], "double", labels.strength) == ["Weak", "Moderate", "Strong"]
    assert column(spark, [0.04, 0.05], "double", labels.significant) == ["Yes", "No"]


def test_distribution_functions():
    # t probabilities of published correlations over 3655 pairs
    for r, p in ((0.06128135881180163, 0.0002096632275965293), (0.4145229532833148, 8.880008066010295e-152), (-0.18641323377563981, 6.188273733608899e-30)):
        assert cdf.t_two_sided(r * math.sqrt(3653 / (1 - r * r)), 3653) == pytest.approx(p, rel=1e-8)
    # textbook tables
    assert cdf.t_quantile(0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert cdf.t_quantile(0.975, 1) == pytest.approx(12.706205, abs=1e-5)
    assert cdf.chi2_sf(9.487729, 4) == pytest.approx(0.05, abs=1e-7)
    assert cdf.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-7)
    assert cdf.f_sf(3.098391, 3, 20) == pytest.approx(0.05, abs=1e-6)
    assert cdf.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-7)
    assert cdf.studentized_range_quantile(0.95, 5, 60.0) == pytest.approx(3.977, abs=1e-3)
    assert cdf.studentized_range_quantile(0.95, 3, 10.0) == pytest.approx(3.877, abs=1e-3)
    assert cdf.studentized_range_sf(3.314, 3, 1e6) == pytest.approx(0.05, abs=2e-4)
