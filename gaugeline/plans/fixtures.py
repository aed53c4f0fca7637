"""How the shared test tables stand in for readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators import daily as d
from gaugeline.operators import features as f
from gaugeline.operators import staging as st
from gaugeline.schema import SeriesSpec

EVENT_SPEC = SeriesSpec(tie_break=("event_id",))
AS_OF = "2030-01-01"

# Which site each return flag stands for.
FLAG_SITES = {"A": "Hanoi", "N": "Ho Chi Minh City", "R": "Da Nang"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour-like readings from ``events``: with gaps, outliers and unreliable rows."""
    k = F.get_json_object("props", "$.k").cast("double")
    value, event = F.col("value"), F.col("event_id")

    def gap(step: int, column):
        return F.when(event % step != 0, column)

    return table(spark, sf_dir, "events").select(
        event,
        F.concat_ws("_", "event_type", event).alias("record_id"),
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("location_name"),
        (F.length("event_type") * 2.5).cast("double").alias("latitude"),
        (100.0 + F.length("event_type")).alias("longitude"),
        gap(17, value / 5.0 - 10.0).alias("temperature"),
        gap(19, k * 1.25 - 5.0).alias("humidity"),
        gap(23, value / 10.0 - 0.5).alias("precipitation"),
        gap(29, k * 1.25 + 940.0).alias("pressure"),
        (value * 0.5 - 1.0).alias("wind_speed"),
        (F.col("user_id") * 37 % 360).cast("double").alias("wind_direction"),
        k.alias("cloud_cover"),
        F.to_date("ts").alias("extract_date"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of readings from ``lineitem``: three sites, all months, no gaps."""
    names = F.create_map(*[F.lit(x) for pair in FLAG_SITES.items() for x in pair])
    month = F.month("l_shipdate")
    hour = F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(24))
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("record_id"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=hour.cast("int"))).alias("datetime"),
        F.element_at(names, F.col("l_returnflag")).alias("location_name"),
        (F.ascii("l_returnflag") - 50).cast("double").alias("latitude"),
        (F.ascii("l_returnflag") + 30).cast("double").alias("longitude"),
        (F.col("l_quantity") * 0.25 + 16.0 + F.abs(month - 1) * 0.5).alias("temperature"),
        (F.col("l_discount") * 400.0 + 45.0 + month).alias("humidity"),
        F.greatest(F.lit(0.0), F.col("l_tax") * 100.0 + (month - 9)).alias("precipitation"),
        (F.pmod(F.col("l_partkey"), F.lit(400)) * 0.1 + 990.0).alias("pressure"),
        (F.pmod(F.col("l_suppkey"), F.lit(37)) * 0.75).alias("wind_speed"),
        (F.col("l_partkey") * 37 % 360).cast("double").alias("wind_direction"),
        (F.col("l_orderkey") % 101).cast("double").alias("cloud_cover"),
        F.to_date("l_shipdate").alias("extract_date"),
    )


def staged(spark, sf_dir) -> DataFrame:
    return st.stage(readings(spark, sf_dir), EVENT_SPEC)


def checked(spark, sf_dir) -> DataFrame:
    return st.check_quality(staged(spark, sf_dir), EVENT_SPEC)


def enriched(spark, sf_dir) -> DataFrame:
    return st.enrich(checked(spark, sf_dir))


def daily(spark, sf_dir) -> DataFrame:
    return d.daily_rollup(enriched(spark, sf_dir), as_of=AS_OF)


def features(spark, sf_dir) -> DataFrame:
    return f.feature_mart(daily(spark, sf_dir), as_of=AS_OF)


def long_checked(spark, sf_dir) -> DataFrame:
    return st.check_quality(st.stage(shipments(spark, sf_dir)))


def long_daily(spark, sf_dir) -> DataFrame:
    return d.daily_rollup(st.enrich(long_checked(spark, sf_dir)), as_of=AS_OF)


def long_features(spark, sf_dir) -> DataFrame:
    return f.feature_mart(long_daily(spark, sf_dir), as_of=AS_OF)


def orders_daily(spark, sf_dir) -> DataFrame:
    """Long series with missing days: orders per priority and date."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("location_name"), F.to_date("o_orderdate").alias("date"))
        .agg(F.sum("o_totalprice").alias("total_price"), F.avg("o_totalprice").alias("avg_price"), F.count(F.lit(1)).alias("orders"))
    )
