"""Structured Streaming forms of ingestion and the daily roll-up.

Event time must be a zoned timestamp for watermarks, so wall-clock times are cast (the session
runs in UTC). Queries keep their state in a checkpoint folder under the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugeline.session import new_path, written
from gaugeline.sources.tables import on_days_of, replace_days, upsert

MEASURES = ("temperature", "humidity", "precipitation", "pressure", "wind_speed")


def read_batches(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def distinct_readings(stream: DataFrame, key: Sequence[str] = ("record_id",), time: str = "datetime", late: str = "2 days") -> DataFrame:
    """Drop rows whose key was already seen within the lateness bound; state older than the
    bound is released."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, late).dropDuplicatesWithinWatermark(list(key))


def daily_totals(stream: DataFrame, entity: str = "location_name", time: str = "datetime", late: str = "2 days", measures: Sequence[str] = MEASURES) -> DataFrame:
    """Count, sum, minimum, maximum and mean per entity and day. Rows later than the watermark
    allows are dropped. In update mode every batch emits the days it changed, open ones too."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    aggregates = [F.count(F.lit(1)).alias("total_hourly_records")]
    for m in measures:
        aggregates += [F.sum(m).alias(f"sum_{m}"), F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}"), F.avg(m).alias(f"avg_{m}")]
    rolled = timed.groupBy(F.window(time, "1 day"), entity).agg(*aggregates)
    return rolled.withColumn("date", F.to_date("window.start")).drop("window")


def start_append(stream: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Write to a Parquet table until the available input is used up. A flow that is to go on after
    a stop needs a ``checkpoint`` folder of its own; without one it starts anew."""
    place = checkpoint or new_path(stream.sparkSession, "stream")
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", place)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )


def start_daily_store(totals: DataFrame, path: str, checkpoint: str, entity: str = "location_name") -> StreamingQuery:
    """Keep the totals of every day, open ones included, in a store partitioned by day: each batch
    replaces the rows it changed. A batch run again after a failure writes the same rows."""

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            upsert(batch.withColumn("_batch", F.lit(number)), path, [entity, "date"], ["_batch"], "date")

    return totals.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()


def start_daily_mart(
    stream: DataFrame, raw_path: str, mart_path: str, key: Sequence[str], time: str,
    build: Callable[[DataFrame], DataFrame], checkpoint: str, day: str = "date",
) -> StreamingQuery:
    """Upsert the raw readings by key, then recompute the mart rows of the touched days from all
    their readings and replace those partitions: corrections and late rows reach the mart."""

    def load(batch: DataFrame, _: int) -> None:
        dated = batch.na.drop(subset=[*key, time]).withColumn(day, F.to_date(time))
        if dated.isEmpty():
            return
        days = written(dated.select(day).distinct(), "days")
        raw = upsert(dated, raw_path, key, [time], day)
        touched = on_days_of(raw, days, day).join(days, day, "left_semi")
        replace_days(build(touched), mart_path, day)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
