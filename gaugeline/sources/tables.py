"""Tables on shared storage: loading modes, idempotent append, keyed stores, result files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import new_path, written

MODES = {"append": "append", "replace": "overwrite", "fail": "error"}


def save_table(df: DataFrame, path: str, if_exists: str = "append", partition_by: Sequence[str] = ()) -> None:
    """``append`` adds rows, ``replace`` rewrites the table, ``fail`` refuses an existing one."""
    df.write.mode(MODES[if_exists]).partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full load. The new content is complete on storage before the old one goes, so a frame
    that itself reads ``path`` is safe."""
    save_table(written(df, "replace"), path, "replace", partition_by)


def save_result(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A frame as CSV with a header, in parts, or as one file if the caller says it is small."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except Exception as error:  # only "no such path" means a first load
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise
    return True


def on_days_of(target: DataFrame, batch: DataFrame, day: str) -> DataFrame:
    """The rows of ``target`` from the first to the last day of ``batch``: a constant filter, so a
    target partitioned by day lists and reads only those partitions."""
    first, last = batch.agg(F.min(day), F.max(day)).first()
    return target.limit(0) if first is None else target.filter(F.col(day).between(F.lit(first), F.lit(last)))


def new_rows(batch: DataFrame, target: DataFrame, key: Sequence[str] = ("record_id",), day: str | None = "date") -> DataFrame:
    """The rows of ``batch`` whose key the target lacks, one per key. With ``day`` only the
    target's days that occur in the batch are read; a key is then looked up on its own day."""
    match = list(key) if day is None else [day, *key]
    known = target if day is None else on_days_of(target, batch, day)
    return batch.dropDuplicates(list(key)).join(known.select(*match), match, "left_anti")


def incomplete(batch: DataFrame, required: Sequence[str] = ("record_id", "datetime")) -> DataFrame:
    """The rows of a batch that ``append_new`` leaves out, for a table of rejects."""
    return batch.filter(" or ".join(f"`{c}` is null" for c in required))


def append_new(
    batch: DataFrame, path: str, key: Sequence[str] = ("record_id",), time: str = "datetime", day: str = "date"
) -> None:
    """Idempotent load: sending a batch again, or one that overlaps it, adds nothing twice. Rows
    without a key or time do not get in (see ``incomplete``). A target that cannot be read stops
    the load instead of being taken for empty."""
    spark = batch.sparkSession
    dated = batch.na.drop(subset=[*key, time]).withColumn(day, F.to_date(time))
    if path_exists(spark, path):
        fresh = new_rows(dated, spark.read.parquet(path), key, day)
    else:
        fresh = dated.dropDuplicates(list(key))
    # Few files per day, and a very large day is split at run time instead of filling one task.
    fresh.hint("rebalance", day).write.mode("append").partitionBy(day).parquet(path)


def latest_by_key(df: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``version``; an aggregate, so copies of a key are combined
    before the shuffle and a key with very many versions is no burden on one task."""
    rest = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return df.groupBy(*key).agg(newest).select(*[c if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def upsert(df: DataFrame, path: str, key: Sequence[str], version: Sequence[str], day: str | None = None) -> DataFrame:
    """Merge rows into a keyed store and return its new content. Of rows with equal versions the
    incoming one wins.

    With ``day``, a date column that is part of the key or fixed for it (a day, or the month of a
    sparse store), the store is partitioned by it and only the partitions of dates in the batch are
    read and replaced. The merged rows are complete
    on storage before anything in place goes.
    """
    spark = df.sparkSession
    merged = df.withColumn("_incoming", F.lit(1))
    if path_exists(spark, path):
        stored = spark.read.parquet(path)
        if day is not None:
            touched = df.select(F.col(day).alias("_day")).distinct()
            stored = on_days_of(stored, df, day).join(touched, F.col(day) == F.col("_day"), "left_semi")
        merged = stored.withColumn("_incoming", F.lit(0)).unionByName(merged, allowMissingColumns=True)
    latest = latest_by_key(merged, key, [*version, "_incoming"]).drop("_incoming")
    if day is None:
        replace_table(latest, path)
    else:
        replace_days(latest, path, day)
    return spark.read.parquet(path)


def replace_days(df: DataFrame, path: str, day: str) -> None:
    """Replace the partitions of the days that ``df`` holds; the others stay untouched."""
    complete = written(df, "days").hint("rebalance", day)
    complete.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run a SQL text over frames that it names in braces: ``SELECT ... FROM {daily}``. The names hold for this
    text alone."""
    return spark.sql(sql, **frames)


def scratch(spark: SparkSession, label: str) -> str:
    return new_path(spark, label)
