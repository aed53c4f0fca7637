"""Readers for delimited, JSON and payload-shaped readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.keys import record_id
from gaugeline.schema import NULL_TOKENS, RAW_READINGS


def read_csv(spark: SparkSession, path, schema: T.StructType, null_tokens: Sequence[str] = NULL_TOKENS, sep: str = ",") -> DataFrame:
    """Typed CSV with a header, optional quotes, trimmed fields, several NULL tokens and rows of
    uneven length. Fields are read as text first because the reader itself knows one NULL token;
    text that does not parse as its column's type becomes NULL."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    rows = spark.read.schema(text).csv(
        path, header=True, sep=sep, quote='"', mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, enforceSchema=True,
    )

    def typed(field: T.StructField) -> Column:
        value = F.when(~F.col(field.name).isin(*null_tokens), F.col(field.name))
        return value.try_cast(field.dataType).alias(field.name)

    return rows.select(*[typed(f) for f in schema])


def read_json(spark: SparkSession, path, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON objects, or arrays of them (the outer array is stripped). Line-delimited files split
    across tasks; ``multi_line`` is for a file that is one document."""
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def unpack_payload(
    payload: DataFrame,
    variables: Mapping[str, Column],
    keep: Sequence[str] = (),
    start: str = "start",
    end: str = "end",
    interval: str = "interval",
) -> DataFrame:
    """One row per step of [start, end) with the matching element of each parallel array.

    ``start`` and ``end`` are epoch seconds, ``interval`` seconds. An array shorter than the
    range leaves NULLs.
    """
    steps = F.when(
        F.col(end) > F.col(start), F.sequence(F.col(start), F.col(end) - F.col(interval), F.col(interval))
    ).otherwise(F.array().cast("array<bigint>"))
    arrays = [array.alias(name) for name, array in variables.items()]
    zipped = payload.select(*keep, F.explode(F.arrays_zip(steps.alias("_at"), *arrays)).alias("_row"))
    named = zipped.select(
        *keep, F.timestamp_seconds("_row._at").alias("datetime"), *[F.col(f"_row.{name}").alias(name) for name in variables]
    )
    # An array longer than the range has elements without a time.
    return named.filter(F.col("datetime").isNotNull())


def tag_sites(extracts: Mapping[str, DataFrame], entity: str = "location_name") -> DataFrame:
    """Per-site extracts under each other, each tagged with its site."""
    tagged = [df.withColumn(entity, F.lit(site)) for site, df in extracts.items()]
    united = tagged[0]
    for df in tagged[1:]:
        united = united.unionByName(df)
    return united


def prepare_batch(extract: DataFrame, extract_date: str | Column | None = None) -> DataFrame:
    """Add the extract date and the record id, in the column order of the raw table."""
    stamp = F.current_date() if extract_date is None else extract_date if isinstance(extract_date, Column) else F.lit(extract_date).cast("date")
    return extract.withColumns({"extract_date": stamp, "record_id": record_id("location_name", "datetime")}).select(
        *RAW_READINGS.names
    )
