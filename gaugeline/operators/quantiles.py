"""Exact quantiles (linear interpolation) of any number of columns and groups.

``percentile`` keeps one counter per distinct value of a group in memory. That is right for
gated, rounded measures, and wrong for a column with billions of distinct values, so the number
of distinct values is estimated first. Past the limit, values are counted, laid out by a
distributed prefix sum, and the two neighbours of each wanted rank are picked; nothing is
sampled or approximated on either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.operators.frames import prefix_sums

DISTINCT_LIMIT = 1_000_000


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., variable, value), one row per non-null value."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    return df.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(columns)}, {pairs}) as (variable, value)").filter(
        "value is not null"
    )


def few_distinct(df: DataFrame, columns: Sequence[str], by: Sequence[str], limit: int) -> bool:
    estimates = df.groupBy(*by).agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    largest = estimates.agg(*[F.max(c).alias(c) for c in columns]).first()
    return all((largest[c] or 0) <= limit for c in columns)


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    limit: int = DISTINCT_LIMIT,
) -> DataFrame:
    """Long result: (by..., variable, probability, quantile)."""
    if few_distinct(df, columns, by, limit):
        return _by_counters(df, columns, probabilities, by)
    return _by_position(df, columns, probabilities, by)


def _by_counters(df, columns, probabilities, by) -> DataFrame:
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    found = df.groupBy(*by).agg(*[F.percentile(F.col(c).cast("double"), wanted).alias(c) for c in columns])
    stacked = ", ".join(f"'{c}', `{c}`" for c in columns)
    pairs = F.explode(F.arrays_zip(wanted.alias("probability"), F.col("values").alias("quantile")))
    return (
        found.selectExpr(*[f"`{k}`" for k in by], f"stack({len(columns)}, {stacked}) as (variable, values)")
        .filter("values is not null")
        .select(*by, "variable", pairs.alias("_p"))
        .select(*by, "variable", "_p.probability", "_p.quantile")
    )


def _by_position(df, columns, probabilities, by) -> DataFrame:
    key = [*by, "variable"]
    counts = long_form(df, columns, by).groupBy(*key, "value").agg(F.count(F.lit(1)).alias("n"))
    placed = prefix_sums(counts, ["value"], "n", "below", key)
    sizes = counts.groupBy(*key).agg(F.sum("n").alias("total"))
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    ranks = (
        sizes.select(*key, "total", wanted.alias("probability"))
        .withColumn("_at", (F.col("total") - 1) * F.col("probability"))
        .select(*[F.col(k).alias(f"_k_{k}") for k in key], "probability", "_at")
    )
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    low, high = F.floor("_at"), F.ceil("_at")

    def holds(rank: Column) -> Column:
        return (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))

    # At most two of a group's values hold a wanted rank, so the grouping after the join is tiny.
    picked = placed.join(ranks, same & (holds(low) | holds(high)))
    at_low = F.max(F.when(holds(low), F.col("value")))
    at_high = F.max(F.when(holds(high), F.col("value")))
    share = F.max(F.col("_at") - low)
    return picked.groupBy(*key, "probability").agg((at_low + (at_high - at_low) * share).alias("quantile"))


def wide(long: DataFrame, names: dict[tuple[str, float], str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group, one named column per (variable, probability)."""
    picks = [
        F.max(F.when((F.col("variable") == v) & (F.col("probability") == float(p)), F.col("quantile"))).alias(name)
        for (v, p), name in names.items()
    ]
    return long.groupBy(*by).agg(*picks)


def thresholds(df: DataFrame, names: dict[tuple[str, float], str], limit: int = DISTINCT_LIMIT) -> DataFrame:
    """A single row of named global quantiles, found in one pass."""
    columns = list(dict.fromkeys(v for v, _ in names))
    probabilities = list(dict.fromkeys(float(p) for _, p in names))
    return wide(quantiles(df, columns, probabilities, limit=limit), names)
