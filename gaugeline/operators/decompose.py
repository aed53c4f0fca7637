"""Additive seasonal decomposition of daily series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.operators import frames
from gaugeline.operators.dimensions import join_dimension
from gaugeline.schema import SeriesSpec
from gaugeline.session import written


def seasonal_decompose(
    df: DataFrame,
    value: str,
    period: int = 365,
    spec: SeriesSpec = SeriesSpec(time="date"),
    limit: int | None = None,
    block_rows: int = frames.BLOCK_ROWS,
) -> DataFrame:
    """(entity, time, observed, trend, seasonal, resid) per row.

    The trend is a centred moving mean over one period (half weights at both ends when the
    period is even), NULL where the frame is incomplete. The seasonal part is the mean detrended
    value of each phase, shifted so that the phases average to zero. An entity shorter than two
    periods keeps its rows with NULL components. A daily series holds one row per calendar day, so a window partition
    per entity is bounded; pass ``limit`` for series of finer grain.
    """
    key, order = [spec.entity], list(spec.order)
    half = period // 2
    series = df.select(*key, *order, F.col(value).cast("double").alias("observed")).dropna(subset=["observed"])
    sizes = series.groupBy(*key).agg((F.count(F.lit(1)) >= 2 * period).alias("_long"))
    long_enough = join_dimension(series, sizes, key, "inner")

    def build(window: WindowSpec) -> dict[str, Column]:
        frame = window.rowsBetween(-half, half)
        total = F.sum("observed").over(frame)
        if period % 2 == 0:
            total = total - (F.lag("observed", half).over(window) + F.lead("observed", half).over(window)) / 2.0
        full = (F.count("observed").over(frame) == 2 * half + 1) & F.col("_long")
        return {"trend": F.when(full, total / period)}

    phase = ((F.col("_place") - 1) % period).alias("phase")
    if limit is None or not frames.has_large_group(series, key, limit):
        # One partition for each entity serves all windows.
        ordered, whole = Window.partitionBy(*key).orderBy(*order), Window.partitionBy(*key)
        placed = long_enough.withColumns({**build(ordered), "_place": F.row_number().over(ordered)}).withColumn("phase", phase)
        same = Window.partitionBy(*key, "phase")
        means = placed.withColumns({"_mean": F.avg(F.col("observed") - F.col("trend")).over(same), "_n": F.count(F.lit(1)).over(same)})
        share = F.when(F.col("_mean").isNotNull(), 1.0 / F.col("_n"))  # the rows of a phase count as one
        level = F.sum(F.col("_mean") * share).over(whole) / F.sum(share).over(whole)
        joined = means.withColumn("seasonal", F.col("_mean") - level)
    else:
        numbered = frames.with_positions(long_enough, order, "_place", key)
        placed = frames.over_rows(numbered, key, ["_place"], build, half, half, limit, block_rows)
        placed = written(placed.withColumn("phase", phase), "trend")  # read twice, computed once
        # phases: at most `period` rows per entity
        phases = placed.groupBy(*key, "phase").agg(F.avg(F.col("observed") - F.col("trend")).alias("_mean"))
        centred = phases.withColumn("seasonal", F.col("_mean") - F.avg("_mean").over(Window.partitionBy(*key))).drop("_mean")
        joined = join_dimension(placed, centred, [*key, "phase"], "inner")
    return joined.select(
        *key,
        spec.time,
        "observed",
        "trend",
        "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )
