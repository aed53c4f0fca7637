"""Row-based window frames that stay parallel when one group is very large.

A window partition is one task. Groups are normally small (a site-day holds 24 hourly rows, a
site's daily series one row per calendar day), and then a plain window is the best plan. When a
group can exceed ``limit`` rows, rows get their exact position by a distributed prefix sum, the
series is cut into blocks of consecutive positions, and each block also receives the few rows
before and after it that its frames can reach. Frames count rows, so the result is identical.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.session import written

BLOCK_ROWS = 100_000


def beside(df: DataFrame, *rows: DataFrame) -> DataFrame:
    """Add the columns of one-row frames to every row of ``df``, as scalar subqueries: each is
    evaluated once and its values become constants, with no join."""
    for i, row in enumerate(rows):
        name = f"_scalar_{i}"
        value = row.select(F.struct(*row.columns).alias("r")).scalar()
        df = df.withColumn(name, value)
        df = df.withColumns({c: F.col(f"{name}.{c}") for c in row.columns}).drop(name)
    return df


def has_large_group(df: DataFrame, group: Sequence[str], limit: int) -> bool:
    """Reads only the group columns; counts are combined before the shuffle."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
    return not sizes.filter(F.col("_rows") > limit).isEmpty()


def prefix_sums(
    df: DataFrame,
    order: Sequence[str],
    weight: str,
    into: str = "before",
    group: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add ``into``: the total ``weight`` of the rows ordered before each row in its group.

    Rows are range-partitioned on (group, order), so a group of any size, or no group at all, is
    spread over all tasks; only per-partition totals are summed in sequence. ``order`` should be
    unique within a group.
    """
    # Without a number, small neighbouring ranges are merged at run time; their order stays.
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *group, *order)
    # Partition ids must not change between the two uses below, hence the written table.
    staged = written(ranged.withColumn("_part", F.spark_partition_id()), "prefix")
    totals = staged.groupBy(*group, "_part").agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A range partition has at most one group that began before it, so the offsets that differ
    # from zero are at most one per partition: small enough to broadcast at any data size.
    offsets = (
        totals.withColumn("_offset", F.sum("_total").over(earlier))
        .filter("_offset > 0")
        .select(*[F.col(c).alias(f"_o_{c}") for c in group], F.col("_part").alias("_o_part"), "_offset")
    )
    same = F.col("_part") == F.col("_o_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    inner = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return (
        staged.withColumn("_inner", F.coalesce(F.sum(weight).over(inner), zero))
        .join(F.broadcast(offsets), same, "left")
        .withColumn(into, F.col("_inner") + F.coalesce(F.col("_offset"), zero))
        .select(*df.columns, into)
    )


def with_positions(df: DataFrame, order: Sequence[str], into: str = "position", group: Sequence[str] = ()) -> DataFrame:
    """Add the 1-based row number within ``group``, without a single-task sort.

    Rows equal on ``order`` are kept apart by an id of their place in the input, so even a run
    of identical keys can be split.
    """
    tagged = df.withColumn("_one", F.lit(1).cast("long")).withColumn("_row", F.monotonically_increasing_id())
    numbered = prefix_sums(tagged, [*order, "_row"], "_one", "_before", group)
    return numbered.withColumn(into, F.col("_before") + 1).select(*df.columns, into)


def over_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    build: Callable[[WindowSpec], dict[str, Column]],
    before: int,
    after: int = 0,
    limit: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the columns ``build(window)`` returns; their frames reach at most ``before`` rows
    back and ``after`` rows ahead. ``limit=None`` states that groups are known to be small; with a
    number, groups are counted, and if one is larger all are cut into blocks. The values are the same."""
    if limit is None or not has_large_group(df, group, limit):
        return df.withColumns(build(Window.partitionBy(*group).orderBy(*order)))
    return _over_blocks(df, group, order, build, before, after, block_rows)


def _over_blocks(df, group, order, build, before, after, block_rows) -> DataFrame:
    size = max(block_rows, before, after)
    placed = with_positions(df, order, "_pos", group).withColumn("_index", F.col("_pos") - 1)
    place = F.col("_index") % size
    own = F.floor(F.col("_index") / size)
    # The first rows of a block are also what the block before looks ahead to, and the last
    # rows what the block after looks back on.
    targets = F.array_compact(
        F.array(own, F.when((place < after) & (own > 0), own - 1), F.when(place >= size - before, own + 1))
    )
    spread = placed.withColumn("_own", own).withColumn("_block", F.explode(targets))
    window = Window.partitionBy(*group, "_block").orderBy("_index")
    columns = build(window)
    return (
        spread.withColumns(columns)
        .filter(F.col("_block") == F.col("_own"))
        .select(*[c for c in df.columns if c not in columns], *columns)
    )
