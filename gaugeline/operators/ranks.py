"""Ranks over a whole data set, and statistics made of them, without a single-task sort.

Everything works on counts of distinct values (or value pairs): those are combined before the
shuffle, so a value that a third of all rows share becomes one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.association import ratio
from gaugeline.operators.frames import beside, prefix_sums
from gaugeline.session import written


def average_ranks(counts: DataFrame, value: str = "value", count: str = "n", group: Sequence[str] = ()) -> DataFrame:
    """Add ``rank``, the mean 1-based rank of the rows that share a value."""
    placed = prefix_sums(counts, [value], count, "_below", group)
    return placed.withColumn("rank", F.col("_below") + (F.col(count) + 1) / 2.0).drop("_below")


def value_ranks(df: DataFrame, column: str, group: Sequence[str] = ()) -> DataFrame:
    """(group..., value, n, rank) of the non-null values of ``column``."""
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*group, F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return average_ranks(counts, group=group)


def rank_sums(df: DataFrame, column: str, by: str) -> DataFrame:
    """Per sample ``by``: its size, its rank sum in the pooled data, and (the same on every
    row) the pooled size and tie term sum(t^3 - t)."""
    cells = written(
        df.filter(F.col(column).isNotNull() & F.col(by).isNotNull())
        .groupBy(F.col(column).alias("value"), F.col(by).alias("sample"))
        .agg(F.count(F.lit(1)).alias("c")),
        "cells",
    )
    ranked = average_ranks(cells.groupBy("value").agg(F.sum("c").alias("n")))
    t = F.col("n").cast("double")
    pooled = ranked.agg(F.sum("n").alias("total"), F.sum(t * t * t - t).alias("tie_term"))
    sums = (
        cells.join(ranked, "value")
        .groupBy("sample")
        .agg(F.sum("c").alias("size"), F.sum(F.col("c") * F.col("rank")).alias("rank_sum"))
    )
    return beside(sums, pooled)


# -- several pairs of columns at once ----------------------------------------------------------


def pair_cells(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(pair, x, y, c): counts of the distinct complete value pairs, ``pair`` being the place in
    ``pairs``. One pass over the data, written out because every statistic reads it repeatedly."""
    rows = ", ".join(f"{i}, cast(`{x}` as double), cast(`{y}` as double)" for i, (x, y) in enumerate(pairs))
    long = df.selectExpr(f"stack({len(pairs)}, {rows}) as (pair, x, y)").dropna()
    return written(long.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("c")), "cells")


def with_names(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Replace ``pair`` by variable_1 and variable_2."""

    def pick(place: int):
        return F.element_at(F.array(*[F.lit(p[place]) for p in pairs]), F.col("pair") + 1)

    return df.select(pick(0).alias("variable_1"), pick(1).alias("variable_2"), *[c for c in df.columns if c != "pair"])


def _axis_ranks(cells: DataFrame, axis: str) -> DataFrame:
    counts = cells.groupBy("pair", F.col(axis).alias("value")).agg(F.sum("c").alias("n"))
    ranked = average_ranks(counts, group=["pair"])
    return ranked.select("pair", F.col("value").alias(axis), F.col("rank").alias(f"rank_{axis}"))


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(variable_1, variable_2, n, rho): Pearson correlation of average ranks.

    A value that very many cells share makes a large join key; such a partition is split at run
    time, as the side of the ranks holds each value once.
    """
    cells = pair_cells(df, pairs)
    ranked = cells.join(_axis_ranks(cells, "x"), ["pair", "x"]).join(_axis_ranks(cells, "y"), ["pair", "y"])
    c, rx, ry = F.col("c"), F.col("rank_x"), F.col("rank_y")
    products = {"sx": rx, "sy": ry, "sxx": rx * rx, "syy": ry * ry, "sxy": rx * ry}
    sums = ranked.groupBy("pair").agg(
        F.sum("c").alias("n"), *[F.sum(c * product).alias(name) for name, product in products.items()]
    )
    spread = F.expr("sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))")
    rho = ratio(F.expr("n * sxy - sx * sy"), spread)
    return with_names(sums.select("pair", "n", rho.alias("rho")), pairs)


def concordant_pairs(cells: DataFrame) -> DataFrame:
    """(pair, concordant): how many pairs of rows are ordered the same way on x and on y.

    Distinct x values are numbered; two different numbers first differ at exactly one binary
    digit. For each digit, cells that agree on all higher digits form a block, and every cell
    with digit 1 is concordant with the block's digit-0 cells of smaller y: a prefix sum over y.
    The data grows by the number of digits (log2 of the distinct x), not by the pairs.
    """
    xs = cells.select("pair", "x").distinct().withColumn("_one", F.lit(1).cast("long"))
    numbered = prefix_sums(xs, ["x"], "_one", "ix", ["pair"]).select("pair", "x", "ix")
    top = numbered.agg(F.max("ix")).first()[0]
    digits = max(1, int(top or 0).bit_length())
    spread = (
        cells.join(numbered, ["pair", "x"])
        .withColumn("digit", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))))
        .selectExpr(
            "pair",
            "digit",
            "shiftright(ix, digit + 1) as block",
            "y",
            "if(shiftright(ix, digit) % 2 = 1, c, 0) as upper",
            "if(shiftright(ix, digit) % 2 = 0, c, 0) as lower",
        )
        .groupBy("pair", "digit", "block", "y")
        .agg(F.sum("upper").alias("upper"), F.sum("lower").alias("lower"))
    )
    placed = prefix_sums(spread, ["y"], "lower", "smaller", ["pair", "digit", "block"])
    return placed.groupBy("pair").agg(F.sum(F.col("upper").cast("decimal(19,0)") * F.col("smaller").cast("decimal(19,0)")).alias("concordant"))


def _tie_terms(cells: DataFrame, axis: str) -> DataFrame:
    totals = cells.groupBy("pair", axis).agg(F.sum("c").cast("double").alias("t"))
    return totals.groupBy("pair").agg(
        F.expr("sum(t * (t - 1) / 2)").alias(f"ties_{axis}"),
        F.expr("sum(t * (t - 1) * (t - 2))").alias(f"ties3_{axis}"),
        F.expr("sum(t * (t - 1) * (2 * t + 5))").alias(f"ties5_{axis}"),
    )


def kendall(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(variable_1, variable_2, n, tau, z): tau-b and the tie-corrected normal score of
    concordant minus discordant pairs."""
    cells = pair_cells(df, pairs)
    row = cells.groupBy("pair").agg(
        F.sum("c").alias("rows"), F.expr("sum(cast(c as double) * (c - 1) / 2)").alias("ties_xy")
    )
    for part in (_tie_terms(cells, "x"), _tie_terms(cells, "y"), concordant_pairs(cells)):
        row = row.join(part, "pair")  # a row per pair of columns
    scored = (
        row.withColumn("n", F.col("rows").cast("double"))
        .withColumn("m", F.expr("n * (n - 1)"))
        .withColumn("balance", F.expr("2D * concordant - (m / 2 - ties_x - ties_y + ties_xy)"))
    )
    tau = F.expr("balance / sqrt((m / 2 - ties_x) * (m / 2 - ties_y))")
    variance = (
        "(m * (2 * n + 5) - ties5_x - ties5_y) / 18 + 2 * ties_x * ties_y / m + ties3_x * ties3_y / (9 * m * (n - 2))"
    )
    z = F.expr(f"balance / sqrt({variance})")
    return with_names(scored.select("pair", F.col("rows").alias("n"), tau.alias("tau"), z.alias("z")), pairs)
