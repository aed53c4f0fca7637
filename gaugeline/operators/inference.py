"""Hypothesis tests and intervals. The statistic of each test is a Spark aggregate that ends in
a row per test or per group; its p-value is a function of that row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import cdf, labels
from gaugeline.functions.association import correlation
from gaugeline.functions.normal import normal_quantile, polynomial
from gaugeline.operators import ranks
from gaugeline.operators.dimensions import join_dimension
from gaugeline.operators.frames import beside, with_positions
from gaugeline.operators.quantiles import long_form, quantiles
from gaugeline.session import written


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- normality ---------------------------------------------------------------------------------


def dagostino(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """D'Agostino-Pearson K^2 per column: (variable, n, skew, kurt, k2, p_value)."""
    row = long_form(df, columns).groupBy("variable").agg(
        F.count("value").cast("double").alias("n"),
        F.skewness("value").alias("skew"),
        F.kurtosis("value").alias("kurt"),
    )
    n = F.col("n")
    # skewness score
    y = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2.0 * (beta2 - 1)) - 1.0
    delta = 1.0 / F.sqrt(0.5 * F.log(w2))
    scaled = y / F.sqrt(2.0 / (w2 - 1.0))
    z_skew = delta * F.log(scaled + F.sqrt(scaled * scaled + 1.0))
    # kurtosis score, on the non-excess kurtosis
    centre = 3.0 * (n - 1) / (n + 1)
    variance = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("kurt") + 3.0 - centre) / F.sqrt(variance)
    root_beta = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / root_beta * (2.0 / root_beta + F.sqrt(1.0 + 4.0 / (root_beta * root_beta)))
    denominator = 1.0 + x * F.sqrt(2.0 / (a - 4.0))
    cube = F.signum(denominator) * F.pow((1.0 - 2.0 / a) / F.abs(denominator), F.lit(1.0 / 3.0))
    z_kurt = (1.0 - 2.0 / (9.0 * a) - cube) / F.sqrt(2.0 / (9.0 * a))
    k2 = z_skew * z_skew + z_kurt * z_kurt
    return row.select("variable", F.col("n").cast("long").alias("n"), "skew", "kurt", k2.alias("k2")).withColumn(
        "p_value", F.exp(-F.col("k2") / 2.0)
    )


def shapiro(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Shapiro-Wilk per column over all values: (variable, n, w, p_value).

    W is the squared correlation of the ordered values with Royston's weights, which follow from the
    rank alone, so it needs positions and a few sums. The p-value is Royston's approximation, checked
    by him up to 5000 values; beyond, the same formula is an extrapolation. Fewer than 3 values, or
    equal ones, give W and p_value NULL.
    """
    long = long_form(df, columns, key)
    placed = with_positions(long, ["value", *key], "i", ["variable"])
    sizes = long.groupBy("variable").agg(F.count("value").cast("double").alias("n"), F.avg("value").alias("mean"))
    # One row a variable: small whatever the data.
    scored = placed.join(F.broadcast(sizes), "variable").withColumn("m", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)))
    at = lambda i, c: F.max(F.when(F.col("i") == i, F.col(c)))
    n = F.col("n")
    sums = scored.groupBy("variable", "n").agg(
        F.sum(F.col("m") * F.col("value")).alias("mx"), F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.sum((F.col("value") - F.col("mean")) ** 2).alias("ss"),
        at(1, "value").alias("x1"), at(2, "value").alias("x2"), at(n - 1, "value").alias("y2"), at(n, "value").alias("y1"),
        at(n - 1, "m").alias("m2"), at(n, "m").alias("m1"),
    )
    m1, m2, mm, u = F.col("m1"), F.col("m2"), F.col("mm"), 1.0 / F.sqrt(n)
    # Royston's (1995) correction polynomials for the extreme weights, and those for
    # the mean and spread of the transformed W.
    last = m1 / F.sqrt(mm) + polynomial((0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056), u)
    second = m2 / F.sqrt(mm) + polynomial((0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633), u)
    log_n = F.log(n)
    small = n <= 11
    mu = F.when(small, polynomial((0.5440, -0.39978, 0.025054, -0.0006714), n)).otherwise(
        polynomial((-1.5861, -0.31082, -0.083751, 0.0038915), log_n)
    )
    sigma = F.exp(
        F.when(small, polynomial((1.3822, -0.77857, 0.062767, -0.0020322), n)).otherwise(
            polynomial((-0.4803, -0.082676, 0.0030302), log_n)
        )
    )
    two = n > 5  # with up to five values only the outermost weight is corrected
    phi = F.when(two, (mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * last * last - 2 * second * second)).otherwise(
        (mm - 2 * m1 * m1) / (1 - 2 * last * last)
    )
    outer, inner = F.col("y1") - F.col("x1"), F.col("y2") - F.col("x2")
    middle = (F.col("mx") - m1 * outer - F.when(two, m2 * inner).otherwise(0.0)) / F.sqrt(phi)
    top = middle + last * outer + F.when(two, second * inner).otherwise(0.0)
    top = F.when(n == 3, F.sqrt(F.lit(0.5)) * outer).otherwise(top)
    w = F.when((n >= 3) & (outer > 0), F.least(top * top / F.col("ss"), F.lit(1.0)))
    y = F.log(F.greatest(1.0 - F.col("w"), F.lit(1e-300)))
    gap = 0.459 * n - 2.273 - y
    z = (F.when(small, -F.log(F.greatest(gap, F.lit(1e-300)))).otherwise(y) - mu) / sigma
    both = sums.withColumn("w", w).withColumn("z", z).withColumn("tails", cdf.p_normal("z"))
    p = F.when(F.col("z") >= 0, F.col("tails") / 2).otherwise(1.0 - F.col("tails") / 2)
    exact = 6.0 / F.pi() * (F.asin(F.sqrt("w")) - F.asin(F.sqrt(F.lit(0.75))))
    p = F.when(n == 3, F.greatest(exact, F.lit(0.0))).when(small & (gap <= 0), 1e-99).otherwise(p)
    p = F.when(F.col("w").isNotNull(), p)
    return both.select("variable", n.cast("long").alias("n"), "w", p.alias("p_value"))


def qq_points(df: DataFrame, column: str, key: Sequence[str]) -> DataFrame:
    """Theoretical and ordered sample quantiles: (position, theoretical, ordered). Plotting
    positions are Filliben's order-statistic medians."""
    values = df.filter(F.col(column).isNotNull()).select(*key, F.col(column).cast("double").alias("ordered"))
    placed = with_positions(values, ["ordered", *key], "position")
    sized = beside(placed, values.agg(F.count(F.lit(1)).cast("double").alias("n")))
    n, i = F.col("n"), F.col("position")
    edge = F.pow(F.lit(0.5), 1.0 / n)
    median = F.when(i == n, edge).when(i == 1, 1.0 - edge).otherwise((i - 0.3175) / (n + 0.365))
    return sized.select("position", normal_quantile(median).alias("theoretical"), "ordered")


def qq_line(points: DataFrame) -> DataFrame:
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        correlation("ordered", "theoretical").alias("r"),
    )


# -- group comparisons -------------------------------------------------------------------------


def group_moments(df: DataFrame, value: str, by: str) -> DataFrame:
    """(sample, n, mean, variance) of the non-null values per group."""
    return (
        df.filter(F.col(value).isNotNull() & F.col(by).isNotNull())
        .groupBy(F.col(by).alias("sample"))
        .agg(F.count(value).cast("double").alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"))
    )


def _anova_from(moments: DataFrame) -> DataFrame:
    # A group of one row has no sample variance but also no spread.
    within = F.coalesce(F.col("variance"), F.lit(0.0)) * (F.col("n") - 1)
    grand = moments.agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).cast("double").alias("groups"),
        F.sum(F.col("n") * F.col("mean")).alias("_s"),
        F.sum(within).alias("_within"),
    )
    between = beside(moments, grand.select((F.col("_s") / F.col("total")).alias("_grand"))).agg(
        F.sum(F.col("n") * (F.col("mean") - F.col("_grand")) ** 2).alias("_between")
    )
    d1, d2 = F.col("groups") - 1, F.col("total") - F.col("groups")
    return beside(grand, between).select(
        ((F.col("_between") / d1) / (F.col("_within") / d2)).alias("f"),
        d1.alias("df_between"),
        d2.alias("df_within"),
    )


def anova(df: DataFrame, value: str, by: str) -> DataFrame:
    """One row: f, degrees of freedom, p_value."""
    return _anova_from(group_moments(df, value, by)).withColumn("p_value", cdf.p_f("f", "df_between", "df_within"))


def deviations_from_median(df: DataFrame, value: str, by: str) -> DataFrame:
    medians = quantiles(df.filter(F.col(by).isNotNull()), [value], [0.5], [by]).select(by, F.col("quantile").alias("_m"))
    joined = join_dimension(df.filter(F.col(value).isNotNull()), medians, by, "inner")
    return joined.select(by, F.abs(F.col(value) - F.col("_m")).alias("deviation"))


def levene(df: DataFrame, value: str, by: str) -> DataFrame:
    """Median-centred Levene test: one row with statistic w and p_value."""
    spread = deviations_from_median(df, value, by)
    return anova(spread, "deviation", by).withColumnRenamed("f", "w")


def _pair(moments: DataFrame, first: str, second: str) -> DataFrame:
    """The two samples' moments on one row, suffixed 1 and 2."""
    picks = [
        F.max(F.when(F.col("sample") == name, F.col(c))).alias(f"{c}{i}")
        for i, name in ((1, first), (2, second))
        for c in ("n", "mean", "variance")
    ]
    return moments.agg(*picks)


def t_test(df: DataFrame, value: str, by: str, first: str, second: str, alpha: float = 0.05) -> DataFrame:
    """Independent two-sample t test: pooled when Levene's p exceeds ``alpha``, else Welch."""
    two = df.filter(F.col(by).isin(first, second))
    row = beside(
        _pair(group_moments(two, value, by), first, second),
        levene(two, value, by).select(F.col("p_value").alias("levene_p")),
    )
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "variance1", "variance2"))
    equal = F.col("levene_p") > alpha
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    e1, e2 = v1 / n1, v2 / n2
    error = F.when(equal, F.sqrt(pooled * (1 / n1 + 1 / n2))).otherwise(F.sqrt(e1 + e2))
    freedom = F.when(equal, n1 + n2 - 2).otherwise((e1 + e2) ** 2 / (e1**2 / (n1 - 1) + e2**2 / (n2 - 1)))
    return (
        row.withColumns({"t": (F.col("mean1") - F.col("mean2")) / error, "df": freedom, "equal_variances": labels.yes_no(equal)})
        .withColumn("p_value", cdf.p_t("t", "df"))
        .select("t", "df", "levene_p", "equal_variances", "p_value")
    )


def cohens_d(df: DataFrame, value: str, by: str, first: str, second: str) -> DataFrame:
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "variance1", "variance2"))
    pooled = F.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2))
    row = _pair(group_moments(df, value, by), first, second)
    return row.select(((F.col("mean1") - F.col("mean2")) / pooled).alias("d")).withColumn("effect", labels.effect_size("d"))


def mann_whitney(df: DataFrame, value: str, by: str, first: str, second: str) -> DataFrame:
    """Two-sided U test, normal approximation with tie and continuity correction."""
    sums = ranks.rank_sums(df.filter(F.col(by).isin(first, second)), value, by)

    def of(name: str, column: str) -> Column:
        return F.max(F.when(F.col("sample") == name, F.col(column)))

    row = sums.agg(
        of(first, "size").cast("double").alias("n1"),
        of(second, "size").cast("double").alias("n2"),
        of(first, "rank_sum").alias("r1"),
        F.max("tie_term").alias("ties"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + 1) / 2.0
    larger = F.greatest(u1, n1 * n2 - u1)
    sd = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = (larger - n1 * n2 / 2.0 - 0.5) / sd
    return row.select(u1.alias("u"), z.alias("z")).withColumn("p_value", F.least(F.lit(1.0), cdf.p_normal(F.greatest(F.col("z"), F.lit(0.0)))))


def kruskal(df: DataFrame, value: str, by: str) -> DataFrame:
    """Tie-corrected H over any number of groups."""
    row = ranks.rank_sums(df, value, by).agg(
        F.sum(F.col("rank_sum") * F.col("rank_sum") / F.col("size")).alias("_s"),
        F.count(F.lit(1)).cast("double").alias("_groups"),
        F.max("total").cast("double").alias("_n"),
        F.max("tie_term").alias("_t"),
    )
    n = F.col("_n")
    raw = 12.0 / (n * (n + 1)) * F.col("_s") - 3.0 * (n + 1)
    h = raw / (1.0 - F.col("_t") / (n * n * n - n))
    return row.select(h.alias("h"), (F.col("_groups") - 1).alias("df")).withColumn("p_value", cdf.p_chi2("h", "df"))


def tukey_hsd(df: DataFrame, value: str, by: str, alpha: float = 0.05, max_groups: int = 200) -> DataFrame:
    """All pairs of groups: (group1, group2, mean_diff, lower, upper, p_adj, reject), the
    difference being second minus first. The pairs are the result itself; they are formed from
    one row of moments per group; more than ``max_groups`` groups are an error."""
    moments = written(group_moments(df, value, by), "moments")
    pooled = moments.agg(
        (F.sum(F.coalesce(F.col("variance"), F.lit(0.0)) * (F.col("n") - 1)) / (F.sum("n") - F.count(F.lit(1)))).alias("mse"),
        (F.sum("n") - F.count(F.lit(1))).alias("df"),
        F.count(F.lit(1)).cast("double").alias("k"),
    )
    if moments.limit(max_groups + 1).count() > max_groups:
        raise ValueError(f"more than {max_groups} groups of {by}")
    one = moments.select(F.col("sample").alias("group1"), F.col("n").alias("na"), F.col("mean").alias("ma"))
    two = moments.select(F.col("sample").alias("group2"), F.col("n").alias("nb"), F.col("mean").alias("mb"))
    pairs = beside(one.join(two, F.col("group1") < F.col("group2")), pooled)
    difference = F.col("mb") - F.col("ma")
    error = F.sqrt(F.col("mse") / 2.0 * (1.0 / F.col("na") + 1.0 / F.col("nb")))
    critical = beside(moments.limit(1).select(F.lit(1 - alpha).alias("level")), pooled).select(
        cdf.studentized_range_critical("level", "k", "df").alias("q")
    )
    return (
        beside(pairs, critical)
        .withColumns({"mean_diff": difference, "_se": error})
        .withColumn("p_adj", cdf.p_studentized_range(F.abs(F.col("mean_diff") / F.col("_se")), F.col("k"), F.col("df")))
        .select(
            "group1",
            "group2",
            "mean_diff",
            (F.col("mean_diff") - F.col("q") * F.col("_se")).alias("lower"),
            (F.col("mean_diff") + F.col("q") * F.col("_se")).alias("upper"),
            "p_adj",
            labels.significant("p_adj", alpha).alias("reject"),
        )
    )


def proportion_test(df: DataFrame, event: Column, by: str, first: str, second: str) -> DataFrame:
    """Pooled two-proportion z test: (x1, n1, x2, n2, z, p_value)."""

    def of(name: str, column: Column) -> Column:
        return F.sum(F.when(F.col(by) == name, column).otherwise(0))

    hit = F.coalesce(event, F.lit(False)).cast("long")
    row = df.agg(
        of(first, hit).alias("x1"), of(first, F.lit(1).cast("long")).alias("n1"),
        of(second, hit).alias("x2"), of(second, F.lit(1).cast("long")).alias("n2"),
    )
    x1, n1, x2, n2 = (F.col(c).cast("double") for c in ("x1", "n1", "x2", "n2"))
    p = (x1 + x2) / (n1 + n2)
    z = (x1 / n1 - x2 / n2) / F.sqrt(p * (1 - p) * (1 / n1 + 1 / n2))
    return row.withColumn("z", z).withColumn("p_value", cdf.p_normal("z"))


# -- association -------------------------------------------------------------------------------


def pearson(df: DataFrame, pairs: Sequence[tuple[str, str]], alpha: float = 0.05) -> DataFrame:
    """All pairs in one pass: (variable_1, variable_2, n, r, p_value, significant, strength)."""
    aggregates, cells = [], []
    for i, (x, y) in enumerate(pairs):
        aggregates += [correlation(x, y).alias(f"r{i}"), F.regr_count(x, y).alias(f"n{i}")]
        cells.append(f"'{x}', '{y}', n{i}, r{i}")
    long = df.agg(*aggregates).selectExpr(f"stack({len(pairs)}, {', '.join(cells)}) as (variable_1, variable_2, n, r)")
    return with_t_probability(long, "r").withColumns(
        {"significant": labels.significant("p_value", alpha), "strength": labels.strength("r")}
    )


def with_t_probability(df: DataFrame, r: str, n: str = "n") -> DataFrame:
    freedom = F.col(n).cast("double") - 2
    # A perfect correlation has no finite t; the floor keeps its p-value at zero.
    t = F.col(r) * F.sqrt(freedom / F.greatest(1.0 - F.col(r) * F.col(r), F.lit(1e-300)))
    return df.withColumn("p_value", cdf.p_t(t, freedom))


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return with_t_probability(ranks.spearman(df, pairs), "rho")


def kendall(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return ranks.kendall(df, pairs).withColumn("p_value", cdf.p_normal("z"))


def _margins(df: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Cells, row sums, column sums and total of a contingency table, from one aggregate over grouping sets."""
    rows = df.select(a, b).dropna()
    sets = rows.groupingSets([[a, b], [a], [b], []], a, b)
    found = written(sets.agg(F.count(F.lit(1)).alias("observed"), F.grouping_id().alias("_set")), "margins")
    cells = found.filter("_set = 0").drop("_set")
    row_sums = found.filter("_set = 1").select(a, F.col("observed").alias("_row"))
    column_sums = found.filter("_set = 2").select(b, F.col("observed").alias("_column"))
    return cells, row_sums, column_sums, found.filter("_set = 3").select(F.col("observed").alias("_n"))


def chi_square(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """Independence of two columns: one row (chi2, dof, p_value).

    Only the combinations that occur are visited: the empty ones enter through
    sum(E) = n. In a 2x2 table every |O - E| is the same number, which the continuity
    correction shrinks by up to one half.
    """
    cells, rows, columns, _ = _margins(df, a, b)
    inverse = F.sum(1.0 / F.col("_x"))
    row_side = rows.withColumnRenamed("_row", "_x").agg(
        F.count(F.lit(1)).alias("_rows"), inverse.alias("_inv_r"), F.sum("_x").cast("double").alias("_n")
    )
    column_side = columns.withColumnRenamed("_column", "_x").agg(
        F.count(F.lit(1)).alias("_columns"), inverse.alias("_inv_c")
    )
    product = F.col("_row").cast("double") * F.col("_column")
    joined = beside(cells.join(rows, a).join(columns, b), row_side.select("_n"))
    sums = joined.agg(
        F.sum(F.col("observed") * F.col("observed") / product).alias("_share"),
        F.max(F.abs(F.col("observed") - product / F.col("_n"))).alias("_gap"),
    )
    row = beside(sums, row_side, column_side)
    n, gap = F.col("_n"), F.col("_gap") - F.least(F.lit(0.5), F.col("_gap"))
    dof = (F.col("_rows") - 1) * (F.col("_columns") - 1)
    plain = n * (F.col("_share") - 1.0)
    corrected = gap * gap * n * F.col("_inv_r") * F.col("_inv_c")
    square = (F.col("_rows") == 2) & (F.col("_columns") == 2) & F.lit(correction)
    return row.select(F.when(square, corrected).otherwise(plain).alias("chi2"), dof.alias("dof")).withColumn(
        "p_value", F.when(F.col("dof") == 0, 1.0).otherwise(cdf.p_chi2("chi2", "dof"))
    )


def expected_counts(df: DataFrame, a: str, b: str, max_levels: int = 1000) -> DataFrame:
    """(a, b, observed, expected) for every combination of the levels seen. The full table is the result,
    so more than ``max_levels`` levels of a column are an error."""
    cells, rows, columns, total = _margins(df, a, b)
    levels = [r[b] for r in columns.orderBy(b).limit(max_levels + 1).collect()]
    if len(levels) > max_levels or rows.limit(max_levels + 1).count() > max_levels:
        raise ValueError(f"more than {max_levels} levels of {a} or {b}")
    if not levels:
        return rows.select(a, F.lit(None).alias(b), F.col("_row").alias("observed"), F.lit(0.0).alias("expected")).limit(0)
    kind = columns.schema[b].dataType
    grid = beside(rows, total).withColumn(b, F.explode(F.array(*[F.lit(x).cast(kind) for x in levels])))
    return join_dimension(join_dimension(grid, columns, b, "inner"), cells, [a, b]).select(
        a,
        b,
        F.coalesce("observed", F.lit(0)).alias("observed"),
        (F.col("_row") * F.col("_column") / F.col("_n")).alias("expected"),
    )


# -- intervals and descriptions ----------------------------------------------------------------


def confidence_intervals(df: DataFrame, columns: Sequence[str], by: str, level: float = 0.95) -> DataFrame:
    """(by, variable, n, mean, lower, upper), t intervals of the mean."""
    row = long_form(df, columns, [by]).groupBy(by, "variable").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("_sd")
    )
    margin = F.col("_sd") / F.sqrt(F.col("n")) * F.col("_q")
    return row.withColumn("_q", cdf.t_critical(F.lit((1 + level) / 2), F.col("n") - 1)).select(
        by, "variable", "n", "mean", (F.col("mean") - margin).alias("lower"), (F.col("mean") + margin).alias("upper")
    )


def group_descriptions(df: DataFrame, value: str, by: str) -> DataFrame:
    """(by, n, mean, median, sd, mean_minus_sd, mean_plus_sd)."""
    moments = df.filter(F.col(value).isNotNull()).groupBy(by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )
    medians = quantiles(df, [value], [0.5], [by]).select(by, F.col("quantile").alias("median"))
    return moments.join(medians, by).select(
        by, "n", "mean", "median", "sd",
        (F.col("mean") - F.col("sd")).alias("mean_minus_sd"),
        (F.col("mean") + F.col("sd")).alias("mean_plus_sd"),
    )
