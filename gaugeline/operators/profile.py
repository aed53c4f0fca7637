"""Profiling and exploratory aggregates over readings and daily marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.functions.association import correlation
from gaugeline.operators.dimensions import join_dimension
from gaugeline.operators.frames import beside, prefix_sums, with_positions
from gaugeline.operators.quantiles import DISTINCT_LIMIT, quantiles, thresholds, wide
from gaugeline.schema import MEASURES

MOMENTS = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}


def grouped(df: DataFrame, by: Sequence[str], wanted: dict[str, Sequence[str]]) -> DataFrame:
    """``wanted`` maps a column to statistics; results are named ``column_statistic``."""
    return df.groupBy(*by).agg(
        *[MOMENTS[stat](column).alias(f"{column}_{stat}") for column, stats in wanted.items() for stat in stats]
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def value_counts_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts for several columns in one pass: (attribute, value, n)."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) as (attribute, value)").filter("value is not null")
    return long.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("n"))


def load_summary(df: DataFrame, entity: str = "location_name", time: str = "datetime") -> DataFrame:
    """Totals of a load. The distinct counts go through per-(site, hour) groups so that no
    distinct set is ever gathered in one place."""
    cells = df.groupBy(entity, F.date_trunc("hour", time).alias("_hour")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(time).alias("_a"), F.max(time).alias("_b")
    )
    sites = cells.groupBy(entity).agg(F.sum("_n").alias("_n"), F.min("_a").alias("_a"), F.max("_b").alias("_b"))
    days = cells.select(F.to_date("_hour").alias("d")).distinct().agg(F.count(F.lit(1)).alias("unique_days"))
    hours = cells.select("_hour").distinct().agg(F.count(F.lit(1)).alias("unique_hours"))
    totals = sites.agg(
        F.sum("_n").alias("total_records"),
        F.count(entity).alias("locations"),
        F.min("_a").alias("first_time"),
        F.max("_b").alias("last_time"),
    )
    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("first_time", "last_time"))
    return beside(totals, days, hours).withColumn("span_days", F.floor((last - first) / 86_400_000_000))


def load_by_site(df: DataFrame, entity: str = "location_name", time: str = "datetime") -> DataFrame:
    return df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("records"),
        F.to_date(F.min(time)).alias("first_date"),
        F.to_date(F.max(time)).alias("last_date"),
    )


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls, null_pct), one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr("_n", f"stack({len(columns)}, {pairs}) as (column_name, nulls)").select(
        "column_name", "nulls", (F.col("nulls") * 100.0 / F.col("_n")).alias("null_pct")
    )


def extract_profile(df: DataFrame, expected_sites: int, hours: int = 24, entity: str = "location_name", day: str = "date") -> DataFrame:
    """Per day: rows received against sites x hours expected."""
    per_day = df.groupBy(day, entity).agg(F.count(F.lit(1)).alias("_n")).groupBy(day).agg(
        F.sum("_n").alias("records"), F.count(F.lit(1)).alias("sites")
    )
    expected = F.lit(expected_sites * hours)
    return per_day.withColumns({"expected": expected, "is_complete": (F.col("records") >= expected).cast("int")})


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total nulls, their share of all cells, and surplus copies of whole rows."""
    rows = df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    nulls = sum((F.col(c).isNull().cast("long") for c in columns[1:]), F.col(columns[0]).isNull().cast("long"))
    return rows.agg(
        F.sum("_n").alias("total_records"),
        F.sum(nulls * F.col("_n")).alias("missing_values"),
        (F.sum("_n") - F.count(F.lit(1))).alias("duplicate_records"),
    ).withColumn("missing_pct", F.col("missing_values") * 100.0 / (F.col("total_records") * len(columns)))


def mean_of_daily_totals(df: DataFrame, value: str = "precipitation", day: str = "date") -> DataFrame:
    daily = df.groupBy(day).agg(F.sum(value).alias("_total"))
    return daily.agg(
        F.avg("_total").alias("average_daily"),
        F.sum((F.col("_total") > 0).cast("long")).alias("days_with_rain"),
    )


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), limit: int = DISTINCT_LIMIT) -> DataFrame:
    """(by..., variable, count, mean, std, min, p25, p50, p75, max), exact quartiles."""
    moments = df.groupBy(*by).agg(
        *[f(c).alias(f"{c}_{s}") for c in columns for s, f in MOMENTS.items() if s != "sum"]
    )
    stats = ("count", "mean", "std", "min", "max")
    stacked = ", ".join(
        f"'{c}', " + ", ".join(f"cast(`{c}_{s}` as {'bigint' if s == 'count' else 'double'})" for s in stats)
        for c in columns
    )
    long = moments.selectExpr(*[f"`{k}`" for k in by], f"stack({len(columns)}, {stacked}) as (variable, {', '.join(stats)})")
    quartiles = quantiles(df, columns, (0.25, 0.5, 0.75), by, limit)
    key = [*by, "variable"]
    picks = [
        F.max(F.when(F.col("probability") == p, F.col("quantile"))).alias(name)
        for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
    ]
    return long.join(quartiles.groupBy(*key).agg(*picks), key, "left").select(
        *key, "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def describe_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(attribute, count, unique, top, freq); ties on freq go to the first name."""
    counts = value_counts_of(df, columns)
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value").alias("v")))
    return (
        counts.groupBy("attribute")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("b"))
        .select("attribute", "count", "unique", F.col("b.v").alias("top"), (-F.col("b.m")).alias("freq"))
    )


def pivot_sum(df: DataFrame, rows: str, columns: str, value: str, names: Sequence) -> DataFrame:
    """``names`` are the values of ``columns`` to spread; giving them avoids a second pass."""
    return df.groupBy(rows).pivot(columns, list(names)).sum(value)


def pivot_mean(df: DataFrame, rows: str, columns: str, value: str, names: Sequence) -> DataFrame:
    return df.groupBy(rows).pivot(columns, list(names)).avg(value)


def count_where(df: DataFrame, condition: Column, by: Sequence[str], name: str = "n") -> DataFrame:
    """Groups without a matching row are absent."""
    return df.filter(condition).groupBy(*by).agg(F.count(F.lit(1)).alias(name))


# Thresholds of extreme days as (measure, quantile).
EXTREMES = {
    ("max_temperature", 0.95): "temp_high",
    ("min_temperature", 0.05): "temp_low",
    ("total_precipitation", 0.95): "precip_high",
    ("max_wind_speed", 0.95): "wind_high",
}


def extreme_days(daily: DataFrame, entity: str = "location_name", limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Days per site at or beyond the global thresholds."""
    bounds = thresholds(daily, EXTREMES, limit)
    tests = {
        "hot_days": F.col("max_temperature") >= F.col("temp_high"),
        "cold_days": F.col("min_temperature") <= F.col("temp_low"),
        "heavy_rain_days": F.col("total_precipitation") >= F.col("precip_high"),
        "high_wind_days": F.col("max_wind_speed") >= F.col("wind_high"),
    }
    hits = [F.sum(F.coalesce(test, F.lit(False)).cast("long")).alias(name) for name, test in tests.items()]
    return beside(daily, bounds).groupBy(entity).agg(*hits)


def above_quantile(df: DataFrame, flags: dict[tuple[str, float], str], limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Add 0/1 flags: value strictly above its own global quantile."""
    bounds = thresholds(df, {key: f"_{name}" for key, name in flags.items()}, limit)
    marked = beside(df, bounds).withColumns(
        {
            name: F.coalesce(F.col(column) > F.col(f"_{name}"), F.lit(False)).cast("int")
            for (column, _), name in flags.items()
        }
    )
    return marked.drop(*[f"_{name}" for name in flags.values()])


def contingency(df: DataFrame, rows: str, columns: str, names: Sequence) -> DataFrame:
    return df.groupBy(rows).pivot(columns, list(names)).agg(F.count(F.lit(1))).na.fill(0)


def histogram(df: DataFrame, columns: Sequence[str], bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the smallest and largest value, the last one closed on the
    right: (by..., variable, bin, n); empty bins are absent."""
    ends = [f(c).cast("double").alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    bounds = df.groupBy(*by).agg(*ends)
    bounded = join_dimension(df, bounds, list(by), "inner") if by else beside(df, bounds)

    def place(c: str) -> Column:
        low, value = F.col(f"_lo_{c}"), F.col(c).cast("double")
        width = (F.col(f"_hi_{c}") - low) / bins
        inside = F.least(F.floor((value - low) / width), F.lit(bins - 1))
        return F.when(value.isNull(), None).when(width > 0, inside).otherwise(0).cast("int")

    placed = bounded.select(*by, *[place(c).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = placed.selectExpr(*[f"`{k}`" for k in by], f"stack({len(columns)}, {pairs}) as (variable, bin)")
    return long.filter("bin is not null").groupBy(*by, "variable", "bin").agg(F.count(F.lit(1)).alias("n"))


def iqr_outliers(df: DataFrame, columns: Sequence[str], reach: float = 1.5, limit: int = DISTINCT_LIMIT) -> DataFrame:
    """(variable, outliers, outlier_pct), the share being of all rows."""
    names = {(c, p): f"{c}_{n}" for c in columns for p, n in ((0.25, "q1"), (0.75, "q3"))}
    bounds = thresholds(df, names, limit)

    def outside(c: str) -> Column:
        q1, q3 = F.col(f"{c}_q1"), F.col(f"{c}_q3")
        fence = (q3 - q1) * reach
        return F.coalesce((F.col(c) < q1 - fence) | (F.col(c) > q3 + fence), F.lit(False)).cast("long")

    counts = beside(df, bounds).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(outside(c)).alias(f"_{c}") for c in columns]
    )
    pairs = ", ".join(f"'{c}', `_{c}`" for c in columns)
    return counts.selectExpr("_n", f"stack({len(columns)}, {pairs}) as (variable, outliers)").select(
        "variable", "outliers", (F.col("outliers") * 100.0 / F.col("_n")).alias("outlier_pct")
    )


def box_summary(df: DataFrame, by: str, value: str, reach: float = 1.5, limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Quartiles per group, whiskers at the last values inside the fences, and outlier counts."""
    names = {(value, 0.25): "q1", (value, 0.5): "median", (value, 0.75): "q3"}
    quartiles = wide(quantiles(df, [value], (0.25, 0.5, 0.75), [by], limit), names, [by])
    fence = (F.col("q3") - F.col("q1")) * reach
    inside = F.col(value).between(F.col("q1") - fence, F.col("q3") + fence)
    return (
        join_dimension(df.filter(F.col(value).isNotNull()), quartiles, by, "inner")
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.sum((~inside).cast("long")).alias("outliers"),
        )
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long matrix (variable_1, variable_2, correlation) in one pass. A row counts for a pair
    when both its values are present; ``functions.association`` tells what a constant column gives."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[correlation(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        cells.append(f"'{a}', '{b}', `{a}|{b}`")
        if a != b:
            cells.append(f"'{b}', '{a}', `{a}|{b}`")
    return row.selectExpr(f"stack({len(cells)}, {', '.join(cells)}) as (variable_1, variable_2, correlation)")


def strong_pairs(matrix: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Pairs of the upper triangle beyond the threshold, largest correlation first."""
    place = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    return matrix.filter(
        (place[F.col("variable_1")] < place[F.col("variable_2")]) & (F.abs("correlation") > threshold)
    ).orderBy(F.desc("correlation"), "variable_1", "variable_2")


def top_correlations(matrix: DataFrame, k: int = 3) -> DataFrame:
    """The k strongest off-diagonal entries, both directions listed; entries that agree to
    twelve digits are ties and go by name."""
    off = matrix.filter(F.col("variable_1") != F.col("variable_2"))
    return off.orderBy(F.desc(F.round(F.abs("correlation"), 12)), "variable_1", "variable_2").limit(k)


def fitted_lines(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Least-squares line of the second variable on the first, all pairs in one pass."""
    aggregates = []
    for i, (x, y) in enumerate(pairs):
        aggregates += [F.regr_slope(y, x).alias(f"s{i}"), F.regr_intercept(y, x).alias(f"i{i}"), F.regr_count(y, x).alias(f"n{i}")]
    cells = ", ".join(f"'{x}', '{y}', n{i}, s{i}, i{i}" for i, (x, y) in enumerate(pairs))
    return df.agg(*aggregates).selectExpr(f"stack({len(pairs)}, {cells}) as (variable_1, variable_2, n, slope, intercept)")


def headline(daily: DataFrame, entity: str = "location_name", day: str = "date") -> DataFrame:
    sites = daily.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(day).alias("a"),
        F.max(day).alias("b"),
        *[f(c).alias(f"{c}_{s}") for c in ("avg_temperature", "avg_humidity", "avg_wind_speed") for s, f in (("s", F.sum), ("c", F.count))],
        F.sum("total_precipitation").alias("rain"),
    )

    def mean(c: str) -> Column:
        return F.sum(f"{c}_s") / F.sum(f"{c}_c")

    return sites.agg(
        F.sum("n").alias("total_records"),
        F.count(F.lit(1)).alias("locations"),
        F.min("a").alias("first_date"),
        F.max("b").alias("last_date"),
        mean("avg_temperature").alias("avg_temperature"),
        F.sum("rain").alias("total_precipitation"),
        mean("avg_humidity").alias("avg_humidity"),
        mean("avg_wind_speed").alias("avg_wind_speed"),
    )


def kpis(daily: DataFrame, entity: str = "location_name") -> DataFrame:
    totals = daily.agg(
        F.avg("avg_temperature").alias("avg_temperature"),
        F.max("max_temperature").alias("max_temperature"),
        F.avg("avg_humidity").alias("avg_humidity"),
        F.sum("total_precipitation").alias("total_precipitation"),
        F.sum((F.col("total_precipitation") > 0).cast("long")).alias("rainy_days"),
    )
    return beside(totals, daily.select(entity).distinct().agg(F.count(F.lit(1)).alias("total_locations")))


def daily_detail(daily: DataFrame) -> DataFrame:
    """The daily report table with a quality word (>= 95 Good, >= 80 Fair, else Poor)."""
    score = F.col("avg_data_quality_score")
    return daily.select(
        "date",
        "location_name",
        "avg_temperature",
        "total_precipitation",
        "avg_humidity",
        "avg_wind_speed",
        F.when(score >= 95, "Good").when(score >= 80, "Fair").otherwise("Poor").alias("quality_indicator"),
    )


# Daily precipitation classes as (upper bound, label); 0 and above 200 have none.
RAIN_CLASSES = ((1.0, "Light"), (10.0, "Moderate"), (50.0, "Heavy"), (200.0, "Very Heavy"))


def rain_class(column: str = "total_precipitation") -> Column:
    rain = F.col(column)
    label = F.when(rain <= 0, F.lit(None).cast("string"))
    for upper, name in RAIN_CLASSES:
        label = label.when(rain <= upper, name)
    return label


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unparsable text becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def latest_per_entity(df: DataFrame, entity: str = "location_name", time: str = "date", values: Sequence[str] = ()) -> DataFrame:
    """The last row of each entity, by an aggregate that is combined before the shuffle."""
    rest = list(values) or [c for c in df.columns if c not in (entity, time)]
    latest = F.max_by(F.struct(*rest), F.col(time)).alias("_row")
    return df.groupBy(entity).agg(F.max(time).alias(time), latest).select(entity, time, *[F.col(f"_row.{c}").alias(c) for c in rest])


def cumulative_share(df: DataFrame, weight: str, name: str) -> DataFrame:
    """Running share of ``weight``, largest first; for lists as short as a model's inputs."""
    ordered = Window.orderBy(F.desc(weight), name)
    return df.select(
        "*",
        F.row_number().over(ordered).alias("position"),
        F.sum(weight).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative"),
    )


def running_share(df: DataFrame, weight: str, name: str) -> DataFrame:
    """The same for lists of any length: positions and running sums over ranges, not one window."""
    falling = df.withColumn("_falling", -F.col(weight))
    summed = prefix_sums(falling, ["_falling", name], weight, "_earlier")
    placed = with_positions(summed, ["_falling", name], "position")
    return placed.withColumn("cumulative", F.col("_earlier") + F.col(weight)).drop("_falling", "_earlier")


def count_to_reach(shares: DataFrame, levels: Sequence[float] = (0.9, 0.95)) -> DataFrame:
    """First position at which the running share reaches each level."""
    return shares.agg(
        *[F.min(F.when(F.col("cumulative") >= level, F.col("position"))).alias(f"n_{int(level * 100)}") for level in levels]
    )


def outside_thresholds(df: DataFrame, bounds: DataFrame, key: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """Readings outside the range a threshold table gives for their metric; ``bounds`` has one
    row per metric."""
    pairs = ", ".join(f"'{m}', cast(`{m}` as double)" for m in measures)
    long = df.selectExpr(*[f"`{k}`" for k in key], f"stack({len(measures)}, {pairs}) as (metric, value)")
    return (
        join_dimension(long, bounds.select("metric", "min_value", "max_value"), "metric", "inner")
        .filter((F.col("value") < F.col("min_value")) | (F.col("value") > F.col("max_value")))
        .select(*key, "metric", "value")
    )


def hash_sample(df: DataFrame, key: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """A reproducible random sample of k rows: the k smallest md5 sums of key and seed. Each task
    keeps its own k, so nothing is sorted as a whole."""
    return df.withColumn("_h", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))).orderBy("_h", *key).limit(k).drop("_h")
