"""Data-quality assertions. A check returns its violations; no rows means it passes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Check:
    """``violations`` gives the failing rows. A check of single rows or values of one table also names the
    ``table`` and its ``rule``, so that a run can count all rules of one kind in one pass:
    ("row", condition), ("value", column, condition): distinct failing values, or ("key", column): values
    that occur twice or more."""

    name: str
    violations: Callable[[], DataFrame]
    table: DataFrame | None = None
    rule: tuple = ()


def row_check(name: str, df: DataFrame, condition: Column, columns: Sequence[str] = ("*",)) -> Check:
    return Check(name, lambda: df.filter(condition).select(*columns), df, ("row", condition))


def value_check(name: str, df: DataFrame, column: str, bad: Column) -> Check:
    return Check(name, lambda: _bad_values(df, column, bad), df, ("value", column, bad))


def key_check(name: str, df: DataFrame, column: str) -> Check:
    return Check(name, lambda: unique(df, column), df, ("key", column))


def unique(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter("n_records > 1")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return _bad_values(df, column, ~F.col(column).isin(*values))


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return _bad_values(df, column, F.col(column) < 0)


def in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return _bad_values(df, column, _outside(column, low, high))


def _outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def valid_humidity(df: DataFrame, column: str = "humidity") -> DataFrame:
    return in_range(df, column, 0, 100)


def valid_temperature(df: DataFrame, column: str = "temperature") -> DataFrame:
    return in_range(df, column, -50, 60)


def _bad_values(df: DataFrame, column: str, bad: Column) -> DataFrame:
    """A NULL value never matches ``bad`` and passes."""
    return df.filter(bad).groupBy(column).agg(F.count(F.lit(1)).alias("invalid_count"))


def enough_days(daily: DataFrame, share: float = 0.9, entity: str = "location_name", day: str = "date") -> DataFrame:
    """Entities with fewer days than ``share`` of their own date span."""
    days = daily.select(entity, day).distinct()
    spans = days.groupBy(entity).agg(
        F.count(day).alias("day_count"), F.datediff(F.max(day), F.min(day)).alias("date_range_days")
    )
    return spans.filter(F.col("day_count") < F.col("date_range_days") * share).withColumn(
        "status", F.lit("Too few records")
    )


def quality_at_least(checked: DataFrame, minimum: float = 80.0, entity: str = "location_name") -> DataFrame:
    return (
        checked.groupBy(entity)
        .agg(
            F.avg("data_quality_score").alias("avg_quality_score"),
            F.min("data_quality_score").alias("min_quality_score"),
            F.count(F.lit(1)).alias("total_records"),
        )
        .filter(F.col("avg_quality_score") < minimum)
    )


def day_gaps(daily: DataFrame, entity: str = "location_name", day: str = "date") -> DataFrame:
    """Every row with the date before it in its series and the days between."""
    previous = F.lag(day).over(Window.partitionBy(entity).orderBy(day))
    return daily.select(entity, day, previous.alias("prev_date")).withColumn("day_gap", F.datediff(day, "prev_date"))


def continuous_days(daily: DataFrame, entity: str = "location_name", day: str = "date") -> DataFrame:
    return day_gaps(daily, entity, day).filter("day_gap > 1")


def recomputed_lag(features: DataFrame, entity: str = "location_name", day: str = "date") -> DataFrame:
    actual = F.lag("avg_temperature").over(Window.partitionBy(entity).orderBy(day))
    return (
        features.filter(F.col("temp_lag_1d").isNotNull())
        .select(entity, day, "temp_lag_1d", actual.alias("actual_yesterday_temp"))
        .withColumn("difference", F.abs(F.col("temp_lag_1d") - F.col("actual_yesterday_temp")))
    )


def consistent_lag(features: DataFrame, tolerance: float = 0.1, entity: str = "location_name", day: str = "date") -> DataFrame:
    return recomputed_lag(features, entity, day).filter(F.col("difference") > tolerance)


def all_present(expected: DataFrame, actual: DataFrame, entity: str = "location_name") -> DataFrame:
    """Expected entities without any row. The actual side is reduced to its entities first."""
    return expected.select(entity).distinct().join(actual.select(entity).distinct(), entity, "left_anti")


def one_row_per_day(daily: DataFrame, entity: str = "location_name", day: str = "date") -> DataFrame:
    return daily.groupBy(entity, day).agg(F.count(F.lit(1)).alias("record_count")).filter("record_count > 1")


def no_future_dates(daily: DataFrame, as_of=None, entity: str = "location_name", day: str = "date") -> DataFrame:
    bound = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return daily.filter(F.col(day) > bound).groupBy(entity, day).agg(F.count(F.lit(1)).alias("record_count"))


def non_negative_totals(daily: DataFrame) -> DataFrame:
    return daily.filter(F.col("total_precipitation") < 0).select("location_name", "date", "total_precipitation")


ROLLING_MEANS = ("location_name", "date", "avg_temperature", "temp_rolling_7d_prev", "temp_rolling_30d_prev")
ORDERED = ("location_name", "date", "min_temperature", "avg_temperature", "max_temperature")


def _far_rolling_means(week: float = 15.0, month: float = 20.0) -> Column:
    return (F.abs(F.col("avg_temperature") - F.col("temp_rolling_7d_prev")) > week) | (
        F.abs(F.col("avg_temperature") - F.col("temp_rolling_30d_prev")) > month
    )


def plausible_rolling_means(features: DataFrame, week: float = 15.0, month: float = 20.0) -> DataFrame:
    return features.filter(_far_rolling_means(week, month)).select(*ROLLING_MEANS)


def _unordered_temperatures() -> Column:
    """That min <= avg <= max is false; a NULL makes it unknown, which passes."""
    t = F.col("avg_temperature")
    return ~((F.col("min_temperature") <= t) & (t <= F.col("max_temperature")))


def ordered_temperatures(daily: DataFrame) -> DataFrame:
    return daily.filter(_unordered_temperatures()).select(*ORDERED)


def batch_shape(batch: DataFrame, required: Sequence[str], expected_rows: int) -> DataFrame:
    """One row: required columns the batch lacks, its row count and whether it reaches the
    expected count."""
    missing = ",".join(sorted(set(required) - set(batch.columns)))
    return batch.agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(missing).alias("missing_columns"),
        "records",
        F.lit(expected_rows).cast("long").alias("expected"),
        (F.col("records") >= expected_rows).cast("int").alias("is_complete"),
    )


def mart_checks(
    spark: SparkSession,
    raw: DataFrame,
    checked: DataFrame,
    daily: DataFrame,
    features: DataFrame,
    dim_location: DataFrame,
    dim_date: DataFrame,
    expected_sites: DataFrame,
    staged: DataFrame,
    as_of=None,
) -> list[Check]:
    """The declared suite over the whole chain of tables."""
    tables = {
        "raw": (raw, ["record_id"], ["record_id", "datetime", "location_name", "temperature"]),
        "staged": (staged, ["record_id"], ["record_id", "datetime", "temperature", "pressure"]),
        "daily": (daily, ["daily_id"], ["daily_id", "location_name", "date", "avg_temperature"]),
        "features": (features, ["feature_id"], ["feature_id"]),
        "dim_location": (dim_location, ["location_id", "location_name"], ["location_id", "location_name"]),
        "dim_date": (dim_date, ["date_id", "date"], ["date_id", "date"]),
    }
    suite = []
    for table, (df, keys, required) in tables.items():
        suite += [key_check(f"unique_{table}_{c}", df, c) for c in keys]
        suite += [row_check(f"not_null_{table}_{c}", df, F.col(c).isNull()) for c in required]
    return suite + [
        value_check("valid_temperature_staged", staged, "temperature", _outside("temperature", -50, 60)),
        value_check("valid_humidity_staged", staged, "humidity", _outside("humidity", 0, 100)),
        value_check("non_negative_staged_precipitation", staged, "precipitation", F.col("precipitation") < 0),
        value_check("non_negative_staged_wind_speed", staged, "wind_speed", F.col("wind_speed") < 0),
        Check("enough_days", lambda: enough_days(daily)),
        Check("quality_at_least", lambda: quality_at_least(checked)),
        Check("continuous_days", lambda: continuous_days(daily)),
        Check("consistent_lag", lambda: consistent_lag(features)),
        Check("all_present", lambda: all_present(expected_sites, daily)),
        Check("one_row_per_day", lambda: one_row_per_day(daily)),
        Check("no_future_dates", lambda: no_future_dates(daily, as_of)),
        row_check("non_negative_totals", daily, F.col("total_precipitation") < 0, ("location_name", "date", "total_precipitation")),
        row_check("plausible_rolling_means", features, _far_rolling_means(), ROLLING_MEANS),
        row_check("ordered_temperatures", daily, _unordered_temperatures(), ORDERED),
    ]


def seed_checks(locations: DataFrame, seasons: DataFrame, thresholds: DataFrame) -> list[Check]:
    declared = [
        ("locations", locations, ["location_name"], ["location_name", "population"]),
        ("seasons", seasons, ["month"], ["month", "season"]),
        ("thresholds", thresholds, ["metric"], ["metric", "min_value", "max_value"]),
    ]
    suite = []
    for table, df, keys, required in declared:
        suite += [key_check(f"unique_{table}_{c}", df, c) for c in keys]
        suite += [row_check(f"not_null_{table}_{c}", df, F.col(c).isNull()) for c in required]
    return suite + [
        value_check("accepted_season_months", seasons, "month", ~F.col("month").isin(*range(1, 13))),
        value_check("accepted_seasons", seasons, "season", ~F.col("season").isin("Dry Season", "Rainy Season")),
    ]


def run_checks(checks: Sequence[Check], store: str | None = None) -> DataFrame:
    """(check_name, violations, status), one row per check. All rules of a table on single rows are counted in
    one pass, all on values in one grouping, all on keys in another. With ``store`` the violations of
    each check are also written as a table under that folder, and counted there."""
    counted: list[DataFrame] = []
    groups: dict[tuple[int, str], list[Check]] = {}
    for check in checks:
        if store:
            found = check.violations()
            path = f"{store.rstrip('/')}/{check.name}"
            found.write.mode("overwrite").parquet(path)
            counted.append(_counted(check.name, found.sparkSession.read.schema(found.schema).parquet(path)))
        elif check.rule:
            groups.setdefault((id(check.table), check.rule[0]), []).append(check)
        else:
            counted.append(_counted(check.name, check.violations()))
    for (_, kind), own in groups.items():
        counted.append(_rows_counted(own) if kind == "row" else _values_counted(own))
    united = reduce(DataFrame.unionByName, counted)
    return united.withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise("fail"))


def _counted(name: str, found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")


def _stacked(row: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row of counts c0, c1, ... as a row for each check."""
    pairs = ", ".join(f"'{check.name}', c{i}" for i, check in enumerate(checks))
    return row.selectExpr(f"stack({len(checks)}, {pairs}) as (check_name, violations)")


def _rows_counted(checks: Sequence[Check]) -> DataFrame:
    counts = [F.count(F.when(check.rule[1], 1)).alias(f"c{i}") for i, check in enumerate(checks)]
    return _stacked(checks[0].table.agg(*counts), checks)


def _values_counted(checks: Sequence[Check]) -> DataFrame:
    """Distinct failing values, or values that occur twice or more, of several columns at once."""
    keys = checks[0].rule[0] == "key"
    cells = [
        F.struct(F.lit(i).alias("i"), F.col(c.rule[1]).cast("string").alias("v"), (F.col(c.rule[1]).isNotNull() if keys else c.rule[2]).alias("on"))
        for i, c in enumerate(checks)
    ]
    long = checks[0].table.select(F.explode(F.array(*cells)).alias("c")).filter("c.on").groupBy("c.i", "c.v")
    found = long.agg(F.count(F.lit(1)).alias("n")).filter("n > 1" if keys else "n > 0")
    return _stacked(found.agg(*[F.count(F.when(F.col("i") == i, 1)).alias(f"c{i}") for i in range(len(checks))]), checks)
