"""Calendar columns. Weeks start on Sunday = 0, as the models expect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.schema import DAY_NAMES, DRY_MONTHS, MONTH_NAMES


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def day_of_week(time: Column | str) -> Column:
    return F.dayofweek(as_column(time)) - 1


def weekday_from_monday(time: Column | str) -> Column:
    return F.weekday(as_column(time))


def _lookup(names: tuple[str, ...], one_based: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in names]), one_based)


def day_name(dow: Column | str) -> Column:
    return _lookup(DAY_NAMES, as_column(dow) + 1)


def month_name(month: Column | str) -> Column:
    return _lookup(MONTH_NAMES, as_column(month))


def weekend_flag(dow: Column | str) -> Column:
    return as_column(dow).isin(0, 6).cast("int")


def season(month: Column | str) -> Column:
    return F.when(as_column(month).isin(*DRY_MONTHS), "Dry Season").otherwise("Rainy Season")


def quarter_label(month: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.ceil(as_column(month) / 3).cast("string"))


def time_of_day(hour: Column | str) -> Column:
    h = as_column(hour)
    return (
        F.when(h.between(5, 11), "Morning")
        .when(h.between(12, 16), "Afternoon")
        .when(h.between(17, 20), "Evening")
        .otherwise("Night")
    )


def local_time(time: Column | str, tz: str | None) -> Column:
    """Shift a UTC wall-clock time to ``tz``; with no zone the value is used as stored."""
    column = as_column(time)
    if tz is None:
        return column
    return F.from_utc_timestamp(column.cast("timestamp"), tz).cast("timestamp_ntz")
