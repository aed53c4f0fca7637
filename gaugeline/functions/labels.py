"""Words for test results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.functions.calendar import as_column


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def significant(p: Column | str, alpha: float = 0.05) -> Column:
    return yes_no(as_column(p) < alpha)


def normal_at(p: Column | str, alpha: float = 0.05) -> Column:
    return yes_no(as_column(p) > alpha)


def effect_size(d: Column | str, small: float = 0.2, medium: float = 0.5) -> Column:
    size = F.abs(as_column(d))
    return F.when(size < small, "Small").when(size < medium, "Medium").otherwise("Large")


def strength(r: Column | str, weak: float = 0.3, strong: float = 0.7) -> Column:
    size = F.abs(as_column(r))
    return F.when(size < weak, "Weak").when(size < strong, "Moderate").otherwise("Strong")
