"""Correlation that is defined for every input: Spark's own fails where a column is constant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(product: Column, spread: Column) -> Column:
    """``product / spread``, NaN where nothing spreads and NULL without rows."""
    return F.when(spread == 0, F.lit(float("nan"))).otherwise(F.try_divide(product, spread))


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over the rows in which both are present: NaN if one of them is constant there
    (so for a single row too), NULL without such rows."""
    return ratio(F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x)))
