"""Bring a result to types that compare the same in any engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gaugeline.functions.rounding import rounded


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Whole numbers as bigint, doubles rounded, dates as ISO text."""

    def column(field: T.StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, (T.IntegralType, T.BooleanType)):
            return f"cast({name} as bigint) as {name}"
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return f"{rounded(f'cast({name} as double)', digits)} as {name}"
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return f"cast({name} as string) as {name}"
        return name

    return df.selectExpr(*[column(f) for f in df.schema])
