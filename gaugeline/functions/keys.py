"""Row identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands for NULL inside a hashed key.
NULL_IN_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str) -> Column:
    parts = [F.coalesce(F.col(name).cast("string"), F.lit(NULL_IN_KEY)) for name in columns]
    return F.md5(F.concat_ws("-", *parts))


def record_id(entity: str, time: str) -> Column:
    return F.concat_ws("_", F.col(entity), F.date_format(F.col(time), "yyyy-MM-dd HH:mm:ss"))
