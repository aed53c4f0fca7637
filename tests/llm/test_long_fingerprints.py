"""Likeness of texts of very many sentences."""

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import fingerprints


@pytest.mark.parametrize("n", [50_000, 200_000])
def test_unrelated_long_texts_are_unlike(spark, n):
    texts = [" ".join(f"{c}{i}." for i in range(n)) for c in "ab"]
    half = " ".join([*texts[0].split(" ")[: n // 2], *texts[1].split(" ")[: n // 2]])
    frame = spark.createDataFrame([(*texts, half)], "a string, b string, half string")
    prints = frame.select(*[fingerprints.fingerprint(F.col(c)).alias(c) for c in frame.columns])
    prints = spark.createDataFrame(prints.collect(), prints.schema)  # computed once
    row = prints.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("none"), fingerprints.likeness(F.col("a"), F.col("half")).alias("some")).first()
    assert row["none"] < 0.25 and 0.3 < row["some"] < 0.7
