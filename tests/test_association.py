"""Correlations of columns that do not vary."""

import math

import pytest

from gaugeline.functions import labels
from gaugeline.operators import inference as inf
from gaugeline.operators import profile as pf

ROWS = [(1.0, 2.0, 5.0, None), (2.0, 1.0, 5.0, None), (3.0, 5.0, 5.0, None), (4.0, None, 5.0, 2.0)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "a double, b double, flat double, few double")


def test_constant_columns_have_no_correlation(table):
    matrix = pf.correlation_matrix(table, ["a", "b", "flat", "few"])
    found = {(r.variable_1, r.variable_2): r.correlation for r in matrix.collect()}
    assert len(found) == 16
    assert found["a", "b"] == found["b", "a"] == pytest.approx(3 / math.sqrt(2 * 26 / 3))
    assert found["a", "a"] == pytest.approx(1)
    assert all(math.isnan(found[pair]) for pair in [("a", "flat"), ("flat", "flat"), ("flat", "b"), ("few", "few")])
    assert found["b", "few"] is None  # no row has both


def test_strong_pairs_and_labels_of_constant_columns(table):
    matrix = pf.correlation_matrix(table, ["a", "b", "flat"])
    pairs = [(r.variable_1, r.variable_2) for r in pf.strong_pairs(matrix, ["a", "b", "flat"], 0.6).collect()]
    assert pairs == [("a", "flat"), ("b", "flat"), ("a", "b")]  # as in the SQL, where NaN is above every number
    words = matrix.select("variable_1", "variable_2", labels.strength("correlation").alias("s")).collect()
    assert {r.s for r in words if r.variable_1 == "flat"} == {"Strong"}


def test_tests_of_constant_columns(table):
    pearson = {r.variable_2: r.r for r in inf.pearson(table, [("a", "b"), ("a", "flat")]).collect()}
    spearman = {r.variable_2: r.rho for r in inf.spearman(table, [("a", "b"), ("a", "flat")]).collect()}
    assert pearson["b"] == pytest.approx(3 / math.sqrt(2 * 26 / 3)) and math.isnan(pearson["flat"])
    assert spearman["b"] == pytest.approx(0.5) and math.isnan(spearman["flat"])
