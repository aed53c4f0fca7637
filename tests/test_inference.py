"""Tests and intervals on small samples with known results."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.functions import cdf
from gaugeline.functions.normal import normal_quantile
from gaugeline.operators import inference as inf

A = [6.11, 4.2, 5.5, 5.9, 7.3, 4.8]
B = [8.2, 7.9, 6.4, 9.1, 7.7]
C = [5.0, 5.2, 4.9, 6.1]


@pytest.fixture(scope="module")
def groups(spark):
    rows = [("a", v) for v in A] + [("b", v) for v in B] + [("c", v) for v in C] + [("a", None), (None, 3.0)]
    return spark.createDataFrame(rows, "g string, v double")


def test_anova(groups):
    row = inf.anova(groups, "v", "g").first()
    sets = [np.array(s) for s in (A, B, C)]
    grand = np.concatenate(sets).mean()
    between = sum(len(s) * (s.mean() - grand) ** 2 for s in sets) / 2
    within = sum(((s - s.mean()) ** 2).sum() for s in sets) / 12
    assert row.f == pytest.approx(between / within) and (row.df_between, row.df_within) == (2, 12)
    assert row.p_value == pytest.approx((1 + 2 * row.f / 12) ** -6)  # closed form for two numerator degrees


def test_t_test_and_effect(groups):
    row = inf.t_test(groups, "v", "g", "a", "b").first()
    a, b = np.array(A), np.array(B)
    pooled = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    assert row.equal_variances == "Yes" and row.df == 9
    assert row.t == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled * (1 / len(a) + 1 / len(b))))
    assert inf.cohens_d(groups, "v", "g", "a", "b").first().d == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled))


def test_welch_when_variances_differ(spark):
    rng = np.random.default_rng(0)
    rows = [("a", float(v)) for v in rng.normal(0, 1, 80)] + [("b", float(v)) for v in rng.normal(0, 9, 60)]
    row = inf.t_test(spark.createDataFrame(rows, "g string, v double"), "v", "g", "a", "b").first()
    assert row.equal_variances == "No" and row.df < 100


def test_mann_whitney_counts_wins(groups):
    row = inf.mann_whitney(groups, "v", "g", "a", "b").first()
    assert row.u == sum((x > y) + 0.5 * (x == y) for x in A for y in B)
    assert 0 < row.p_value < 0.05


def test_mann_whitney_of_equal_samples(spark):
    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in (1, 2, 2, 3)], "g string, v double")
    row = inf.mann_whitney(df, "v", "g", "a", "b").first()
    assert row.u == 8.0 and row.p_value == 1.0


def test_kruskal_of_two_groups_equals_squared_score(spark):
    df = spark.createDataFrame([("a", float(v)) for v in A] + [("b", float(v)) for v in B], "g string, v double")
    h = inf.kruskal(df, "v", "g").first().h
    n1, n2, n = len(A), len(B), len(A) + len(B)
    u = sum(x > y for x in A for y in B)
    assert h == pytest.approx((u - n1 * n2 / 2) ** 2 / (n1 * n2 * (n + 1) / 12))


def test_tukey_of_two_groups_agrees_with_t(spark):
    df = spark.createDataFrame([("a", v) for v in A] + [("b", v) for v in B], "g string, v double")
    tukey = inf.tukey_hsd(df, "v", "g").first()
    assert tukey.mean_diff == pytest.approx(np.mean(B) - np.mean(A))
    assert tukey.p_adj == pytest.approx(inf.t_test(df, "v", "g", "a", "b").first().p_value, abs=1e-6)
    assert tukey.lower < tukey.mean_diff < tukey.upper and tukey.reject == "Yes"


def test_shapiro_known_samples(spark):
    # "men": weights of eleven men, the example of Shapiro and Wilk (1965): W = 0.79, p below 0.01
    rng = np.random.default_rng(1)
    samples = {
        "men": [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0], "normal": rng.normal(size=7000),
        "skewed": rng.exponential(size=400), "three": [1, 2, 4.0], "five": [1, 2, 3, 4, 20.0], "two": [1, 2.0], "same": [3.0] * 9,
    }
    got = {}
    for name, values in samples.items():
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, v double")
        got[name] = inf.shapiro(df, ["v"], ["id"]).first()
    assert got["men"].w == pytest.approx(0.7888, abs=2e-4) and got["men"].p_value == pytest.approx(0.0067, abs=3e-4)
    assert got["normal"].n == 7000 and got["normal"].w > 0.999 and got["normal"].p_value > 0.01 and got["skewed"].p_value < 1e-10
    # For three values W is the squared range over twice the squared deviations.
    assert got["three"].w == pytest.approx(9 / 2 / (14 / 3)) and got["five"].w < 0.75
    assert got["two"].w is None and got["same"].w is None and got["same"].p_value is None


def test_normal_quantile(spark):
    from statistics import NormalDist

    ps = [1e-300, 1e-20, 1e-5, 0.01, 0.075, 0.3, 0.5, 0.6, 0.93, 0.999, 0.0, 1.0]
    df = spark.createDataFrame([(p,) for p in ps], "p double").select(normal_quantile(F.col("p")).alias("z"))
    got = [r.z for r in df.collect()]
    assert got[-2:] == [None, None]
    assert got[:-2] == pytest.approx([NormalDist().inv_cdf(p) for p in ps[:-2]], rel=1e-13, abs=1e-15)


def test_tails_hold_for_very_many_rows():
    normal, chi = cdf.normal_two_sided(1.96), cdf.chi2_sf(5.0, 3.0)
    for df in (1e10, 1e12, 1e14, 1e15):
        assert cdf.t_two_sided(1.96, df) == pytest.approx(normal, abs=1e-9)
        assert cdf.f_sf(5.0 / 3.0, 3.0, df) == pytest.approx(chi, abs=1e-9)
        assert cdf.studentized_range_sf(3.314, 3, df) == pytest.approx(cdf.studentized_range_sf(3.314, 3, 1e9), abs=1e-8)
    for df in (3.0, 40.0, 900.0, 5e3, 1e6):  # the two ways of log B agree where both are exact
        assert cdf.t_two_sided(2.2, df) == pytest.approx(2 * (1 - _t_cdf(2.2, df)), rel=1e-6)


def _t_cdf(t, df):
    x = np.linspace(0, t, 20001)
    log_c = math.lgamma((df + 1) / 2) - math.lgamma(df / 2)
    y = np.exp(log_c - 0.5 * np.log(df * np.pi) - (df + 1) / 2 * np.log1p(x * x / df))
    return 0.5 + float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum())


def test_dagostino_on_normal_and_skewed(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.normal(size=2000), rng.exponential(size=2000))], "n double, e double")
    got = {r.variable: r for r in inf.dagostino(df, ["n", "e"]).collect()}
    assert got["n"].p_value > 0.01 and got["e"].p_value < 1e-10


def test_qq_line_of_normal_sample(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.normal(5, 2, 3000))], "id int, v double")
    line = inf.qq_line(inf.qq_points(df, "v", ["id"])).first()
    assert line.n == 3000 and line.slope == pytest.approx(2, abs=0.1) and line.intercept == pytest.approx(5, abs=0.1) and line.r > 0.995


def test_proportions(spark):
    rows = [("a", i < 30) for i in range(100)] + [("b", i < 50) for i in range(120)]
    row = inf.proportion_test(spark.createDataFrame(rows, "g string, e boolean"), F.col("e"), "g", "a", "b").first()
    p = 80 / 220
    assert (row.x1, row.n1, row.x2, row.n2) == (30, 100, 50, 120)
    assert row.z == pytest.approx((0.3 - 50 / 120) / math.sqrt(p * (1 - p) * (1 / 100 + 1 / 120)))


def test_chi_square(spark):
    counts = {("n", 0): 20, ("n", 1): 30, ("y", 0): 40, ("y", 1): 10}
    df = spark.createDataFrame([k for k, n in counts.items() for _ in range(n)], "a string, b int")
    row = inf.chi_square(df, "a", "b").first()
    expected = sum((abs(o - e) - 0.5) ** 2 / e for o, e in zip((20, 30, 40, 10), (30, 20, 30, 20)))
    assert row.chi2 == pytest.approx(expected) and row.dof == 1
    plain = inf.chi_square(df, "a", "b", correction=False).first()
    assert plain.chi2 == pytest.approx(100 / 30 * 2 + 100 / 20 * 2)


def test_chi_square_with_an_empty_cell(spark):
    counts = {("x", 0): 10, ("x", 1): 5, ("y", 0): 8, ("z", 1): 7}
    df = spark.createDataFrame([k for k, n in counts.items() for _ in range(n)], "a string, b int")
    rows, cols, n = {"x": 15, "y": 8, "z": 7}, {0: 18, 1: 12}, 30
    expected = sum((counts.get((a, b), 0) - rows[a] * cols[b] / n) ** 2 / (rows[a] * cols[b] / n) for a in rows for b in cols)
    row = inf.chi_square(df, "a", "b").first()
    assert row.chi2 == pytest.approx(expected) and row.dof == 2
    grid = inf.expected_counts(df, "a", "b").collect()
    assert len(grid) == 6 and sum(r.observed for r in grid) == 30


def test_confidence_interval(groups):
    row = {r.g: r for r in inf.confidence_intervals(groups.dropna(), ["v"], "g").collect()}["a"]
    half = 2.570582 * np.std(A, ddof=1) / math.sqrt(len(A))
    assert row.lower == pytest.approx(np.mean(A) - half, abs=1e-5) and row.n == 6


def test_pearson_perfect(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"))
    row = inf.pearson(df, [("x", "y")]).first()
    assert row.r == pytest.approx(1.0) and row.p_value < 1e-12 and row.strength == "Strong"
