"""Block-wise frames, prefix sums and everything built on them, against plain computation."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators import decompose, frames, quantiles, ranks
from gaugeline.operators import features as ft
from gaugeline.operators import staging as st
from gaugeline.schema import SeriesSpec


def skewed(spark, rows=3000, seed=1):
    """A third of all rows in one group, many ties."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        site = "hot" if i % 3 == 0 else f"s{rng.randrange(7)}"
        data.append((site, rng.randrange(400), i, round(rng.uniform(-5, 5), 1)))
    return spark.createDataFrame(data, "g string, t int, id int, v double")


@pytest.fixture(params=["merged", "apart"])
def ranges(request, spark):
    """Small range partitions merged at run time, as by default, or all kept apart."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "true" if request.param == "merged" else "false")
    yield request.param
    spark.conf.set(key, "true")


def test_prefix_sums_match_running_totals(spark):
    df = skewed(spark).withColumn("w", F.lit(1).cast("long"))
    got = {r.id: r.before for r in frames.prefix_sums(df, ["t", "id"], "w", group=["g"], partitions=5).collect()}
    expected = {}
    by_group = {}
    for r in df.collect():
        by_group.setdefault(r.g, []).append((r.t, r.id))
    for members in by_group.values():
        for place, (_, row_id) in enumerate(sorted(members)):
            expected[row_id] = place
    assert got == expected


def test_prefix_sums_with_null_group(spark):
    df = spark.createDataFrame([(None, i, 2) for i in range(50)] + [("a", i, 3) for i in range(50)], "g string, t int, w int")
    rows = frames.prefix_sums(df, ["t"], "w", group=["g"], partitions=7).collect()
    assert all(r.before == r.t * (2 if r.g is None else 3) for r in rows) and len(rows) == 100


def test_positions_split_a_run_of_equal_keys(spark, ranges):
    df = spark.range(1000).select(F.lit(7).alias("k"), "id")
    got = sorted(r.position for r in frames.with_positions(df, ["k"]).collect())
    assert got == list(range(1, 1001))


@pytest.mark.parametrize("block_rows", [3, 10, 64])
def test_blocks_equal_plain_windows(spark, ranges, block_rows):
    df = skewed(spark)

    def build(w):
        return {
            "lag3": F.lag("v", 3).over(w),
            "mean": F.avg("v").over(w.rowsBetween(-2, 2)),
            "top": F.max("v").over(w.rowsBetween(-7, -1)),
        }

    plain = frames.over_rows(df, ["g"], ["t", "id"], build, before=7, after=2, limit=None)
    blocks = frames.over_rows(df, ["g"], ["t", "id"], build, before=7, after=2, limit=10, block_rows=block_rows)
    assert blocks.columns == plain.columns

    def rounded(frame):
        return sorted((r.id, r.lag3, r.top, round(r["mean"], 9)) for r in frame.collect())

    assert repr(rounded(plain)) == repr(rounded(blocks))


def test_gap_fill_edges(spark):
    """Six empty hours in a row, a midnight boundary, and an outlier among the neighbours."""
    base = dt.datetime(2024, 1, 1)
    values = [1.0, 2.0, None, None, None, None, None, None, 9.0, 10.0]
    rows = [("x", base + dt.timedelta(hours=i), f"r{i:02d}", v) for i, v in enumerate(values)]
    rows += [("x", base + dt.timedelta(hours=23), "r23", 50.0), ("x", base + dt.timedelta(hours=24), "r24", None)]
    df = spark.createDataFrame(rows, "location_name string, datetime timestamp_ntz, record_id string, temperature double")
    df = df.withColumn("date", F.to_date("datetime"))
    gate = (st.Gate("temperature", "temp_outlier_flag", -50.0, 60.0),)
    got = {r.record_id: r.temperature for r in st.fill_gaps(df, st.WEATHER, gate, limit=None).collect()}
    assert got["r02"] == 1.5 and got["r03"] == 2.0
    assert got["r04"] is None and got["r05"] is None
    assert got["r06"] == 9.0 and got["r07"] == 9.5
    assert got["r24"] is None  # the day before does not count


@pytest.mark.parametrize("limit", [0, 10**6])
def test_quantiles_match_numpy(spark, ranges, limit):
    df = skewed(spark).withColumn("w", F.when(F.col("id") % 5 != 0, F.col("v") * F.col("t")))
    probabilities = (0.0, 0.05, 0.5, 0.77, 1.0)
    found = quantiles.quantiles(df, ["v", "w"], probabilities, ["g"], limit=limit).collect()
    raw = {}
    for r in df.collect():
        for name, value in (("v", r.v), ("w", r.w)):
            if value is not None:
                raw.setdefault((r.g, name), []).append(value)
    assert len(found) == len(raw) * len(probabilities)
    for r in found:
        assert r["quantile"] == pytest.approx(np.quantile(raw[(r.g, r.variable)], r.probability), abs=1e-9)


def test_average_ranks_sum(spark, ranges):
    df = skewed(spark)
    rows = ranks.value_ranks(df, "v").collect()
    n = 3000
    assert sum(r.n * r["rank"] for r in rows) == pytest.approx(n * (n + 1) / 2)


def test_kendall_against_all_pairs(spark, ranges):
    rng = random.Random(3)
    points = [(rng.randrange(25), rng.randrange(30)) for _ in range(300)] + [(4, 4)] * 100
    df = spark.createDataFrame(points, "x int, y int")
    row = ranks.kendall(df, [("x", "y")]).first()
    xs, ys = np.array(points).T.astype(float)
    dx, dy = np.sign(xs[:, None] - xs), np.sign(ys[:, None] - ys)
    balance = (dx * dy).sum() / 2
    pairs = len(points) * (len(points) - 1) / 2
    tied_x, tied_y = ((dx == 0).sum() - len(points)) / 2, ((dy == 0).sum() - len(points)) / 2
    assert row.tau == pytest.approx(balance / np.sqrt((pairs - tied_x) * (pairs - tied_y)), abs=1e-12)


def test_kendall_of_one_value(spark):
    df = spark.createDataFrame([(1, i) for i in range(10)], "x int, y int")
    cells = ranks.pair_cells(df, [("x", "y")])
    assert ranks.concordant_pairs(cells).first().concordant == 0


def test_spearman_of_monotone_data(spark):
    df = spark.range(1, 200).select(F.col("id").alias("x"), (F.col("id") * F.col("id")).alias("y"))
    assert ranks.spearman(df, [("x", "y")]).first().rho == pytest.approx(1.0)


@pytest.mark.parametrize("period", [7, 6])
def test_decomposition_adds_up(spark, period):
    start = dt.date(2024, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), 10 + 0.5 * i + [0, 1, 2, 1, 0, -2, -2][i % period]) for i in range(period * 5)]
    rows += [("short", start + dt.timedelta(days=i), 1.0) for i in range(2 * period - 1)]
    df = spark.createDataFrame(rows, "location_name string, date date, v double")
    got = decompose.seasonal_decompose(df, "v", period).orderBy("date").collect()
    short = [r for r in got if r.location_name == "short"]
    assert short and all(r.observed is not None and r.trend is None and r.seasonal is None and r.resid is None for r in short)
    got = [r for r in got if r.location_name == "a"]
    half = period // 2
    assert [r.trend is None for r in got] == [i < half or i >= period * 5 - half for i in range(period * 5)]
    for r in got:
        if r.trend is not None:
            assert r.trend + r.seasonal + r.resid == pytest.approx(r.observed)
    assert sum(r.seasonal for r in got[:period]) == pytest.approx(0.0, abs=1e-9)
    blocks = decompose.seasonal_decompose(df.filter("location_name = 'a'"), "v", period, limit=4, block_rows=5).orderBy("date").collect()
    for one, two in zip(got, blocks, strict=True):
        assert (one.date, one.trend is None) == (two.date, two.trend is None)
        assert one.seasonal == pytest.approx(two.seasonal, abs=1e-9)


def _daily(spark, bump_day=None):
    start = dt.date(2024, 1, 1)
    sources = sorted({c for _, c, _ in ft.LAGS} | {c for _, _, c, _ in ft.ROLLING})
    rows = []
    for i in range(45):
        bump = 100.0 if bump_day == i else 0.0
        rows.append(("a", start + dt.timedelta(days=i), 1, 2024, 1, i % 7, 0, "Dry Season", *[float((i * 7 + j) % 11) + bump for j in range(len(sources))]))
    names = "location_name string, date date, month int, year int, quarter int, day_of_week int, is_weekend int, season string"
    kinds = ", ".join(f"{c} {'bigint' if c.startswith('hours_') else 'double'}" for c in sources)
    rows = [(*r[:8], *[int(v) if c.startswith("hours_") else v for v, c in zip(r[8:], sources)]) for r in rows]
    return spark.createDataFrame(rows, f"{names}, {kinds}")


def test_features_never_see_their_own_day(spark):
    day = 20
    clean = {r.date: r for r in ft.feature_mart(_daily(spark), as_of="2030-01-01").collect()}
    bumped = {r.date: r for r in ft.feature_mart(_daily(spark, day), as_of="2030-01-01").collect()}
    at = dt.date(2024, 1, 1) + dt.timedelta(days=day)
    own = [n for n in ft.LAG_NAMES + ft.ROLLING_NAMES + ft.CHANGE_NAMES]
    assert all(clean[at][n] == bumped[at][n] for n in own)
    after = at + dt.timedelta(days=1)
    assert bumped[after].temp_lag_1d == clean[after].temp_lag_1d + 100.0
    assert min(clean) == dt.date(2024, 1, 2)  # the first day has no history
    assert len(clean[at]) == 78


def test_feature_blocks_equal_plain(spark):
    daily = _daily(spark)
    plain = ft.feature_mart(daily, as_of="2030-01-01").orderBy("date").collect()
    blocks = ft.feature_mart(daily, as_of="2030-01-01", limit=5, block_rows=30).orderBy("date").collect()
    assert plain == blocks


def test_regular_days(spark):
    rows = [("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 4), 2.0)]
    df = spark.createDataFrame(rows, "location_name string, date date, v double")
    got = ft.regular_days(df, SeriesSpec(time="date")).orderBy("date").collect()
    assert [r.v for r in got] == [1.0, None, None, 2.0]


def test_beside_keeps_rows_and_reuses_row(spark):
    df = spark.range(5)
    row = spark.range(1).select(F.lit(3).alias("a"), F.lit("x").alias("b"))
    got = frames.beside(df, row).collect()
    assert [(r.id, r.a, r.b) for r in got] == [(i, 3, "x") for i in range(5)]
