"""Fitted models against closed forms, time splits and folds."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.operators import regression as rg

COLUMNS = ("x0", "x1", "x2")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) * [1.0, 5.0, 0.3] + [2.0, -1.0, 0.0]
    x[:, 2] += 0.5 * x[:, 0]
    y = x @ [1.5, -0.4, 2.0] + 7 + rng.normal(scale=0.5, size=300)
    start = dt.date(2024, 1, 1)
    rows = [("a" if i % 2 else "b", start + dt.timedelta(days=i // 2), float(y[i]), *map(float, x[i])) for i in range(300)]
    frame = spark.createDataFrame(rows, "location_name string, date date, label double, x0 double, x1 double, x2 double")
    z = (x - x.mean(0)) / x.std(0)
    return frame, z, y


def _fit(frame, estimator):
    scaled = rg.standardise(frame, frame, COLUMNS)
    return np.array(estimator.fit(rg.assemble(scaled, COLUMNS)).coefficients)


def _descent(z, y, l1, l2):
    n, k = z.shape
    w, r = np.zeros(k), y - y.mean()
    for _ in range(5000):
        for j in range(k):
            partial = r - z @ w + z[:, j] * w[j]
            rho = z[:, j] @ partial / n
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (z[:, j] @ z[:, j] / n + l2)
    return w


def test_least_squares(data):
    frame, z, y = data
    assert _fit(frame, rg.least_squares()) == pytest.approx(np.linalg.lstsq(z, y - y.mean(), rcond=None)[0], abs=1e-8)


def test_ridge(data):
    frame, z, y = data
    expected = np.linalg.solve(z.T @ z + 25.0 * np.eye(3), z.T @ (y - y.mean()))
    assert _fit(frame, rg.ridge(*rg.label_scale(frame), alpha=25.0)) == pytest.approx(expected, abs=1e-8)


def test_lasso(data):
    frame, z, y = data
    assert _fit(frame, rg.lasso(*rg.label_scale(frame), alpha=0.3)) == pytest.approx(_descent(z, y, 0.3, 0.0), abs=1e-5)


def test_elastic_net(data):
    frame, z, y = data
    got = _fit(frame, rg.elastic_net(*rg.label_scale(frame), alpha=0.4, ratio=0.5))
    assert got == pytest.approx(_descent(z, y, 0.2, 0.2), abs=1e-5)


def test_split_is_in_time_order(data):
    split = rg.split_by_time(data[0])
    train, test = (split.filter(f"split = '{p}'") for p in ("train", "test"))
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    assert train.count() + test.count() == 300


def test_imputation_uses_the_training_part(spark):
    rows = [("a", dt.date(2024, 1, i + 1), 1.0, v) for i, v in enumerate([1.0, 3.0, None, 100.0])]
    frame = spark.createDataFrame(rows, "location_name string, date date, label double, x0 double")
    filled = rg.impute_means(frame, frame.filter("date < '2024-01-04'"), ("x0",)).orderBy("date").collect()
    assert filled[2].x0 == 2.0
    whole = rg.impute_means(frame, columns=("x0",)).orderBy("date").collect()
    assert whole[2].x0 == pytest.approx(104 / 3)


def test_time_blocks_do_not_split_a_day(data):
    blocks = rg.time_blocks(data[0], 6)
    assert blocks.groupBy("date").agg(F.countDistinct("fold").alias("n")).filter("n > 1").isEmpty()
    sizes = [r["count"] for r in blocks.groupBy("fold").count().collect()]
    assert len(sizes) == 6 and min(sizes) == max(sizes) == 50


def test_expanding_cv(data, spark):
    frame = rg.assemble(data[0], COLUMNS)
    scores = rg.expanding_cv(frame, {"line": rg.least_squares()}, splits=3)
    assert scores.count() == 3 and 0.3 < rg.cv_summary(scores).first().rmse_mean < 0.8


def test_smaller_forests_are_those_fitted_to_their_size(data, spark):
    frame = rg.assemble(data[0].repartition(1), COLUMNS)
    whole = rg.decision_tree(depth=9, min_split=4)
    for depth in (1, 3, 5, 9):  # a tree of a lesser depth is the deep one cut off
        alone = rg.decision_tree(depth=depth, min_split=4).fit(frame).transform(frame)
        want = [r.prediction for r in alone.orderBy("date", "location_name").collect()]
        forest = rg.random_forest(trees=1, depth=9, min_split=4).setBootstrap(False).fit(frame)
        cut = rg.smaller_forests(frame, rg.node_table(forest), [1], [depth, 9]).orderBy("date", "location_name").collect()
        assert [r.predictions[0] for r in cut] == pytest.approx(want)
        deep = whole.fit(frame).transform(frame).orderBy("date", "location_name").collect()
        assert [r.predictions[-1] for r in cut] == pytest.approx([r.prediction for r in deep])
    forest = rg.random_forest(trees=7, depth=6).fit(frame)
    mine = rg.smaller_forests(frame, rg.node_table(forest), [2, 7], [3, 6]).orderBy("date", "location_name").collect()
    theirs = forest.transform(frame).orderBy("date", "location_name").collect()
    assert [r.predictions[3] for r in mine] == pytest.approx([r.prediction for r in theirs])
    first = [t.transform(frame).orderBy("date", "location_name").collect() for t in forest.trees[:2]]
    assert [r.predictions[1] for r in mine] == pytest.approx([(a.prediction + b.prediction) / 2 for a, b in zip(*first)])


def test_forest_search_scores_every_combination(data, spark):
    gaps = data[0].withColumn("x1", F.when(F.col("x1") > -9, F.col("x1")))
    scores = rg.forest_search(gaps, COLUMNS, trees=(2, 5), depths=(1, 3), bounds=(5, 40)).collect()
    seen = {r.params for r in scores}
    assert len(scores) == len(seen) == 8 and '{"maxDepth":3,"minInstancesPerNode":40,"numTrees":5}' in seen
    assert [r.rmse for r in scores] == sorted(r.rmse for r in scores)
    folded = rg.time_blocks(gaps, 3)
    errors = []  # the largest forest of one bound, fitted alone
    for k in range(3):
        train = folded.filter(F.col("fold") != k)
        filled = rg.impute_means(folded, train, COLUMNS)
        model = rg.random_forest(5, 3, 10).fit(rg.training_set(filled.filter(F.col("fold") != k), COLUMNS, 1))
        held_out = model.transform(rg.assemble(filled.filter(F.col("fold") == k), COLUMNS))
        errors.append(held_out.agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0])
    found = {r.params: r.rmse for r in scores}['{"maxDepth":3,"minInstancesPerNode":5,"numTrees":5}']
    assert found == pytest.approx(sum(errors) / 3, rel=0.05)  # rows may be drawn in another order
    assert rg.leaf_bounds() == [5, 10, 15]
    best = rg.best_forest(spark.createDataFrame(scores))
    assert f'"numTrees":{best.getNumTrees()}' in scores[0].params and f'"maxDepth":{best.getMaxDepth()}' in scores[0].params


def test_metrics(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)]
    row = rg.metrics(spark.createDataFrame(rows, "label double, prediction double")).first()
    y, p = np.array(rows).T
    assert row.mse == pytest.approx(((y - p) ** 2).mean()) and row.mae == pytest.approx(0.5) and row.max_error == 1.0
    assert row.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()) and row.median_ae == 0.5
    assert row.mape == pytest.approx(100 * (0.5 / 1 + 1 / 4) / 3)


def test_stored_pipeline_scores_the_same(data, tmp_path):
    frame = data[0].withColumn("x1", F.when(F.col("x1") > -9, F.col("x1")))
    model = rg.forecast_pipeline(frame, rg.least_squares(), COLUMNS)
    rg.save_model(model, str(tmp_path / "m"))
    again = rg.load_model(str(tmp_path / "m"))
    one, two = (sorted(r.prediction for r in m.transform(frame).collect()) for m in (model, again))
    assert one == two
    filled = rg.impute_means(frame, frame, COLUMNS)  # scaled by the population sd, as standardise does
    by_hand = rg.assemble(rg.standardise(filled, filled, COLUMNS), COLUMNS)
    first, second = (
        [list(r.features) for r in f.orderBy("date", "location_name").collect()] for f in (model.transform(frame), by_hand)
    )
    assert np.array(first) == pytest.approx(np.array(second))
    scores = frame.sparkSession.createDataFrame([('{"numTrees":3}', 0.5)], "params string, rmse double")
    record = rg.model_record(frame.sparkSession, model, scores, COLUMNS).first()
    assert record.features == list(COLUMNS) and record.rmse == 0.5 and record.params == '{"numTrees":3}'


def test_importances_are_ordered(data, spark):
    model = rg.random_forest(trees=5, depth=4).fit(rg.assemble(data[0], COLUMNS))
    shares = rg.importances(spark, model, COLUMNS).orderBy("position").collect()
    assert shares[-1].cumulative == pytest.approx(1.0) and shares[0].importance >= shares[1].importance
    reach = rg.features_to_reach(rg.importances(spark, model, COLUMNS)).first()
    assert 1 <= reach.n_90 <= reach.n_95 <= 3


def test_fits_from_moments(data):
    frame, z, y = data
    x = np.array([[r.x0, r.x1, r.x2] for r in frame.orderBy("date", F.desc("location_name")).collect()])
    intercept, weights = rg.solved(rg.moments(frame, COLUMNS)[0])
    exact = np.linalg.lstsq(np.column_stack([np.ones(300), x]), y, rcond=None)[0]
    assert [intercept, *weights] == pytest.approx(exact, abs=1e-8)
    ridge = rg.solved(rg.moments(frame, COLUMNS)[0], alpha=25.0)[1] * x.std(0)
    assert ridge == pytest.approx(np.linalg.solve(z.T @ z + 25.0 * np.eye(3), z.T @ (y - y.mean())), abs=1e-8)
    again = frame.withColumn("x3", F.col("x0") - F.col("x2")).withColumn("x4", F.lit(2.0))  # determined by others, constant
    twice = rg.with_line(again, *rg.solved(rg.moments(again, (*COLUMNS, "x3", "x4"))[0]), (*COLUMNS, "x3", "x4"))
    once = rg.with_line(frame, intercept, weights, COLUMNS)
    first, second = ([r.prediction for r in f.orderBy("date", "location_name").collect()] for f in (once, twice))
    assert first == pytest.approx(second, abs=1e-7)


def test_linear_folds_from_one_pass_equal_separate_fits(data):
    frame = data[0]
    found = {r.fold: r.rmse for r in rg.linear_cv(frame, COLUMNS).collect()}
    apart = rg.expanding_cv(rg.assemble(frame, COLUMNS), {"line": rg.least_squares()})
    assert found == pytest.approx({r.fold: r.rmse for r in apart.collect()}, abs=1e-6) and sorted(found) == [1, 2, 3, 4, 5]
    assert rg.linear_cv(frame.limit(0), COLUMNS).count() == 0
