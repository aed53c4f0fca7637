"""Regression on the feature mart with MLlib, evaluated in time order."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.operators.dimensions import join_dimension
from gaugeline.operators.frames import beside
from gaugeline.operators.profile import count_to_reach, cumulative_share
from gaugeline.operators.quantiles import quantiles
from gaugeline.schema import MODEL_FEATURES, TARGET
from gaugeline.session import new_path, written
from gaugeline.ship import ship

# -- data --------------------------------------------------------------------------------------


def model_frame(features: DataFrame, columns: Sequence[str] = MODEL_FEATURES, target: str = TARGET) -> DataFrame:
    """The model's inputs as doubles, with the keys and the target as ``label``."""
    return features.select(
        "location_name", "date", F.col(target).cast("double").alias("label"), *[F.col(c).cast("double").alias(c) for c in columns]
    )


def target_summary(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.count("label").alias("n"), F.avg("label").alias("mean"), F.stddev_samp("label").alias("std"),
        F.min("label").alias("min"), F.max("label").alias("max"),
    )


def impute_means(frame: DataFrame, fitted_on: DataFrame | None = None, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Replace NULLs by column means, taken from ``fitted_on`` (the training part; by default
    the frame itself). As when MLlib fits a transformer, one row of means comes back."""
    means = (frame if fitted_on is None else fitted_on).agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return frame.na.fill({c: m for c, m in means.items() if m is not None})


def split_by_time(frame: DataFrame, share: float = 0.8, day: str = "date") -> DataFrame:
    """Add ``split``: ``train`` strictly before the date quantile, ``test`` from it on."""
    days = frame.select(F.unix_date(day).alias("_day"))
    at = quantiles(days, ["_day"], [share]).select(F.col("quantile").alias("_split"))
    return (
        beside(frame, at)
        .withColumn("split", F.when(F.unix_date(day) < F.col("_split"), "train").otherwise("test"))
        .drop("_split")
    )


def split_summary(split: DataFrame, day: str = "date") -> DataFrame:
    sizes = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("records"), F.min(day).alias("first_date"), F.max(day).alias("last_date")
    )
    total = split.agg(F.count(F.lit(1)).alias("_n"))
    return beside(sizes, total).withColumn("pct", F.col("records") * 100.0 / F.col("_n")).drop("_n")


def standardise(frame: DataFrame, fitted_on: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """(x - mean) / population sd of the training part; a constant column becomes zero."""
    row = fitted_on.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    scaled = {c: f"(`{c}` - {row[f'm_{c}'] or 0.0!r}D) / {row[f's_{c}'] or 1.0!r}D as `{c}`" for c in columns}
    return frame.selectExpr(*[scaled.get(c, f"`{c}`") for c in frame.columns])


def assemble(frame: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")
    return vectors.transform(frame).select(*[c for c in frame.columns if c not in columns], "features")


def training_set(frame: DataFrame, columns: Sequence[str] = MODEL_FEATURES, partitions: int | None = None) -> DataFrame:
    """Assembled rows spread over the cluster's cores. Tree learners pass over their input once
    per level, so a compact mart must not leave them on the few tasks its files amount to."""
    parts = partitions or frame.sparkSession.sparkContext.defaultParallelism
    return assemble(frame.repartition(parts, "location_name", "date"), columns)


# -- models ------------------------------------------------------------------------------------


def least_squares() -> LinearRegression:
    """Inputs that determine each other leave the weights open, but not the predictions; the solver then
    iterates, on the moments only, to a tight tolerance."""
    return LinearRegression(solver="normal", regParam=0.0, maxIter=5000, tol=1e-15)


def penalised(label_sd: float, l1: float, l2: float) -> LinearRegression:
    """Least squares with the penalties of 1/(2n) RSS + l1 |w| + l2/2 |w|^2 on inputs that are
    already standardised.

    MLlib divides the label by its population sd while it fits, which leaves an L1 weight as it
    is and divides an L2 weight by that sd. The normal solver reads the data once, whatever the
    penalty, and iterates on the moments only.
    """
    reg = l1 + l2 * label_sd
    return LinearRegression(
        solver="normal", standardization=False, regParam=reg, elasticNetParam=l1 / reg if reg else 0.0, maxIter=2000, tol=1e-12
    )


def label_scale(train: DataFrame) -> tuple[float, int]:
    row = train.agg(F.stddev_pop("label").alias("s"), F.count("label").alias("n")).first()
    return row["s"], row["n"]


def ridge(label_sd: float, rows: int, alpha: float = 1.0) -> LinearRegression:
    """RSS + alpha |w|^2."""
    return penalised(label_sd, 0.0, alpha / rows)


def lasso(label_sd: float, rows: int, alpha: float = 0.1) -> LinearRegression:
    return penalised(label_sd, alpha, 0.0)


def elastic_net(label_sd: float, rows: int, alpha: float = 0.1, ratio: float = 0.5) -> LinearRegression:
    return penalised(label_sd, alpha * ratio, alpha * (1 - ratio))


def decision_tree(depth: int = 10, min_split: int = 20, seed: int = 42) -> DecisionTreeRegressor:
    """MLlib bounds the rows of a child rather than of a node to be split, hence the half."""
    return DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=max(1, min_split // 2), seed=seed)


def random_forest(trees: int = 100, depth: int = 15, min_split: int = 10, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=max(1, min_split // 2), featureSubsetStrategy="all",
        subsamplingRate=1.0, seed=seed, maxMemoryInMB=1024,
    )


def gradient_boosting(rounds: int = 100, depth: int = 5, rate: float = 0.1, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, checkpointInterval=10)


# -- linear fits from moments ------------------------------------------------------------------


def moments(frame: DataFrame, columns: Sequence[str] = MODEL_FEATURES, by: str | None = None) -> dict[int, np.ndarray]:
    """Sums of products of (1, inputs, label) for each value of ``by`` (a small whole number), in one pass:
    each task adds up its own rows, and only these matrices are shuffled. Inputs far from zero should be
    standardised before, or digits of their variance are lost."""
    ship(frame.sparkSession)
    width = len(columns) + 2
    group = F.lit(0) if by is None else F.col(by)
    used = frame.select(group.cast("int").alias("g"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate([*columns, "label"])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            groups = batch["g"].to_numpy()
            rows = np.column_stack([np.ones(batch.num_rows), *[batch[f"x{i}"].to_numpy() for i in range(width - 1)]])
            for g in np.unique(groups).tolist():
                own = rows[groups == g]
                sums[g] = sums.get(g, 0.0) + own.T @ own
        for g, found in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([g] * width**2, pa.int32()), pa.array(range(width**2), pa.int32()), pa.array(found.ravel())], ["g", "at", "v"])

    cells = used.mapInArrow(run, "g int, at int, v double").groupBy("g", "at").agg(F.sum("v").alias("v")).toArrow()
    out: dict[int, np.ndarray] = {}
    for g, at, v in zip(*(cells[c].to_pylist() for c in ("g", "at", "v"))):
        out.setdefault(g, np.zeros(width**2))[at] = v
    return {g: out[g].reshape(width, width) for g in sorted(out)}


def solved(sums: np.ndarray, alpha: float = 0.0, least: float = 1e-12) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise RSS + alpha |w|^2 on standardised inputs, w in units of these; from
    the sums alone. Directions with no more than ``least`` of a standardised input's variance, as inputs that
    determine each other leave them, get no weight."""
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    cross = sums[1:, 1:] - n * np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cross)[:-1], 0.0) / n)
    sd[sd <= 1e-12 * np.maximum(1.0, np.abs(mean[:-1]))] = 1.0
    gram, right = cross[:-1, :-1] / np.outer(sd, sd), cross[:-1, -1] / sd
    size, direction = np.linalg.eigh(gram)
    kept = size > least * n
    weights = direction[:, kept] @ ((direction[:, kept].T @ right) / (size[kept] + alpha)) / sd
    return float(mean[-1] - mean[:-1] @ weights), weights


def with_line(frame: DataFrame, intercept: float, weights: np.ndarray, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Add ``prediction`` of a linear fit."""
    terms = [F.col(c) * F.lit(float(w)) for c, w in zip(columns, weights)]
    return frame.withColumn("prediction", sum(terms, F.lit(intercept)))


def squared_error(sums: np.ndarray, intercept: float, weights: np.ndarray) -> float:
    """Mean squared error of a linear fit over the rows that the sums hold."""
    line = np.concatenate([[-intercept], -weights, [1.0]])
    return float(max(0.0, line @ sums @ line) / sums[0, 0])


def linear_cv(frame: DataFrame, columns: Sequence[str] = MODEL_FEATURES, splits: int = 5, alpha: float = 0.0) -> DataFrame:
    """Train on everything before block k, test on block k: (fold, rmse) of linear fits. The data are read
    once: sums of products add up over the blocks, and both the fit and its error follow from them."""
    sums = moments(time_blocks(frame, splits + 1), columns, "fold")
    rows, before = [], np.zeros((len(columns) + 2,) * 2)
    for fold in range(splits + 1):
        if fold and fold in sums and before[0, 0]:
            rows.append((fold, squared_error(sums[fold], *solved(before, alpha)) ** 0.5))
        before = before + sums.get(fold, 0.0)
    return frame.sparkSession.createDataFrame(rows, "fold int, rmse double")


# -- evaluation --------------------------------------------------------------------------------


def mean_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    return beside(test, train.agg(F.avg("label").alias("prediction")))


def last_value_baseline(test: DataFrame) -> DataFrame:
    return test.withColumn("prediction", F.col("temp_lag_1d"))


def metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """mse, rmse, mae, r2, mape (percent), median_ae, max_error of ``prediction`` against
    ``label``; one row, or one per group."""
    scored = predictions.withColumns(
        {"_e": F.col("label") - F.col("prediction"), "_ae": F.abs(F.col("label") - F.col("prediction"))}
    )
    # Fixed value: the denominator's floor in relative errors.
    relative = F.col("_ae") / F.greatest(F.abs("label"), F.lit(2.220446049250313e-16))
    sums = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("_e") * F.col("_e")).alias("mse"),
        F.avg("_ae").alias("mae"),
        (1.0 - F.sum(F.col("_e") * F.col("_e")) / (F.var_pop("label") * F.count("label"))).alias("r2"),
        (F.avg(relative) * 100.0).alias("mape"),
        F.max("_ae").alias("max_error"),
    )
    medians = quantiles(scored, ["_ae"], [0.5], by).select(*by, F.col("quantile").alias("median_ae"))
    joined = sums.join(medians, list(by)) if by else beside(sums, medians)
    return joined.select(*by, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", "r2", "mape", "median_ae", "max_error")


def residuals(predictions: DataFrame) -> DataFrame:
    error = F.col("label") - F.col("prediction")
    return predictions.select(
        "date",
        F.col("location_name").alias("location"),
        F.col("label").alias("actual_temperature"),
        F.col("prediction").alias("predicted_temperature"),
        error.alias("residual"),
        F.abs(error).alias("absolute_error"),
    )


def residual_summary(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"),
        F.min("residual").alias("min"), F.max("residual").alias("max"),
    )


def compare(predictions: DataFrame) -> DataFrame:
    """Metrics of each ``model`` in a table of (model, label, prediction), best RMSE first."""
    return metrics(predictions, ["model"]).select("model", "rmse", "mae", "r2", "mape").orderBy("rmse", "model")


def best(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy("rmse", "model").limit(1)


def importances(spark: SparkSession, model, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """(feature, importance, position, cumulative): one row per model input."""
    pairs = [(name, float(value)) for name, value in zip(columns, model.featureImportances.toArray())]
    return cumulative_share(spark.createDataFrame(pairs, "feature string, importance double"), "importance", "feature")


def features_to_reach(shares: DataFrame, levels: Sequence[float] = (0.9, 0.95)) -> DataFrame:
    return count_to_reach(shares, levels)


# -- validation and tuning ---------------------------------------------------------------------


def time_blocks(frame: DataFrame, blocks: int, into: str = "fold", day: str = "date") -> DataFrame:
    """Number consecutive stretches of time with about equally many rows, 0 to blocks - 1. All
    rows of a day share a block. Works on counts per day, of which a calendar has few."""
    per_day = frame.groupBy(day).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    placed = per_day.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    total = per_day.agg(F.sum("_n").alias("_total"))
    block = F.least(F.floor(F.col("_before") * blocks / F.col("_total")), F.lit(blocks - 1)).cast("int")
    return join_dimension(frame, beside(placed, total).select(day, block.alias(into)), day, "inner")


def expanding_cv(frame: DataFrame, estimators: dict, splits: int = 5) -> DataFrame:
    """Train on everything before block k, test on block k: (model, fold, rmse)."""
    folded = written(time_blocks(frame, splits + 1), "folds")
    rows = []
    for k in range(1, splits + 1):
        train, test = folded.filter(F.col("fold") < k), folded.filter(F.col("fold") == k)
        for name, estimator in estimators.items():
            scored = estimator.fit(train).transform(test)
            error = F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))
            rows.append((name, k, scored.agg(error).first()[0]))
    return frame.sparkSession.createDataFrame(rows, "model string, fold int, rmse double")


def cv_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("model").agg(F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"))


# The full forest grid. Its split bound and leaf bound are both bounds on the rows
# of a child here, so the two lists fold into one parameter.
FOREST_GRID = {"trees": (50, 100, 150), "depth": (10, 15, 20), "min_split": (10, 20, 30), "min_leaf": (1, 2, 4)}


def leaf_bounds(min_split: Sequence[int] = FOREST_GRID["min_split"], min_leaf: Sequence[int] = FOREST_GRID["min_leaf"]) -> list[int]:
    """The bounds on the rows of a child that the two lists amount to."""
    return sorted({max(leaf, split // 2) for split in min_split for leaf in min_leaf})


def node_table(model) -> DataFrame:
    """The nodes of a fitted tree ensemble: ``tree``, ``id``, ``prediction`` (the mean of the node's rows),
    ``feature`` and ``threshold`` of its split, ``left`` (taken at or below it) and ``right``, -1 in a leaf."""
    spark = SparkSession.active()
    path = new_path(spark, "model")
    model.save(path)
    node = spark.read.parquet(f"{path}/data")
    return node.select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.split.featureIndex").alias("feature"), F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
    )


def smaller_forests(rows: DataFrame, nodes: DataFrame, trees: Sequence[int], depths: Sequence[int]) -> DataFrame:
    """Predictions of all smaller forests within one: of its first trees, each cut at a depth, where a node's
    own mean is what the tree would predict. Adds ``predictions``, by rising trees and then depth. The
    nodes, as large as the model, which fits the driver, go to every task."""
    ship(rows.sparkSession)
    trees, depths = sorted(trees), sorted(depths)
    table = nodes.filter(F.col("tree") < trees[-1]).orderBy("tree", "id").toArrow()
    first = np.searchsorted(table["tree"].to_numpy(), np.arange(trees[-1]))  # ids count from 0 within a tree
    feature, threshold, left, right, mean = (table[c].to_numpy() for c in ("feature", "threshold", "left", "right", "prediction"))
    spread = rows.withColumn("_x", vector_to_array("features")).drop("features")
    schema = spread.drop("_x").withColumn("predictions", F.array(F.lit(0.0))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack(batch["_x"].to_pylist()) if batch.num_rows else np.zeros((0, 1))
            sums, out, each = np.zeros((batch.num_rows, len(depths))), [], np.arange(batch.num_rows)
            for t in range(trees[-1]):
                at, found = np.full(batch.num_rows, first[t]), []
                for depth in range(depths[-1] + 1):
                    if depth in depths:
                        found.append(mean[at])
                    inner = left[at] >= 0
                    below = x[each, np.where(inner, feature[at], 0)] <= threshold[at]
                    at = np.where(inner, first[t] + np.where(below, left[at], right[at]), at)
                sums += np.stack(found, axis=1)
                out += [sums / (t + 1)] if t + 1 in trees else []
            values = np.concatenate(out, axis=1)
            width = values.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * width, pa.int32()), pa.array(values.ravel()))
            names = [n for n in batch.schema.names if n != "_x"]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], lists], [*names, "predictions"])

    return spread.mapInArrow(run, schema)


def forest_search(
    frame: DataFrame, columns: Sequence[str] = MODEL_FEATURES, trees: Sequence[int] = FOREST_GRID["trees"],
    depths: Sequence[int] = FOREST_GRID["depth"], bounds: Sequence[int] | None = None, folds: int = 3, parallelism: int = 4,
    partition_rows: int = 50_000, seed: int = 42,
) -> DataFrame:
    """(params, rmse) of every combination of trees, depth and leaf bound, best first: the mean over ``folds``
    consecutive stretches of time, each held out once, with NULLs filled by the means of the others.

    One forest is fitted for each fold and leaf bound, with the most trees and the greatest depth; all
    smaller ones are read from its nodes, so combinations share trees. A learner passes statistics of every
    node between partitions, so the input has no more of them than its rows need; a small one keeps one task
    busy, and ``parallelism`` fits run beside each other, each with a bounded part of the memory.
    """
    spark = frame.sparkSession
    folded = written(time_blocks(frame, folds), "folds")
    bounds = leaf_bounds() if bounds is None else sorted(bounds)
    trees, depths = sorted(trees), sorted(depths)
    grid = list(product(trees, depths))
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    filled = {k: written(impute_means(folded, folded.filter(F.col("fold") != k), columns), "fold") for k in sizes}

    def scored(task: tuple[int, int]) -> list[tuple]:
        fold, bound = task
        parts = max(1, -(-(sum(sizes.values()) - sizes[fold]) // partition_rows))
        train, test = filled[fold].filter(F.col("fold") != fold), filled[fold].filter(F.col("fold") == fold)
        forest = random_forest(trees[-1], depths[-1], 2 * bound, seed).setMaxMemoryInMB(256)
        found = smaller_forests(assemble(test, columns), node_table(forest.fit(training_set(train, columns, parts))), trees, depths)
        errors = [F.avg((F.col("label") - F.get("predictions", F.lit(i))) ** 2) for i in range(len(grid))]
        return [(fold, n, d, bound, e**0.5) for (n, d), e in zip(grid, found.agg(*errors).first())]

    with ThreadPool(parallelism) as pool:
        rows = [r for part in pool.map(scored, list(product(sorted(sizes), bounds))) for r in part]
    scores = spark.createDataFrame(rows, "fold int, numTrees int, maxDepth int, minInstancesPerNode int, rmse double")
    means = scores.groupBy("maxDepth", "minInstancesPerNode", "numTrees").agg(F.avg("rmse").alias("rmse"))
    params = F.to_json(F.struct("maxDepth", "minInstancesPerNode", "numTrees"))
    return means.select(params.alias("params"), "rmse").orderBy("rmse", "params")


def best_forest(scores: DataFrame, seed: int = 42) -> RandomForestRegressor:
    """A forest of the parameters with the lowest error; of equal ones the first by name."""
    params = json.loads(scores.orderBy("rmse", "params").first()["params"])
    return random_forest(params["numTrees"], params["maxDepth"], 2 * params["minInstancesPerNode"], seed)


def forecast_pipeline(train: DataFrame, estimator, columns: Sequence[str] = MODEL_FEATURES) -> PipelineModel:
    """Imputation, scaling (by the population sd, as ``standardise``), assembly and model as one fitted,
    storable unit."""
    columns, rows = list(columns), train.count()
    stages = [
        Imputer(strategy="mean", inputCols=columns, outputCols=columns),
        VectorAssembler(inputCols=columns, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="sample_features", withMean=True, withStd=True),
        ElementwiseProduct(
            scalingVec=Vectors.dense([(rows / max(rows - 1, 1)) ** 0.5] * len(columns)), inputCol="sample_features", outputCol="features"
        ),
        estimator,
    ]
    return Pipeline(stages=stages).fit(train)


def model_record(spark: SparkSession, model: PipelineModel, scores: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """One row for the store beside a model: its parameters and their search error, and its inputs in order."""
    top = scores.orderBy("rmse", "params").first()
    rows = [(type(model.stages[-1]).__name__, top["params"], top["rmse"], list(columns))]
    return spark.createDataFrame(rows, "model string, params string, rmse double, features array<string>")


def save_model(model: PipelineModel, path: str) -> None:
    """The inputs' names are part of the stored assembler stage."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def verify_forecasts(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Fill actuals and errors of stored predictions from the daily mart."""
    known = actuals.select(
        "location_name",
        F.col("date").alias("forecast_date"),
        F.col("avg_temperature").alias("_t"),
        F.col("total_precipitation").alias("_p"),
        F.col("avg_humidity").alias("_h"),
    )
    joined = predictions.join(known, ["location_name", "forecast_date"], "left")
    return joined.withColumns(
        {
            "actual_temperature": F.col("_t"),
            "actual_precipitation": F.col("_p"),
            "actual_humidity": F.col("_h"),
            "temperature_error": F.col("predicted_temperature") - F.col("_t"),
            "precipitation_error": F.col("predicted_precipitation") - F.col("_p"),
            "absolute_error": F.abs(F.col("predicted_temperature") - F.col("_t")),
        }
    ).select(*predictions.columns)
