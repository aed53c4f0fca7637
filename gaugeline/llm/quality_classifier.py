"""Quality scores: random Fourier features over document statistics, ridge regression from summed
normal equations, isotonic calibration.

The features cos(Wx + b) of standardised statistics x approximate a Gaussian kernel, so a linear fit
on them is a kernel machine whose training state, one square matrix, is summed over partitions and
does not grow with the rows. The raw scores of the training rows are counted in fixed bins, and
pooling neighbours that are out of order makes them probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.quality_rules import CONTINUED, LOWER, SHOUT, SYMBOLS, UPPER, Rules, judge
from gaugeline.llm.texts import SMALL_SLICE, SPACE, batch_of, bytes_of, filled, map_texts, pa_schema, sums, table_of
from gaugeline.session import written
from gaugeline.ship import ship

DIGIT, STOP, COMMA = table_of("0123456789"), table_of(".?"), table_of(",;:")
QUOTE, BAR, BREAK, DASH = table_of("\"'()[]{}"), table_of("|"), table_of("\n"), table_of("-_=/\\+~^@`")
STATISTICS = 20


@dataclass(frozen=True)
class Settings:
    features: int = 128  # random Fourier features
    width: float = 4.0  # kernel width in standard deviations
    ridge: float = 1e-3  # penalty for each training row
    bins: int = 512  # of raw scores, for the calibration
    clip: float = 6.0  # statistics are cut off at so many standard deviations
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """Everything that scoring needs; its size depends on the settings only."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    at: np.ndarray  # raw scores and
    value: np.ndarray  # calibrated scores, to interpolate between
    settings: Settings

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.value), 0.0, 1.0)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.spread, self.settings) @ self.weights


def statistics(texts: pa.Array) -> np.ndarray:
    """Statistics of each text: counts and shares, nothing of the words themselves."""
    data, offsets = bytes_of(texts)
    judged = judge(texts, Rules())
    count = lambda table: sums(table[data], offsets).astype(float)
    words = judged["n_words"].astype(float)
    chars = judged["word_chars"].astype(float)
    one, letters = np.maximum(words, 1), np.maximum(count(UPPER) + count(LOWER), 1)
    every = np.maximum(sums(~CONTINUED[data], offsets).astype(float), 1)
    lines = count(BREAK) + 1
    lists = pc.ascii_split_whitespace(texts)
    at = lists.offsets.to_numpy().astype(np.int64)
    lengths = pc.utf8_length(lists.values.slice(at[0], at[-1] - at[0])).to_numpy(zero_copy_only=False)
    at = at - at[0]
    columns = [
        np.log1p(words), np.log1p(lines), chars / one, np.sqrt(sums(lengths**2, at) / one), sums(lengths == 1, at) / one,
        sums(lengths > 20, at) / one, count(SYMBOLS) / one, count(SHOUT) / one, count(UPPER) / letters, count(DIGIT) / every,
        sums(data >= 128, offsets) / every, count(STOP) / one, count(COMMA) / one, count(QUOTE) / one, count(BAR) / one,
        count(DASH) / one, count(SPACE) / every, judged["n_dup_lines"] / lines, judged["n_repeat_words"] / one, judged["n_lost_words"] / one,
    ]
    return np.column_stack(columns)


def fourier(x: np.ndarray, mean: np.ndarray, spread: np.ndarray, settings: Settings) -> np.ndarray:
    """A constant and the random Fourier features of each row."""
    draw = np.random.default_rng(settings.seed)
    w = draw.normal(size=(x.shape[1], settings.features)) / settings.width
    b = draw.uniform(0, 2 * np.pi, settings.features)
    scaled = np.clip((x - mean) / spread, -settings.clip, settings.clip)
    return np.column_stack([np.ones(len(x)), np.sqrt(2 / settings.features) * np.cos(scaled @ w + b)])


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values``: neighbours out of order are pooled."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def held_out(key: Column) -> Column:
    """Rows never learned from: the remainder by 3 of the crc32 of the key as text is 1. Rows
    without a key are among them."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(True))


def features(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_key``, ``x`` of every row."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(filled(batch["_text"]))
        at = np.arange(len(x) + 1, dtype=np.int32) * STATISTICS
        return batch_of(_key=batch["_key"], x=pa.ListArray.from_arrays(pa.array(at), pa.array(x.ravel())))

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    return map_texts(narrow, work, f"_key {kind}, x array<double>", "_text", SMALL_SLICE)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, STATISTICS)


def _summed(rows: DataFrame, partial, size: int) -> np.ndarray:
    """The sum over all partitions of the ``size`` numbers that ``partial(x, y)`` returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total, some = total + partial(_matrix(batch["x"]), batch["y"].to_numpy()), True
        if some:
            at = np.flatnonzero(total)
            yield batch_of(i=at.astype(np.int32), v=total[at])

    found = rows.select("x", "y").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for row in found:  # as many as the settings say, whatever the input
        out[row["i"]] = row["v"]
    return out


def fit(featured: DataFrame, labels: DataFrame, label: str = "quality", label_key: str = "doc_id", settings: Settings = Settings()) -> Model:  # noqa: B008
    """Learn from the rows of ``featured`` that have a label and are not held out.

    Rows of ``labels`` without a key or label are left out, and repeated labels of a key count once
    with their mean. With no labelled row at all every score is 0.5.
    """
    ship(featured.sparkSession)
    marks = labels.select(labels[label_key].alias("_label_key"), labels[label].cast("double").alias("y"))
    marks = marks.filter("_label_key is not null and y is not null").groupBy("_label_key").agg(F.avg("y").alias("y"))
    learned = featured.filter(~held_out(F.col("_key"))).join(marks, F.col("_key") == F.col("_label_key")).select("x", "y")
    rows = written(learned, "training")
    d, k = STATISTICS, settings.features + 1
    moments = _summed(rows, lambda x, y: np.concatenate([x.sum(0), (x * x).sum(0), [len(x)]]), 2 * d + 1)
    n = moments[-1]
    if not n:
        return Model(np.zeros(d), np.ones(d), np.zeros(k), np.array([0.0]), np.array([0.5]), settings)
    mean = moments[:d] / n
    spread = np.sqrt(np.maximum(moments[d : 2 * d] / n - mean**2, 0))
    spread = np.where(spread > 1e-9, spread, 1.0)

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier(x, mean, spread, settings)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums_ = _summed(rows, normal, k * k + k)
    penalty = settings.ridge * n * np.eye(k)
    penalty[0, 0] = 0
    weights = np.linalg.solve(sums_[: k * k].reshape(k, k) + penalty + 1e-9 * np.eye(k), sums_[k * k :])

    low, high, bins = -0.5, 1.5, settings.bins

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = fourier(x, mean, spread, settings) @ weights
        b = np.clip(((raw - low) / (high - low) * bins).astype(int), 0, bins - 1)
        return np.concatenate([np.bincount(b, minlength=bins), np.bincount(b, y, bins), np.bincount(b, raw, bins)])

    count, ones, raw = _summed(rows, binned, 3 * bins).reshape(3, bins)
    some = count > 0
    value = isotonic(ones[some] / count[some], count[some])
    return Model(mean, spread, weights, raw[some] / count[some], value, settings)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """``key``, ``held_out``, ``score`` and ``predicted`` of every row.

    A null text counts as empty and is scored like any other; a null key stays null and is held out;
    repeated rows are scored alike. Other columns are not read, and an empty table gives no rows.
    """
    featured = written(features(docs, key, text), "statistics")
    model = fit(featured, labels, settings=settings)
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"_key {kind}, score double"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch_of(_key=batch["_key"], score=model.score(_matrix(batch["x"]))).cast(schema)

    return featured.mapInArrow(run, ddl).select(
        F.col("_key").alias(key), held_out(F.col("_key")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def kept_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:  # noqa: B008
    """The rows predicted to be of quality, unchanged, with all their columns."""
    # Learning needs the statistics next to the labels, not the texts; the texts are scored where
    # they lie, which computes statistics twice but moves no text.
    model = fit(written(features(docs, key, text), "statistics"), labels, settings=settings)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.score(statistics(filled(batch[text]))) >= 0.5))

    return map_texts(docs, work, docs.schema, text, SMALL_SLICE)
