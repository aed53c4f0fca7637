"""Norm-bucketed retrieval against all products, on vectors of like and of widely spread lengths."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import inner_products as ip

SCHEMA = "vec_id bigint, embedding array<float>, key int, row string, shard string, _l int, score double"


def _plain(rows, every=20, k=20):
    whole = []
    for key, v in rows:
        if v is not None and not any(x is None or not np.isfinite(x) for x in v):
            whole.append((key, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    out = []
    for i, (key, v) in enumerate(whole):
        if key is None or key % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), other is None, other or 0) for j, (other, w) in enumerate(whole) if j != i]
        out += [(key, n + 1, None if none else other, -s) for n, (s, none, other) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def _vectors(kind):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(400, 12))
    if kind == "spread":  # lengths over three orders of magnitude, and groups of near copies
        base *= np.exp(draw.uniform(-4, 3, size=(400, 1)))
        base[100:160] = base[0] + draw.normal(scale=1e-2, size=(60, 12))
    if kind == "alike":
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        base[100:160] = base[20]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(i, v) for i, v in rows[:3]] + [(None, rows[5][1]), (None, rows[5][1])]  # repeated rows, null keys
    rows += [(400, None), (420, [1.0, None]), (440, [float("nan")] * 12), (460, [float("inf")] + [0.0] * 11)]
    return [*rows, (480, []), (500, [0.0] * 12), (520, [1.0, -2.0]), (540, [0.5] * 20)]


@pytest.mark.parametrize("kind", ["spread", "alike"])
def test_all_products(spark, kind):
    rows = _vectors(kind)
    table = spark.createDataFrame([(k, v, 1, "r", "s", 2, 0.5) for k, v in rows], SCHEMA).repartition(3)
    for setting in (ip.Retrieval(), ip.Retrieval(shard=40, bucket=16, queries=3, narrow=0.2, gain=2)):
        found = ip.top_products(table, F.col("key") % 20 == 0, setting)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert Counter(map(tuple, found.collect())) == _plain(rows)


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0])]
    table = spark.createDataFrame([(k, v, 1, "r", "s", 2, 0.5) for k, v in rows], SCHEMA)
    assert Counter(map(tuple, ip.top_products(table, F.col("key") % 20 == 0).collect())) == _plain(rows)
    assert ip.top_products(table.filter("vec_id > 5"), F.col("key") % 20 == 0).collect() == []
    assert ip.top_products(table.filter("vec_id = 1"), F.col("key") % 20 == 0).collect() == []


def test_both_ways_of_pruning_keep_what_counts():
    draw = np.random.default_rng(5)
    vectors = np.floor(64 * draw.normal(size=(300, 16))).astype(np.int32)
    vectors[50:80] = vectors[0] + draw.integers(-1, 2, size=(30, 16))
    setting = ip.Retrieval(k=5, bucket=64, narrow=0.3, gain=2)
    shard = ip.Shard(vectors, np.arange(300), setting)
    products = vectors.astype(np.int64) @ vectors[:20].T.astype(np.int64)
    floors = np.sort(np.where(np.eye(300, 20, dtype=bool), -(1 << 40), products), axis=0)[-5].astype(float)
    used = Counter()
    shard_range = shard.in_range
    shard.in_range = lambda *a: (out := shard_range(*a), used.update([out is None]))[0]
    q, place, score = shard.best(vectors[:20], np.arange(20), floors)
    want = {(i, j, int(products[j, i])) for i in range(20) for j in range(300) if i != j and products[j, i] >= floors[i]}
    assert set(zip(q.tolist(), place.tolist(), score.tolist())) == want
    assert used[True] and used[False]  # length pruning and coordinate pruning both took part


def test_scores_beyond_32_bits_are_exact():
    vectors = np.array([[1 << 28, 3], [(1 << 28) + 1, -5], [7, 1 << 27]], np.int32)
    shard = ip.Shard(vectors, np.arange(3), ip.Retrieval())
    q, place, score = shard.best(vectors[:1], np.array([0]), np.array([-np.inf]))
    assert dict(zip(place.tolist(), score.tolist())) == {1: (1 << 28) * ((1 << 28) + 1) - 15, 2: (7 << 28) + (3 << 27)}


def test_too_long_a_vector_is_an_error(spark):
    table = spark.createDataFrame([(0, [3e38], 1, "r", "s", 2, 0.5)], SCHEMA)
    with pytest.raises(Exception, match="vector too long"):
        ip.top_products(table, F.col("key") % 20 == 0).collect()


def test_matrix_fills_up_with_zeros():
    column = pa.array([[1, 2, 3], [], [4]], pa.list_(pa.int32()))
    assert ip.matrix(column.slice(1)).tolist() == [[0], [4]]
    assert ip.matrix(column).tolist() == [[1, 2, 3], [0, 0, 0], [4, 0, 0]]
