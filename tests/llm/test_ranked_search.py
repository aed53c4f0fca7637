"""Ranked search against scoring every document, and the hybrid walk against plain sums."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm import ranked_search as rs

DOCS = "doc_id bigint, text string, term string, slice int, row int, item_id bigint, n int"
ITEMS = "item_id bigint, text string, term string, row string, doc_id bigint, weight int"
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(rs.UPPER, rs.SMALL)


def _terms(text):
    return [t.translate(LOWER) for t in TERMS.findall(text or "")]


def _plain(docs, items, k=10):
    counts = [(key, Counter(_terms(t))) for key, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        rows = []
        for (key, c), size in zip(counts, sizes):
            m = 10 + 90 * size * n // total if total else 10
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in set(_terms(text)) if c[t]
            )
            if score > 0:
                rows.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if none else key, -s) for i, (s, none, key) in enumerate(sorted(rows)[:k])]
    return Counter(out)


@pytest.fixture(scope="module")
def docs():
    draw = random.Random(7)
    vocabulary = [f"t{i}" for i in range(400)] + ["Éa", "日本", "ß9"]
    common = ["the", "De", "la", "und"]
    make = lambda n: " ".join(draw.choice(common) if draw.random() < 0.5 else draw.choice(vocabulary) + draw.choice(("", ",", ".", "\n")) for _ in range(n))
    texts = [None, "", " ... \t", "the", "THE the-la", *[make(draw.randint(1, 200)) for _ in range(300)], make(20_000), "x" * 4_000]
    out = list(enumerate(texts))
    return [*out, out[9], out[9], *[(1000 + i, out[10][1]) for i in range(40)], (None, out[10][1]), (None, None)]


@pytest.fixture(scope="module")
def items(docs):
    return [
        (0, docs[10][1]), (1, docs[50][1].upper()), (2, "the la de und"), (3, "t1 t2 t3 nowhere"), (4, None), (5, " -- "), (6, "nowhere"),
        (7, docs[305][1]), (7, "t5"), (7, "t5"), (None, "t9 the"), (8, "日本 Éa ß9 THE"),
    ]


@pytest.mark.parametrize("setting", [rs.Ranking(), rs.Ranking(slice_bytes=9_000, short=4, window=8, block=30)])
def test_every_document_scored(spark, docs, items, setting):
    table = spark.createDataFrame([(k, t, "t", 1, 2, 3, 4) for k, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(k, t, "t", "r", 5, 6) for k, t in items], ITEMS).repartition(2)
    found = rs.ranked_search(table, asked, setting)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == _plain(docs, items)


def test_empty_tables(spark, docs, items):
    table = spark.createDataFrame([(k, t, "t", 1, 2, 3, 4) for k, t in docs], DOCS)
    asked = spark.createDataFrame([(k, t, "t", "r", 5, 6) for k, t in items], ITEMS)
    assert rs.ranked_search(table.limit(0), asked).collect() == []
    assert rs.ranked_search(table, asked.limit(0)).collect() == []
    assert rs.ranked_search(table.filter("text IS NULL"), asked).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_hybrid_walk_equals_sums_whatever_the_window(seed):
    draw = np.random.default_rng(seed)
    count, terms = 500, list(range(12))
    sizes = draw.integers(1, 300, count)
    weights = draw.integers(0, 5000, len(terms)).tolist()
    lists = {t: np.sort(draw.choice(count, max(1, int(count * draw.random() ** 3)), replace=False)) for t in terms}
    for setting in (rs.Ranking(), rs.Ranking(k=3, short=2, window=16), rs.Ranking(short=1_000_000, window=64), rs.Ranking(short=1)):
        held, best = rs.Slice(pa.array(range(count)), sizes, 400, 50_000), rs.Best(setting.k)
        sums = np.zeros(count, np.int64)
        for t in terms:
            counts = np.random.default_rng(t).integers(1, 9, len(lists[t]))
            held.add(t, lists[t], counts)
            sums[lists[t]] += weights[t] * (10**9 * counts // (1000 * counts + 8 * (10 + 90 * sizes[lists[t]] * 400 // 50_000)))
        rs.search(held, terms, weights, best, setting)
        want = sorted((-int(s), i) for i, s in enumerate(sums) if s > 0)[: setting.k]
        assert [(s, key) for s, _, key in best.rows] == want


def test_index_lists(spark):
    sizes, terms, bounds, found, counts = rs.postings(pa.array(["b A,b", "", "É a-a"]))
    lists = {t: list(zip(found[a:b].tolist(), counts[a:b].tolist())) for t, a, b in zip(terms.to_pylist(), bounds[:-1], bounds[1:])}
    assert sizes.tolist() == [3, 0, 3] and lists == {"b": [(0, 2)], "a": [(0, 1), (2, 2)], "É": [(2, 1)]}
