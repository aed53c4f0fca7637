"""Runs of words against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gaugeline.llm import periodic_runs as pr

SCHEMA = "doc_id bigint, text string, start int, length string, runs int, _key string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(words, length=24, times=3):
    """Every stretch with period p that cannot be extended, if p is the smallest of its periods."""
    n, out = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i < n - p:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(length, times * p):
                out.setdefault((i, j - i + p), p)
            i = j
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def _row(key, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs, kept, best = _plain(words), [True] * n, (None, None, None, None)
    for s, size, p in runs:
        kept[s + p : s + size] = [False] * (size - p)
    if runs:
        top = max(size * 10**12 // p for _, size, p in runs)
        s, size, p = next(r for r in runs if r[1] * 10**12 // r[2] == top)
        best = (s, size, p, 1000 * size // p)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (key, len(runs), *best, digest("".join(f"{s},{size},{p}\n" for s, size, p in runs)), digest(" ".join(w for w, k in zip(words, kept) if k)))


def _sequences():
    draw = random.Random(4)
    for alphabet in (1, 2, 3, 8):
        for n in (0, 1, 5, 23, 24, 25, 60, 150):
            yield [draw.randrange(alphabet) for _ in range(n)]
    for _ in range(60):  # repeats of repeats, with words between
        unit = [draw.randrange(4) for _ in range(draw.randint(1, 12))]
        out = []
        for _ in range(draw.randint(1, 4)):
            out += unit * draw.randint(1, 9) + unit[: draw.randint(0, len(unit))] + [draw.randrange(4) for _ in range(draw.randint(0, 3))]
        yield out
    line = [draw.randrange(50) for _ in range(20)]
    yield [x for i in range(40) for x in (100 + i, *line)]  # one line again and again after different words
    yield [x for i in range(30) for x in (100 + i, *[7, 8] * 13)]  # many runs, each after a different word


@pytest.mark.parametrize("setting", [pr.Runs(), pr.Runs(6, 3), pr.Runs(10, 4), pr.Runs(1, 3)])
def test_maximal_pairs_are_the_runs(setting):
    texts = [" ".join(f"w{x}" for x in s) for s in _sequences()]
    numbers, bounds = pr.word_numbers(pa.array(texts))
    where, start, length, period = pr.runs_of(numbers, bounds, setting)
    found = [[] for _ in texts]
    for i, *run in zip(where.tolist(), start.tolist(), length.tolist(), period.tolist()):
        found[i].append(tuple(run))
    assert found == [_plain(t.split(), setting.length, setting.times) for t in texts]


def test_few_lists_are_looked_at_however_many_there_are():
    words = np.array([x for i in range(4000) for x in (1000 + i, *[7, 8] * 13)])
    where, start, length, period = pr.runs_of(words, np.array([0, len(words)]), pr.Runs())
    assert start.tolist() == [27 * i + 1 for i in range(4000)] and set(length) == {26} and set(period) == {2}


def test_one_word_repeated_without_end():
    numbers, bounds = pr.word_numbers(pa.array(["a " * 60_000 + "b", None or ""]))
    found = pr.runs_of(numbers, bounds, pr.Runs())
    assert [x.tolist() for x in found] == [[0], [0], [60_000], [1]]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(9)
    words = lambda n: " ".join(draw.choice(("la", "de", "und", "é", "ß.", "x y", "日本")) + str(draw.randrange(9)) for _ in range(n))
    texts = [None, "", " \n\t\x0b", "a", *[words(draw.randint(1, 300)) for _ in range(60)], ("same line here\n" * 60), words(3) + (" a b" * 20)]
    texts += [" ".join([words(30)] * 5), words(9_000), "x" * 5_000, texts[20]]
    out = list(enumerate(texts))
    return [*out, out[20], out[20], (None, texts[64]), (None, None)]


def test_digests(spark, rows):
    table = spark.createDataFrame([(k, t, 1, "l", 2, "k", 3) for k, t in rows], SCHEMA).repartition(3)
    found = pr.run_digests(pr.with_planted_runs(table))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, found.collect())) == Counter(_row(k, t) for k, t in rows)
    whole = pr.periodic_runs(table).collect()
    assert all(r["collapsed"] is not None and len(r["runs"]) == len(_plain(WORD.findall(t or ""))) for r in whole for k, t in rows if k == r["doc_id"] and k)
    assert pr.run_digests(pr.with_planted_runs(table.limit(0))).collect() == []
