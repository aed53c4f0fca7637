"""Fingerprints against a plain multiset sum, likeness against exact shares, and ranges of one hot key."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from gaugeline.llm import fingerprints as fp


def _pieces(text):
    return [p for p in re.split(r"\n|(?<=[.!?])[ ]", text) if p]


def _plain(text):
    sums = [0] * fp.IDENTITY
    for line in filter(None, text.split("\n")):
        digest = hashlib.sha256(line.encode()).hexdigest()
        sums = [(s + int(digest[8 * i : 8 * i + 8], 16)) % 2**32 for i, s in enumerate(sums)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in _pieces(text)]
    out = "".join(f"{s:08x}" for s in [*sums, len(hashes)])
    for level in range(fp.SKETCHES):
        places = [0] * fp.LANES
        for h in hashes:
            if h % fp.RATE**level == 0:
                k = h >> 32 & fp.LANES * 256 - 1
                places[k >> 8] = (places[k >> 8] + k) % 256
        out += "".join(f"{p:02x}" for p in places)
    return out


def _share(a, b):
    a, b = Counter(_pieces(a)), Counter(_pieces(b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def _texts():
    draw = random.Random(3)
    sentences = [f"The {i} {draw.random()}{draw.choice('.!?')}" for i in range(400)]
    make = lambda n: "".join(draw.choice(sentences) + draw.choice((" ", "\n", "\n\n")) for _ in range(n))
    return ["", "a", "\n\n", "é\né\né", *[make(n) for n in (1, 2, 10, 60, 200, 200, 700)], make(900) * 3]


def test_fingerprint_is_the_sum_of_its_paragraphs(spark):
    texts = _texts()
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", fp.fingerprint(F.col("t")).alias("f")).collect()
    assert {r.i: r.f for r in rows} == {i: _plain(t) for i, t in enumerate(texts)}


def test_likeness_is_near_the_exact_share(spark):
    draw, rows = random.Random(4), []
    sentences = [f"Sentence {i} of all." for i in range(6000)]
    for n in (5, 40, 300, 2000):
        for kept in (0.0, 0.3, 0.6, 0.9, 0.98, 1.0):
            a = draw.sample(sentences, n)
            b = [x if draw.random() < kept else draw.choice(sentences) for x in a]
            rows.append((" ".join(a), " ".join(b)))
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    prints = frame.select("i", fp.fingerprint(F.col("a")).alias("a"), fp.fingerprint(F.col("b")).alias("b"))
    prints = spark.createDataFrame(prints.collect(), prints.schema)
    found = {r.i: r.s for r in prints.select("i", fp.likeness(F.col("a"), F.col("b")).alias("s")).collect()}
    errors = [abs(found[i] - _share(a, b)) for i, (a, b) in enumerate(rows)]
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.05


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_neighbours_of_one_hot_key(spark, ranges):
    texts = [f"text {i % 37}" for i in range(120)]
    rows = [(5, t) for t in texts] + [(None, t) for t in texts[:50]] + [(i, f"own {i}") for i in range(6, 30)] + [(5, "text 1")] * 40
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    near = fp.neighbours(docs, "doc_id", "text", ranges).filter("NOT _guest").collect()
    tie = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    ordered = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], tie[r[1]]), reverse=True)
    want = Counter((*r, ordered[(i + 1) % len(ordered)][1]) for i, r in enumerate(ordered))
    assert Counter((r._key, r._text, r._next) for r in near) == want


def test_one_shuffle_of_the_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = fp.document_fingerprints(docs, ranges=5)._jdf.queryExecution().executedPlan().toString()
    # One for the rows and one for the few heads; the windows and the sort add none.
    assert plan.count("Exchange") == 2
