"""The pipeline's near-duplicates: links by fingerprint and by Jaccard similarity."""

import random
from itertools import combinations

import pyarrow as pa

import corpus_pipeline
from gaugeline.llm import near_copies, simhash

from .test_near_copies import _set

WORDS = [f"w{i}" for i in range(3000)]


def _edited(seed):
    """A text and its copy with five other words: less than 0.8 of the shingles, but three bits of the fingerprint."""
    draw = random.Random(seed)
    base = draw.choices(WORDS, k=200)
    copy = list(base)
    for at in (20, 60, 100, 140, 180):
        copy[at] = draw.choice(WORDS)
    return base, copy


def _texts():
    rows = []
    for seed in (12, 24, 63):
        base, copy = _edited(seed)
        nearer = [*copy[:-1], "last"]  # links to the copy by its shingles
        rows += [" ".join(words) for words in (nearer, copy, base)]
    rows += [" ".join(random.Random(s).choices(WORDS, k=150)) for s in (1, 2)]
    return rows


def _components(texts, jaccard=True):
    """The components of all pairs that link by either rule, the numbers of equal texts being equal."""
    codes = simhash.fingerprint_texts(pa.array([t or "" for t in texts]), simhash.NearDup()).tolist()
    sets, root = [_set(t) for t in texts], list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        alike = 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])) and jaccard
        if (alike or (codes[i] ^ codes[j]).bit_count() <= 3) and root[i] != root[j]:
            old, new = max(root[i], root[j]), min(root[i], root[j])
            root = [new if r == old else r for r in root]
    return root


def _kept(rows):
    root, first = _components([t for _, t in rows]), {}
    for (key, _), r in zip(rows, root):
        first[r] = min(first.get(r, (True, 0)), (key is None, key or 0))
    return sorted(first.values())


def test_fingerprints_link_below_the_similarity(spark):
    base, copy = (" ".join(words) for words in _edited(12))
    both = len(_set(base) & _set(copy))
    assert 9 * both < 4 * (len(_set(base)) + len(_set(copy)))
    docs = spark.createDataFrame([(4, base), (7, copy)], "doc_id int, text string")
    assert len(near_copies.representatives(docs).collect()) == 2
    assert [r.doc_id for r in corpus_pipeline.deduplicated(spark, docs, "").collect()] == [4]


def test_stage_links_by_either_rule(spark):
    rows = [*enumerate(_texts()), (20, None), (21, " "), (22, "one")]
    docs = spark.createDataFrame(rows + rows[::2], "doc_id int, text string").repartition(5)
    docs = docs.selectExpr("*", "1 component_id", "2 other", "3 a", "4 text_hash", "5 _key")
    found = corpus_pipeline.deduplicated(spark, docs, "")
    assert found.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect()) == _kept(rows)


def test_repeated_and_null_keys_join_no_components(spark):
    texts = _texts()
    rows = [(None if i % 3 == 0 else 5, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    found = corpus_pipeline.deduplicated(spark, docs, "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == _kept(rows)
    groups = {r["text_hash"]: r["component_id"] for r in simhash.text_groups(docs).collect()}
    assert len(groups) == len(texts) and len(set(groups.values())) == len(set(_components(texts, jaccard=False)))
