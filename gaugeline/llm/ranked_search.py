"""Ranked lexical search: an inverted index by ranges of documents, and a hybrid of term-at-a-time and
document-at-a-time scoring over it.

The index holds, for each slice of documents and each term, the documents that have it and how often.
Statistics (documents, terms, documents with a term) are sums over all slices. An item is scored slice
by slice: its short posting lists are summed term at a time into accumulators, which then count as one
iterator bounded by their largest sum; it and the long lists are walked document at a time, in windows of
documents. Iterators whose bounds together stay below the item's floor (the k-th best score so far) bring
up no document of their own: they are only looked up for documents that the others bring and that can
still reach the floor. A slice whose bounds stay below the floor altogether is passed over.

Items are scored in blocks of a bounded number of terms; every block meets all slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.texts import batch_of, bytes_of, filled, pa_schema, slices
from gaugeline.session import written
from gaugeline.ship import ship

#: The bytes of terms: ASCII letters and digits and all of other characters.
TERM = np.zeros(256, bool)
TERM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The same as a pattern for Java and SQL.
PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Ranking:
    """``k`` documents of each item. ``slice_bytes`` of text make a slice; lists of at most one document
    in ``short`` of a slice are summed first; ``window`` documents are walked at a time; ``block`` terms of
    items are scored together. None but ``k`` changes the result."""

    k: int = 10
    slice_bytes: int = 6 << 20
    short: int = 16
    window: int = 2048
    block: int = 1 << 18


# -- index --------------------------------------------------------------------------------------


def postings(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, the distinct terms, and by term: where its list begins, documents, counts."""
    data, offsets = bytes_of(texts)
    inside = TERM[data]
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    sizes = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return sizes, pa.array([], pa.string()), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.concatenate([(np.cumsum(inside) - 1)[starts], [int(inside.sum())]]).astype(np.int32)
    terms = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]].tobytes())])
    coded = terms.dictionary_encode()
    documents = np.repeat(np.arange(len(sizes)), sizes)
    found, counts = np.unique(coded.indices.to_numpy().astype(np.int64) * len(sizes) + documents, return_counts=True)
    bounds = np.searchsorted(found, np.arange(len(coded.dictionary) + 1) * len(sizes))
    return sizes, coded.dictionary.cast(pa.string()), bounds, found % len(sizes), counts


#: A slice's row without a term holds its documents' keys and numbers of terms; the others, in ``docs``, places
#: among them, and in ``counts`` how often the term occurs there.
INDEX = "slice bigint, term string, docs array<int>, counts array<bigint>, keys array<bigint>"


def indexed(docs: DataFrame, setting: Ranking = Ranking(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """The index, written. A text's terms are the longest stretches of characters other than ASCII
    control, space and punctuation, with A-Z in lower case; a null text has none. Keys are whole numbers."""
    ship(docs.sparkSession)
    schema = pa_schema(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, "_text", setting.slice_bytes):
            sizes, terms, bounds, found, counts = postings(filled(part["_text"]))
            whole = pa.array([0, part.num_rows], pa.int32())
            yield batch_of(
                slice=pa.array([number]), term=pa.nulls(1, pa.string()), docs=pa.array([[]], pa.list_(pa.int32())),
                counts=pa.ListArray.from_arrays(whole, pa.array(sizes, pa.int64())),
                keys=pa.ListArray.from_arrays(whole, part["_key"].cast(pa.int64())),
            ).cast(schema)
            if len(terms):
                ends = pa.array(bounds, pa.int32())
                yield batch_of(
                    slice=np.full(len(terms), number), term=terms, docs=pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                    counts=pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    keys=pa.nulls(len(terms), pa.list_(pa.int64())),
                ).cast(schema)
            number += 1

    return written(docs.select(docs[key].cast("long").alias("_key"), docs[text].alias("_text")).mapInArrow(run, INDEX), "index")


def item_terms(items: DataFrame, key: str, text: str) -> DataFrame:
    """``item`` and each of its terms once."""
    lower = F.translate(items[text], UPPER, SMALL)
    terms = F.array_distinct(F.regexp_extract_all(lower, F.lit(f"({PATTERN})"), F.lit(1)))
    rows = items.select(items[key].cast("long").alias("item"), terms.alias("terms"), F.monotonically_increasing_id().alias("row"))
    return rows.select("item", "row", F.explode("terms").alias("term"))


# -- scoring ------------------------------------------------------------------------------------


class Slice:
    """The posting lists of one slice, with the scores that a term adds, made when first asked for."""

    def __init__(self, keys: pa.Array, sizes: np.ndarray, documents: int, total: int):
        self.keys, self.count = keys, len(sizes)
        self.norm = 8 * (10 + 90 * sizes * documents // max(total, 1))
        self._raw: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._scored: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def add(self, term: int, docs: np.ndarray, counts: np.ndarray) -> None:
        self._raw[term] = docs, counts

    def length(self, term: int) -> int:
        return len(self._raw[term][0]) if term in self._raw else 0

    def scored(self, term: int, weight: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents, scores and the largest score of a term."""
        if term not in self._scored:
            docs, counts = self._raw[term]
            scores = weight * (1_000_000_000 * counts // (1000 * counts + self.norm[docs]))
            self._scored[term] = docs, scores, int(scores.max())
        return self._scored[term]


class Best:
    """The k best documents of an item so far, and the score that another needs."""

    def __init__(self, k: int):
        self.k, self.floor, self.rows = k, 1, []

    def offer(self, keys: list, scores: list[int]) -> None:
        rows = self.rows + [(-s, key is None, key or 0) for s, key in zip(scores, keys)]
        self.rows = sorted(rows)[: self.k]
        if len(self.rows) == self.k:
            self.floor = max(1, -self.rows[-1][0])


def search(slice_: Slice, terms: list[int], weights: list[int], best: Best, setting: Ranking) -> None:
    """Score an item over a slice."""
    short, long = [], []
    for term, weight in zip(terms, weights):
        size = slice_.length(term)
        if size and weight:
            (short if size * setting.short <= slice_.count else long).append((term, weight))
    iterators = []
    if short:  # term at a time
        sums = np.zeros(slice_.count, np.int64)
        for term, weight in short:
            docs, scores, _ = slice_.scored(term, weight)
            sums[docs] += scores
        docs = np.flatnonzero(sums)
        if len(docs):
            scores = sums[docs]
            iterators.append((int(scores.max()), docs, scores))
    for term, weight in long:
        docs, scores, most = slice_.scored(term, weight)
        iterators.append((most, docs, scores))
    iterators.sort(key=lambda x: -x[0])
    if not iterators:
        return
    below = np.cumsum([x[0] for x in iterators[::-1]])[::-1].tolist() + [0]  # bounds of an iterator and all lesser ones
    ends = [np.searchsorted(x[1], np.arange(0, slice_.count + setting.window, setting.window)) for x in iterators]
    for w in range(len(ends[0]) - 1):
        leading = sum(b >= best.floor for b in below[:-1])  # the others reach the floor on no document alone
        if not leading:
            return
        low, high = w * setting.window, min((w + 1) * setting.window, slice_.count)
        sums = np.zeros(high - low, np.int64)
        for i in range(leading):
            a, b = ends[i][w], ends[i][w + 1]
            sums[iterators[i][1][a:b] - low] += iterators[i][2][a:b]
        docs = np.flatnonzero((sums > 0) & (sums + below[leading] >= best.floor))
        scores = sums[docs]
        for i in range(leading, len(iterators)):
            if not len(docs):
                break
            own, values = (x[ends[i][w] : ends[i][w + 1]] for x in iterators[i][1:])
            if len(own):
                at = np.minimum(np.searchsorted(own, docs + low), len(own) - 1)
                scores = scores + np.where(own[at] == docs + low, values[at], 0)
            alive = scores + below[i + 1] >= best.floor
            docs, scores = docs[alive], scores[alive]
        if len(docs) > best.k:  # no document below the k-th of the window can be among the best
            alive = scores >= np.partition(scores, len(scores) - best.k)[len(scores) - best.k]
            docs, scores = docs[alive], scores[alive]
        if len(docs):
            best.offer(slice_.keys.take(pa.array(docs + low)).to_pylist(), scores.tolist())


FOUND = "item bigint, row bigint, doc_id bigint, score bigint"


def _searched(items: list[tuple], documents: int, total: int, setting: Ranking):
    """The best documents of each item in the slices of a task, from rows sorted by slice, its documents first."""
    schema = pa_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held = [Best(setting.k) for _ in items], None

        def finish() -> None:
            for (_, _, terms, weights), own in zip(items, best):
                search(held, terms, weights, own, setting)

        for batch in batches:
            terms, docs, counts = batch["number"].to_pylist(), batch["docs"], batch["counts"]
            for i, term in enumerate(terms):
                if term is None:
                    if held is not None:
                        finish()
                    held = Slice(batch["keys"][i].values, counts[i].values.to_numpy(), documents, total)
                else:
                    held.add(term, docs[i].values.to_numpy(), counts[i].values.to_numpy())
        if held is not None:
            finish()
        rows = [(item, row, None if none else key, -score) for (item, row, *_), own in zip(items, best) for score, none, key in own.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    return run


def ranked(
    items: DataFrame, index: DataFrame, setting: Ranking = Ranking(), key: str = "item_id", text: str = "text"  # noqa: B008
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``k`` highest-scoring documents of each
    item with a score above 0; fewer if there are fewer. Equal scores go by the smaller key, null last.

    An item with a null text or without a term finds nothing, nor does an empty index. Rows that
    repeat a key are items, or documents, of their own. Other columns are not read.
    """
    spark = index.sparkSession
    sizes = index.filter("term IS NULL").select(
        F.size(F.filter("counts", lambda n: n > 0)).alias("n"), F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n).alias("l")
    )
    documents, total = (x or 0 for x in sizes.agg(F.sum("n"), F.sum("l")).first())
    asked = written(item_terms(items, key, text), "items")
    held = index.filter("term IS NOT NULL").join(asked.select("term").distinct(), "term", "left_semi")
    frequency = held.groupBy("term").agg(F.sum(F.size("docs")).cast("long").alias("df"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * documents + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    weighed = written(frequency.select("term", weight.alias("weight")), "weights")
    # Items are dealt to blocks that hold about ``block`` terms each.
    counted = asked.groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    blocks = counted.select("row", F.pmod(F.xxhash64("row"), F.lit(_blocks(counted, setting))).cast("int").alias("block"))
    known = written(asked.join(weighed, "term").join(blocks, "row"), "asked")
    found = None
    for block in [r["block"] for r in blocks.select("block").distinct().orderBy("block").collect()]:
        part = known.filter(F.col("block") == block)
        numbers = {t: i for i, t in enumerate(sorted(r["term"] for r in part.select("term").distinct().collect()))}
        if not numbers:
            continue
        rows = part.groupBy("item", "row").agg(F.collect_list(F.struct("term", "weight")).alias("terms")).collect()
        terms = [(r["item"], r["row"], [numbers[t["term"]] for t in r["terms"]], [t["weight"] for t in r["terms"]]) for r in rows]
        table = spark.createDataFrame(list(numbers.items()), "term string, number int")
        # About ``block`` terms are broadcast; only their lists leave the index.
        lists = index.join(F.broadcast(table), "term").select("slice", "number", "docs", "counts", "keys")
        heads = index.filter("term IS NULL").select("slice", F.lit(None).cast("int").alias("number"), "docs", "counts", "keys")
        dealt = heads.unionByName(lists).repartition("slice").sortWithinPartitions("slice", F.asc_nulls_first("number"))
        one = written(dealt.mapInArrow(_searched(terms, documents, total, setting), FOUND), "found")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item", "row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= setting.k)
    return placed.select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def _blocks(counted: DataFrame, setting: Ranking) -> int:
    terms = counted.agg(F.sum("n")).first()[0] or 0
    return max(1, -(-terms // setting.block))


def ranked_search(
    docs: DataFrame, items: DataFrame, setting: Ranking = Ranking(), key: str = "doc_id", text: str = "text"  # noqa: B008
) -> DataFrame:
    """The documents for each item, by an index made for it."""
    return ranked(items, indexed(docs, setting, key, text), setting)


def ranked_sql(k: int = 10) -> str:
    """The same by scoring every document that shares a term with an item."""
    pattern = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    terms = f"regexp_extract_all(translate(text, '{UPPER}', '{SMALL}'), '{pattern}')"
    return f"""
WITH found AS (
    SELECT doc_id, rowid_ AS row, unnest({terms}) AS term FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)
), sizes AS (SELECT row, count(*) AS n FROM found GROUP BY row
), whole AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM sizes
), counts AS (SELECT doc_id, row, term, count(*) AS tf FROM found GROUP BY ALL
), frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY term
), asked AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark
), scored AS (
    SELECT item_id, doc_id, row, CAST(sum(CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2.0 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM asked JOIN frequency USING (term) JOIN counts USING (term) JOIN sizes USING (row), whole GROUP BY ALL
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {k}"""
