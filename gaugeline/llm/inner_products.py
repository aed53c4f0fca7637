"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are quantised to integers and grouped by length into classes, the longest first, and each class
into shards of bounded size. Queries meet every shard that can still hold one of their best: a first
pass over shard 0 gives each query a floor, the k-th best score found there, and a class is out of reach
once floor > |query| * longest. Within a shard the vectors, sorted by length, are cut into buckets. A
bucket's local threshold is the cosine that its longest vector would need; bucket by bucket a query is
answered by length pruning (only the vectors long enough for the floor), or, where the threshold is high
and a sorted coordinate leaves few vectors in its feasible range, by coordinate pruning. What is left is
verified by exact integer products, and the floor rises.

No vector travels to more than one task; queries travel to the shards in reach. Nothing is sampled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.texts import batch_of, pa_schema
from gaugeline.session import written
from gaugeline.ship import ship

#: Slack of pruning bounds in floating point; scores themselves are exact.
SLACK = 1e-6


@dataclass(frozen=True)
class Retrieval:
    """``k`` best of each query. ``scale``: a component x becomes floor(scale * x). A class of lengths
    reaches down to ``ratio`` of its longest; a shard holds about ``shard`` vectors, a bucket at most
    ``bucket``. From a local cosine of ``narrow`` on, ``focus`` coordinates of the query are looked at,
    and used if they leave less than one vector in ``gain``. None of these but ``k`` and ``scale``
    changes the result."""

    k: int = 20
    scale: int = 64
    ratio: float = 0.9
    shard: int = 4096
    bucket: int = 1024
    queries: int = 512
    narrow: float = 0.6
    focus: int = 3
    gain: int = 8


# -- inside a shard -----------------------------------------------------------------------------


def matrix(column: pa.Array) -> np.ndarray:
    """The vectors as rows of integers, shorter ones filled up with zeros."""
    column = column.cast(pa.list_(pa.int32()))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()
    sizes = np.diff(offsets)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return values[offsets[0] : offsets[-1]].reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int32)
    out[np.arange(width) < sizes[:, None]] = values[offsets[0] : offsets[-1]]
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


class Bucket:
    """Vectors of like length, the longest first, in the number type whose products are exact."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray, start: int):
        self.vectors, self.lengths, self.start = vectors, lengths, start
        self._lists: tuple | None = None

    def lists(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The unit vectors, and for each coordinate the order of the vectors and their sorted values."""
        if self._lists is None:
            units = self.vectors / np.maximum(self.lengths, 1e-300)[:, None]
            order = np.argsort(units, axis=0)
            self._lists = units, order, np.ascontiguousarray(np.take_along_axis(units, order, axis=0).T)
        return self._lists


class Shard:
    """The vectors of one shard as buckets, and which of their rows a query itself is."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, setting: Retrieval):
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.argsort(-lengths, kind="stable")
        self.vectors, self.lengths, self.order = vectors[order], lengths[order], order
        by = np.argsort(rows[order])
        self._rows, self._at = rows[order][by], by
        self.setting = setting
        self.buckets: list[Bucket] = []
        self.kind: type | None = None

    def own(self, rows: np.ndarray) -> np.ndarray:
        """The place of each query in this shard, -1 if it lies in another."""
        at = np.searchsorted(self._rows, rows)
        at[at == len(self._rows)] = 0
        return np.where(self._rows[at] == rows, self._at[at], -1) if len(self._rows) else np.full(len(rows), -1)

    def prepare(self, kind: type, width: int) -> None:
        if self.kind == kind and self.vectors.shape[1] >= width:
            return
        self.vectors, self.kind, self.buckets, start = widened(self.vectors, width), kind, [], 0
        while start < len(self.lengths):
            low = self.lengths[start] * self.setting.ratio
            stop = min(start + self.setting.bucket, int(np.searchsorted(-self.lengths, -low, "right")))
            stop = max(stop, start + 1)
            self.buckets.append(Bucket(self.vectors[start:stop].astype(kind), self.lengths[start:stop], start))
            start = stop

    def best(self, queries: np.ndarray, rows: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query number, place in the shard and score of all pairs that may be among the k best: those
        not below the k-th best that any one bucket or the floor gives."""
        width = max(queries.shape[1], self.vectors.shape[1])
        norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
        most = norms.max(initial=0) * self.lengths.max(initial=0) * (1 + SLACK)
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        self.prepare(kind, width)
        queries, floors, own = widened(queries, self.vectors.shape[1]).astype(kind), floors.copy(), self.own(rows)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for bucket in self.buckets:
            reach = norms * bucket.lengths[0] * (1 + SLACK)
            live = np.flatnonzero(floors <= reach)
            if not len(live):
                continue
            cosine = np.where(reach[live] > 0, floors[live] / np.maximum(reach[live], 1e-300), -1.0)
            narrow = cosine >= self.setting.narrow
            wide = [live[~narrow]]
            for q, c in zip(live[narrow].tolist(), cosine[narrow].tolist()):
                places = self.in_range(bucket, queries[q] / norms[q], c)
                if places is None:
                    wide.append(np.array([q]))
                elif len(places):
                    scores = bucket.vectors[places] @ queries[q]
                    self._take(found, floors, np.array([q]), bucket.start + places[None, :], scores[None, :], own)
            rest = np.concatenate(wide)
            if len(rest):
                needed = np.where(floors[rest] > 0, floors[rest] / np.maximum(norms[rest], 1e-300) * (1 - SLACK), 0.0)
                long_enough = int(np.searchsorted(-bucket.lengths, -needed.min(), "right"))
                if long_enough:
                    scores = queries[rest] @ bucket.vectors[:long_enough].T
                    places = np.broadcast_to(bucket.start + np.arange(long_enough), scores.shape)
                    self._take(found, floors, rest, places, scores, own)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, place, score = (np.concatenate(x) for x in zip(*found))
        keep = score >= floors[q]
        return q[keep], self.order[place[keep]], score[keep]

    def in_range(self, bucket: Bucket, unit: np.ndarray, cosine: float) -> np.ndarray | None:
        """The vectors whose focus coordinates allow the local cosine; None if that leaves too many.
        Two unit vectors at an angle of at most t have coordinates whose angles differ by at most t."""
        units, order, values = bucket.lists()
        focus = np.argsort(-np.abs(unit))[: self.setting.focus]
        angle, turn = np.arccos(np.clip(unit[focus], -1, 1)), math.acos(min(1.0, cosine * (1 - SLACK))) + SLACK
        low = np.cos(np.minimum(np.pi, angle + turn)) - SLACK
        high = np.cos(np.maximum(0.0, angle - turn)) + SLACK
        spans = [(int(np.searchsorted(values[f], a)), int(np.searchsorted(values[f], b, "right"))) for f, a, b in zip(focus, low, high)]
        least = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        start, stop = spans[least]
        if (stop - start) * self.setting.gain > len(bucket.lengths):
            return None
        places = order[start:stop, focus[least]]
        inside = units[places][:, focus]
        return np.sort(places[((inside >= low) & (inside <= high)).all(axis=1)])

    def _take(self, found, floors, queries, places, scores, own) -> None:
        """Add the pairs not below the floor, and raise it to the k-th best of these scores."""
        k = self.setting.k
        mine = own[queries]
        itself = places == mine[:, None]
        scores = scores.astype(np.int64) if scores.dtype == np.int64 else scores
        if itself.any():
            scores = np.where(itself, np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf, scores)
        if scores.shape[1] > k:
            kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            floors[queries] = np.maximum(floors[queries], kth)
        i, j = np.nonzero((scores >= floors[queries][:, None]) & ~itself)
        found.append((queries[i], places[i, j], scores[i, j].astype(np.int64)))


def first_of_each(group: np.ndarray, score: np.ndarray, key: pa.Array, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first of each group by falling score, then rising key (null last), then row."""
    none = key.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((row, key.fill_null(0).to_numpy(zero_copy_only=False), none, -score, group))
    at = group[order]
    new = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    nth = np.arange(len(at)) - np.repeat(starts, np.diff([*starts, len(at)]))
    return order[nth < k]


FOUND = "query_id bigint, _query bigint, vec_id bigint, _row bigint, score bigint"


def _answers(setting: Retrieval):
    """The best of each query in each shard, from rows sorted by shard, its vectors before its queries."""
    schema = pa_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, shard, keys, rows = None, [], None, None, None
        for batch in batches:
            shards, asks = batch["shard"].to_numpy(), batch["asks"].to_numpy()
            bounds = np.flatnonzero((shards[1:] != shards[:-1]) | (asks[1:] != asks[:-1])) + 1
            bounds = [0, *bounds.tolist(), len(shards)] if len(shards) else [0]
            for start, stop in zip(bounds[:-1], bounds[1:]):
                part = batch.slice(start, stop - start)
                if shards[start] != number:
                    number, held, shard = shards[start], [], None
                if not asks[start]:
                    held.append(part)
                    continue
                if shard is None and held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    keys = table["key"].chunk(0)
                    rows = table["row"].to_numpy()
                    shard, held = Shard(matrix(table["vector"].chunk(0)), rows, setting), []
                if shard is None:
                    continue
                for at in range(0, part.num_rows, setting.queries):
                    some = part.slice(at, setting.queries)
                    own = some["row"].to_numpy()
                    q, place, score = shard.best(matrix(some["vector"]), own, some["floor"].to_numpy())
                    if len(q):
                        first = first_of_each(q, score, keys.take(pa.array(place)), rows[place], setting.k)
                        q, place, score = q[first], place[first], score[first]
                        yield batch_of(
                            query_id=some["key"].take(pa.array(q)), _query=own[q], vec_id=keys.take(pa.array(place)),
                            _row=rows[place], score=score,
                        ).cast(schema)

    return run


# -- on tables ----------------------------------------------------------------------------------


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``key``, ``vector`` (integers), ``length`` and a row number of every vector that takes part.
    A squared length of 2^62 or more is an error, as products must fit 64 bits."""
    whole = F.forall("_v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    some = vectors.select(vectors[key].cast("long").alias("key"), vectors[vector].alias("_v")).filter(F.coalesce(whole, F.lit(False)))
    real = F.transform("_v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    squares = F.aggregate("real", F.lit(0.0), lambda a, x: a + x * x)
    safe = F.when(F.col("_l") < float(1 << 62), F.transform("real", lambda x: x.cast("int")))
    vector_ = F.coalesce(safe, F.raise_error(F.lit("vector too long: its squared length must stay under 2^62")))
    return (
        some.select("key", real.alias("real")).withColumn("_l", squares)
        .select("key", vector_.alias("vector"), F.sqrt("_l").alias("length"), F.monotonically_increasing_id().alias("row"))
    )


def top_products(
    vectors: DataFrame, asks: Column, setting: Retrieval = Retrieval(), key: str = "vec_id", vector: str = "embedding"  # noqa: B008
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` highest integer inner
    products of each row for which ``asks`` (a condition on the key, named ``key``) holds, with all
    other rows; fewer if there are fewer. Equal scores go by the smaller key, null keys last.

    Vectors that are null or hold a null, NaN or infinite component take no part. A shorter vector
    counts as having zeros beyond its end. Rows that repeat a key or a vector are rows of their own:
    each is answered and each may be found, only a row never finds itself. Keys are whole numbers.
    Other columns are not read, and an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    step = -math.log(setting.ratio)
    # Lengths lie between 1 and 2^31, or are 0: the number of classes is bounded, whatever the table.
    level = F.when(F.col("length") > 0, F.floor(F.log("length") / step)).otherwise(-1).cast("int")
    table = written(quantised(vectors, key, vector, setting.scale).withColumn("level", level), "vectors")
    sizes = {r["level"]: r["n"] for r in table.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, parts, last, total = {}, {}, {}, 0
    for one in sorted(sizes, reverse=True):
        first[one], parts[one] = total, max(1, round(sizes[one] / setting.shard))
        total += parts[one]
        last[one] = total - 1
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    lookup = lambda values: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    number = F.element_at(lookup(first), F.col("level")) + F.pmod(F.xxhash64("row"), F.element_at(lookup(parts), F.col("level")))
    stored = table.select(number.cast("long").alias("shard"), F.lit(0).alias("asks"), "key", "row", "vector", F.lit(0.0).alias("floor"))
    queries = table.filter(asks).select("key", "row", "vector", "length")

    def searched(held: DataFrame, asked: DataFrame, label: str) -> DataFrame:
        rows = held.unionByName(asked.select("shard", F.lit(1).alias("asks"), "key", "row", "vector", "floor"))
        tasks = min(total, 4 * spark.sparkContext.defaultParallelism)
        dealt = rows.repartition(tasks, "shard").sortWithinPartitions("shard", "asks")
        return written(dealt.mapInArrow(_answers(setting), FOUND), label)

    start = queries.withColumns({"shard": F.lit(0).cast("long"), "floor": F.lit(float("-inf"))})
    seeds = searched(stored.filter("shard = 0"), start, "seeds")
    found = seeds
    if total > 1:
        floors = seeds.groupBy("_query").agg(F.min("score").alias("_low"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= setting.k)
        floored = queries.join(floors, queries["row"] == floors["_query"], "left").withColumn(
            "floor", F.coalesce(F.col("_low").cast("double"), F.lit(float("-inf")))
        )
        # The lowest class whose longest vector can still reach the floor.
        needed = F.floor(F.log(F.col("floor") / F.col("length") * (1 - SLACK)) / step)
        reached = F.when((F.col("floor") <= 0) | (F.col("length") == 0), -1).otherwise(F.coalesce(needed, F.lit(-1))).cast("int")
        ends = sorted(last.items())
        to = F.coalesce(*[F.when(F.lit(one) >= reached, F.lit(n)) for one, n in ends], F.lit(0))
        spread = floored.withColumn("_to", to).filter("_to > 0").withColumn("shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_to").cast("long"))))
        found = seeds.unionByName(searched(stored.filter("shard > 0"), spread, "products"))
    order = Window.partitionBy("query_id", "_query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= setting.k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def products_sql(table: str = "embeddings", every: int = 20, setting: Retrieval = Retrieval()) -> str:  # noqa: B008
    """The same by comparing each query with every row, for tables whose keys do not repeat."""
    return f"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({setting.scale} * CAST(x AS DOUBLE))) AS v FROM {table}
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {setting.k}"""
