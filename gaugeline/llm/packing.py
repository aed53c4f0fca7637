"""Packing pieces of tokenised documents into sequences of fixed length.

Lengths are counted in a histogram of bins, shallow combinations of bins that fill a window exactly
are enumerated, and a non-negative least-squares problem over the histogram says how often to use
each. Rounded repeats are laid out first; what they leave is packed greedily, again by bins. The
solver sees the histogram only, whose size does not depend on the data; every piece then finds its
sequence from its rank within its bin.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.encoding import encoder_of, with_end
from gaugeline.llm.texts import SLICE_BYTES, batch_of, filled, pa_schema, ranges, slices
from gaugeline.session import written
from gaugeline.ship import ship


@dataclass(frozen=True)
class Packing:
    """``window`` tokens a sequence, lengths rounded up to multiples of ``step`` in the histogram,
    combinations of at most ``depth`` pieces in the least-squares problem."""

    window: int = 2048
    step: int = 8
    depth: int = 3

    @property
    def bins(self) -> int:
        return -(-self.window // self.step)


def combinations(present: list[int], total: int, depth: int) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` of the ``present`` numbers that sum to ``total``."""
    if depth == 1:
        return [(total,)] if total in set(present) else []
    have, found = set(present), []

    def extend(begun: tuple[int, ...], left: int) -> None:
        top = begun[-1] if begun else left
        if left in have and left <= top:
            found.append((*begun, left))
        if len(begun) < depth - 1:
            for b in present:
                if b <= top and b < left:
                    extend((*begun, b), left - b)

    extend((), total)
    return found


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-8) -> np.ndarray:
    """Non-negative least squares by the active-set method. It needs about as many rounds as columns; should
    rounding make it turn in a circle, it stops after three times as many with the best found so far, and
    what that leaves is packed greedily."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gradient = a.T @ b
    bound = tolerance * max(1.0, float(np.abs(gradient).max(initial=0)))
    for _ in range(3 * n):
        free = np.where(passive, -np.inf, gradient)
        if n == 0 or free.max() <= bound:
            break
        passive[int(np.argmax(free))] = True
        while True:
            columns = np.flatnonzero(passive)
            trial = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[columns] = trial
                break
            low = trial <= 0
            share = x[columns][low] / np.maximum(x[columns][low] - trial[low], 1e-300)
            x[columns] += share.min() * (trial - x[columns])
            passive &= x > 1e-12 * max(1.0, float(x.max()))
            x[~passive] = 0
            if not passive.any():
                break
        gradient = a.T @ (b - a @ x)
    return x


def plan_sequences(histogram: dict[int, int], bins: int, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of bins (each sums to at most ``bins``) and repeats that use every piece once."""
    left = Counter({b: n for b, n in histogram.items() if n > 0})
    present = sorted(left)
    plan: list[tuple[tuple[int, ...], int]] = []

    def use(combination: tuple[int, ...], wanted: int) -> None:
        need = Counter(combination)
        repeats = min(wanted, *(left[b] // m for b, m in need.items()))
        if repeats > 0:
            plan.append((combination, repeats))
            for b, m in need.items():
                left[b] -= m * repeats

    choices = combinations(present, bins, depth)
    if choices:
        row = {b: i for i, b in enumerate(present)}
        a = np.zeros((len(present), len(choices)))
        for j, combination in enumerate(choices):
            for b in combination:
                a[row[b], j] += 1
        counts = np.array([left[b] for b in present], float)
        weights = 1 / np.sqrt(counts)  # rare lengths matter as much as frequent ones
        repeats = nnls(a * weights[:, None], counts * weights)
        for j in np.argsort(-repeats, kind="stable"):
            if repeats[j] >= 0.5:
                use(choices[j], int(round(repeats[j])))
    while left := +left:  # the longest piece left, and always the longest that still fits
        combination, room, taken = (), bins, Counter()
        while fits := [b for b in left if b <= room and left[b] > taken[b]]:
            combination, room = (*combination, max(fits)), room - max(fits)
            taken[max(fits)] += 1
        use(combination, sum(left.values()))
    return plan


class Places:
    """Where the r-th piece of a bin goes, for a whole plan."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]]):
        self.first: dict[int, list[int]] = {}
        self.base: dict[int, list[int]] = {}
        self.slot: dict[int, list[int]] = {}
        used: Counter = Counter()
        sequences = 0
        for combination, repeats in plan:
            for slot, b in enumerate(combination):
                self.first.setdefault(b, []).append(used[b])
                self.base.setdefault(b, []).append(sequences)
                self.slot.setdefault(b, []).append(slot)
                used[b] += repeats
            sequences += repeats

    def of(self, bins: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, slot = np.zeros(len(bins), np.int64), np.zeros(len(bins), np.int32)
        for b in np.unique(bins):
            at = np.flatnonzero(bins == b)
            first = np.array(self.first[int(b)])
            segment = np.searchsorted(first, ranks[at], "right") - 1
            sequence[at] = np.array(self.base[int(b)])[segment] + ranks[at] - first[segment]
            slot[at] = np.array(self.slot[int(b)])[segment]
        return sequence, slot


def tokenised_pieces(docs: DataFrame, vocabulary: str, end_id: int, setting: Packing, key: str, text: str) -> DataFrame:
    """Every document's ids cut into whole windows and a rest, each with its bin and its rank among
    the pieces of the bin that the same task has made."""
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"_key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, bin int, rank bigint"
    schema = pa_schema(ddl)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(setting.bins + 1, np.int64)
        encoder = encoder_of(vocabulary)
        for part in slices(batches, "_text", SLICE_BYTES // 2):  # the ids of a slice take several times its bytes
            ids, offsets = with_end(*encoder.encode(filled(part["_text"])), end_id)
            tokens = np.diff(offsets)
            n_pieces = -(-tokens // setting.window)
            row = np.repeat(np.arange(len(tokens)), n_pieces)
            start = ranges(np.zeros(len(tokens), np.int64), n_pieces) * setting.window
            length = np.minimum(setting.window, tokens[row] - start)
            raw, at = ids.astype("<u4").tobytes(), (offsets[row] + start) * 4
            crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(at, at + length * 4)), np.int64, len(at))
            bins = -(-length // setting.step)
            order = np.argsort(bins, kind="stable")
            counts = np.bincount(bins, minlength=len(seen))
            rank = np.empty(len(bins), np.int64)
            rank[order] = ranges(seen, counts)
            seen += counts
            yield batch_of(
                _key=part["_key"].take(pa.array(row)), start=start, length=length, ids_crc32=crc, doc_tokens=tokens[row],
                part=np.full(len(row), task, np.int32), bin=bins.astype(np.int32), rank=rank,
            ).cast(schema)

    return docs.select(docs[key].alias("_key"), docs[text].alias("_text")).mapInArrow(run, ddl)


def packed(docs: DataFrame, vocabulary: str, end_id: int = 1, setting: Packing = Packing(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """Per piece: key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A null text counts as empty: one piece of one token, the end id. Null keys stay null, repeated
    rows are packed each for itself, an empty table gives no rows, and other columns are not read.
    Only whole windows are cut off a long document, so a document's rest is one piece.
    """
    pieces = written(tokenised_pieces(docs, vocabulary, end_id, setting, key, text), "pieces")
    counts = written(pieces.groupBy("part", "bin").agg(F.count(F.lit(1)).alias("n")), "bins")
    histogram = {r["bin"]: r["n"] for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect()}  # one row a bin
    places = Places(plan_sequences(histogram, setting.bins, setting.depth))
    earlier = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "bin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "bin"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base")
    kind = docs.schema[key].dataType.simpleString()
    ddl = f"_key {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, slot int"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, slot = places.of(batch["bin"].to_numpy(), batch["rank"].to_numpy())
            columns = {c: batch[c] for c in ("_key", "start", "length", "ids_crc32", "doc_tokens")}
            yield batch_of(**columns, sequence_id=sequence, slot=slot).cast(schema)

    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0))
    return (
        ranked.mapInArrow(run, ddl).withColumn("offset", offset).drop("slot").withColumnRenamed("_key", key)
    )
