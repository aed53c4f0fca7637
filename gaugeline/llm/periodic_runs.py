"""Periodic runs of words by maximal pairs.

A run is a stretch of words with smallest period q, at least ``times`` periods and ``length`` words long,
that no neighbouring word extends. Two places i < j of a text are a maximal pair if the words from them
agree for l words and no more, and the words before them differ: then the words from i to j + l have
period j - i and nothing extends them. So the runs are the maximal pairs whose distance satisfies
(times - 1) * (j - i) <= l and j - i + l >= length, of equal stretches the one of least distance.

The pairs are enumerated bottom-up over the tree of LCP intervals. Suffixes are ranked by prefix doubling,
for all texts of a slice at once and only while they share a prefix; neighbouring intervals are merged in
order of falling common prefix l, the smaller into the larger. Each holds lists of its places by the word
on their left, and a place of the smaller one meets those lists of the larger one that differ from its own
word and lie within l / (times - 1). Places that near together overlap by at least half, so they stand a
period apart, and all but the first of them have the same word on their left: two lists at most have to
be looked at, however many there are.

A text that repeats no ``length * (times - 1) / times`` words (told by hashes, which can only send too many
texts to the exact search) has no run.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.texts import SPACE, batch_of, bytes_of, filled, map_texts
from gaugeline.ship import ship

ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@dataclass(frozen=True)
class Runs:
    """The least ``length`` of a run in words and how many ``times`` its period it has (3 or more)."""

    length: int = 24
    times: int = 3

    def __post_init__(self):
        if self.times < 3 or self.length < 1:
            raise ValueError("a run has at least three periods and a word")

    @property
    def depth(self) -> int:
        """A run's first and second period share so many words at least."""
        return max(1, -(-self.length * (self.times - 1) // self.times))


# -- words --------------------------------------------------------------------------------------


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers (equal words, equal numbers), and where each text begins."""
    data, offsets = bytes_of(texts)
    inside = ~SPACE[data]
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    places = np.cumsum(inside) - 1  # of each byte among those inside words
    ends = np.concatenate([places[starts], [int(inside.sum())]]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside].tobytes())])
    numbers = words.dictionary_encode().indices.to_numpy() if len(starts) else np.zeros(0, np.int32)
    return numbers.astype(np.int64), np.searchsorted(starts, offsets)


def repeats(numbers: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """The texts that may hold some ``depth`` words in a row twice: all that do, by hashes of them."""
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    h, width = (numbers.astype(np.uint64) + ODD[0]) * ODD[1], 1
    while 2 * width <= depth:
        h = _mixed(h[: len(h) - width], h[width:])
        width *= 2
    if width < depth:
        h = _mixed(h[: len(h) - (depth - width)], h[depth - width :])
    if len(h) < 2:
        return np.zeros(0, np.int64)
    whole = np.flatnonzero(texts[: len(h)] == texts[depth - 1 : depth - 1 + len(h)])
    own = _mixed(h[whole], texts[whole].astype(np.uint64))
    order = np.argsort(own)
    same = own[order][1:] == own[order][:-1]
    return np.unique(texts[whole[order[1:][same]]])


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * ODD[0] + b
    x ^= x >> np.uint64(29)
    return x * ODD[1]


# -- suffixes -----------------------------------------------------------------------------------


def prefix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... symbols: equal ranks, equal prefixes. Every
    shared prefix must end before the last symbol. Only suffixes that still share a prefix are sorted."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.concatenate([[True], symbols[order][1:] != symbols[order][:-1]])
    starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = starts
    levels, step = [rank], 1
    live = order[~(new & np.concatenate([new[1:], [True]]))]
    while len(live):
        keys = rank[live] * n + rank[live + step]
        by = np.argsort(keys, kind="stable")
        live, keys = live[by], keys[by]
        held, index = rank[live], np.arange(len(live))
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        whole = np.concatenate([[True], held[1:] != held[:-1]])
        rank = rank.copy()
        rank[live] = held + np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(whole, index, 0))
        levels.append(rank)
        live, step = live[~(new & np.concatenate([new[1:], [True]]))], 2 * step
    return levels


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each two suffixes."""
    total = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a + total] == levels[k][b + total]
        total[same] += 1 << k
    return total


def sharing(levels: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes that share ``depth`` symbols or more with another, in order, and the common prefix
    of each with the one before (0 where that is less than ``depth``)."""
    k = depth.bit_length() - 1
    if k >= len(levels):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.bincount(levels[k], minlength=len(levels[k]))
    places = np.flatnonzero(counts[levels[k]] > 1)
    places = places[np.argsort(levels[-1][places])]
    prefix = np.zeros(len(places), np.int64)
    prefix[1:] = common_prefixes(levels, places[:-1], places[1:])
    prefix[prefix < depth] = 0
    return places, prefix


def hopeful(places: np.ndarray, prefix: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Without the intervals in which no two places are near enough for their longest common prefix."""
    group = np.cumsum(prefix == 0) - 1
    longest = np.zeros(int(group[-1]) + 1 if len(group) else 0, np.int64)
    np.maximum.at(longest, group, prefix)
    order = np.lexsort((places, group))
    gaps, same = np.diff(places[order]), np.diff(group[order]) == 0
    nearest = np.full(len(longest), np.iinfo(np.int64).max)
    np.minimum.at(nearest, group[order][1:][same], gaps[same])
    keep = (nearest <= longest // (times - 1))[group] if len(group) else np.zeros(0, bool)
    return places[keep], prefix[keep]


class Interval:
    """The places of an LCP interval, in order, and the same by the symbol on their left."""

    __slots__ = ("lists", "places")

    def __init__(self, place: int, left: int):
        self.places, self.lists = [place], {left: [place]}


def maximal_pairs(symbols: np.ndarray, setting: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, distance and common length of the maximal pairs that satisfy the constraints. ``symbols``
    begins with a symbol found nowhere else, and ends with one."""
    levels = prefix_ranks(symbols)
    places, prefix = hopeful(*sharing(levels, setting.depth), setting.times)
    del levels
    left = symbols[places - 1].tolist()
    before = dict(zip(places.tolist(), left))
    merges = np.flatnonzero(prefix)
    merges = merges[np.argsort(-prefix[merges], kind="stable")]
    intervals = [Interval(p, c) for p, c in zip(places.tolist(), left)]
    first, last = list(range(len(places))), list(range(len(places)))  # of the interval that ends or begins there
    out: list[tuple[int, int, int]] = []
    for at, common in zip(merges.tolist(), prefix[merges].tolist()):
        start, stop = first[at - 1], last[at]
        a, b = intervals[start], intervals[at]
        small, large = (a, b) if len(a.places) < len(b.places) else (b, a)
        reach, least = common // (setting.times - 1), max(1, setting.length - common)
        for place in small.places:
            near = bisect_left(large.places, place - reach)
            beside = large.places[near : near + 2]
            if not beside or beside[0] > place + reach:
                continue
            own = before[place]
            for other in {before[x] for x in beside if x <= place + reach}:
                if other == own:
                    continue
                row = large.lists[other]
                for x in row[bisect_left(row, place - reach) : bisect_left(row, place + reach + 1)]:
                    if abs(x - place) >= least:
                        out.append((min(x, place), abs(x - place), common))
        for place in small.places:
            insort(large.places, place)
            insort(large.lists.setdefault(before[place], []), place)
        intervals[start] = large
        intervals[at] = large
        first[stop], last[start] = start, stop
    found = np.array(out, np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def runs_of(numbers: np.ndarray, bounds: np.ndarray, setting: Runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, by text, start and period."""
    chosen = repeats(numbers, bounds, setting.depth)
    none = np.zeros(0, np.int64)
    if not len(chosen):
        return none, none, none, none
    many = int(numbers.max()) + 1
    sizes = np.diff(bounds)[chosen]
    begins = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])  # of each chosen text among the symbols
    symbols = np.empty(int(begins[-1]), np.int64)
    symbols[begins - 1] = many * len(chosen) + np.arange(len(begins))  # one of its own before each text and at the end
    for i, text in enumerate(chosen.tolist()):
        symbols[begins[i] : begins[i] + sizes[i]] = numbers[bounds[text] : bounds[text + 1]] + many * i
    start, period, common = maximal_pairs(symbols, setting)
    length = common + period
    order = np.lexsort((period, length, start))
    start, period, length = start[order], period[order], length[order]
    if len(start):  # of the pairs of one stretch the nearest
        new = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])])
        start, period, length = start[new], period[new], length[new]
    at = np.searchsorted(begins, start, "right") - 1
    order = np.lexsort((period, start))
    return chosen[at[order]], (start - begins[at])[order], length[order], period[order]


def collapsed(words: list[bytes], starts: list[int], lengths: list[int], periods: list[int]) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    kept = np.ones(len(words), bool)
    for s, n, p in zip(starts, lengths, periods):
        kept[s + p : s + n] = False
    return b" ".join([w for w, k in zip(words, kept.tolist()) if k])


# -- on tables ----------------------------------------------------------------------------------


def periodic_runs(docs: DataFrame, setting: Runs = Runs(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``key``, ``n_words``, ``runs`` (array of start, length and period in words, by start and period)
    and ``collapsed`` (the text without what its runs repeat) of every row.

    A null text counts as empty: no words, no runs, and an empty collapsed text. A null key stays null,
    repeated rows stay repeated, and equal texts have equal results. Other columns are not read, and an
    empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = filled(batch["_text"])
        numbers, bounds = word_numbers(texts)
        where, start, length, period = runs_of(numbers, bounds, setting)
        ends = np.searchsorted(where, np.arange(len(texts) + 1))
        data, offsets = bytes_of(texts)
        data, out = memoryview(data), []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            words, own = bytes(data[a:b]).split(), slice(int(ends[i]), int(ends[i + 1]))
            if own.start == own.stop:
                out.append(b" ".join(words))
            else:
                out.append(collapsed(words, start[own].tolist(), length[own].tolist(), period[own].tolist()))
        rows = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(run))
        return batch_of(
            _key=batch["_key"], n_words=np.diff(bounds).astype(np.int64),
            runs=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows), collapsed=pa.array(out, pa.binary()).cast(pa.string()),
        )

    ddl = f"_key {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return map_texts(docs.select(docs[key].alias("_key"), docs[text].alias("_text")), work, ddl, "_text").withColumnRenamed("_key", key)


def with_planted_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``text``; of the documents whose key's crc32 h is divisible by 10, the words from
    h div 10 mod their number on repeat with a period that the rest holds 3 to 10 times."""
    h = F.crc32(docs[key].cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(docs[text], r"[ \x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), again)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    chosen = F.coalesce((h % 10 == 0) & (n > 0), F.lit(False))
    return docs.select(docs[key].alias(key), F.when(chosen, planted).otherwise(docs[text]).alias(text))


def strongest(runs: str) -> Column:
    """The run of greatest length over period, compared exactly; of equal ones the first."""
    better = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def run_digests(docs: DataFrame, setting: Runs = Runs(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``key``, ``n_runs``, the strongest run's ``start``, ``length``, ``period`` and ``exponent_milli`` (null
    without a run), and hashes of all runs and of the collapsed text."""
    found = periodic_runs(docs, setting, key, text).withColumn("_best", strongest("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        key, F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"), F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
