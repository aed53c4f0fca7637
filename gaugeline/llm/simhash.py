"""SimHash near-duplicates by the generalised pigeonhole principle.

Equal fingerprints are joined first, so the search sees each fingerprint once. The 64 bits are
grouped into partitions of correlated bits; each partition i gets a threshold t_i with
sum(t_i) = distance - partitions + 1 (-1: the partition is not used), so two fingerprints within the
distance differ by at most t_i bits in some partition i. The thresholds are found by dynamic
programming on the candidates that the partitions' histograms predict. Fingerprints are probed by
partition value, candidates verified by their whole distance.

A value that too many fingerprints share is not compared all with all: fingerprints that agree on it
within t_i must agree exactly on one of four groups of the other bits, so its rows are dealt out anew
by these, again and again until the groups are small. Within a group only a spanning forest of the
links is kept, and components are found by joins over the forests.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.texts import batch_of, bytes_of, filled, map_texts, pa_schema
from gaugeline.session import written
from gaugeline.ship import ship

BITS = 64
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16


@dataclass(frozen=True)
class NearDup:
    """``distance`` bits may differ. ``group`` is the size up to which the fingerprints of one value
    are compared with each other in a task; larger groups are split by more bits, never cut."""

    distance: int = 3
    shingle: int = 3
    seed: int = 42
    partitions: int = 4
    group: int = 512

    def __post_init__(self):
        # With fewer bits left than parts, a group holds at most 17 * 2^distance fingerprints.
        if self.group < 17 << (self.distance + 1):
            raise ValueError("group is too small for splitting to end")


# -- fingerprints -------------------------------------------------------------------------------


def fingerprint_texts(texts: pa.Array, setting: NearDup) -> np.ndarray:
    """The fingerprint of each text: bits set in over half of its shingles' hashes."""
    data, offsets = bytes_of(texts)
    raw = data.tobytes().lower()  # ASCII letters only
    seed, width, hashed = setting.seed, setting.shingle, xxhash.xxh64_intdigest
    hashes = array("Q")
    counts = np.zeros(len(texts), np.int64)
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        text = b" ".join(raw[a:b].split())
        if not text:
            continue
        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        if len(spaces) < width - 1:
            hashes.append(hashed(text, seed))
            counts[row] = 1
            continue
        starts = np.concatenate([[0], spaces + 1])[: len(spaces) + 2 - width].tolist()
        stops = np.concatenate([spaces, [len(text)]])[width - 1 :].tolist()
        hashes.extend(array("Q", [hashed(text[s:e], seed) for s, e in zip(starts, stops)]))
        counts[row] = len(starts)
    votes, ends = np.zeros((len(texts), BITS), np.int64), np.cumsum(counts)
    values = np.frombuffer(hashes, np.uint64) if hashes else np.zeros(0, np.uint64)
    for low in range(0, len(values), BLOCK):  # a block may end within a text
        part = values[low : low + BLOCK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first, last = np.searchsorted(ends, [low, low + len(part) - 1], "right")
        rows = first + np.flatnonzero(counts[first : last + 1])
        at = np.maximum(ends[rows] - counts[rows], low) - low
        votes[rows] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    major = (2 * votes > counts[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, setting: NearDup = NearDup(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``key``, ``code`` (the fingerprint as a signed long) and ``text_hash`` of every row. Texts
    without a word, and null texts, have fingerprint zero."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes = fingerprint_texts(filled(batch["_text"]), setting)
        return batch_of(_key=batch["_key"], code=codes.view(np.int64), text_hash=batch["text_hash"])

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"), F.xxhash64(docs[text]).alias("text_hash"))
    return map_texts(narrow, work, f"_key {kind}, code bigint, text_hash bigint", "_text").withColumnRenamed("_key", key)


# -- partitions and thresholds ------------------------------------------------------------------


def co_occurrence(codes: DataFrame) -> np.ndarray:
    """How often each two bits are both set, the number of codes at the end: 64 x 64 + 1 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = unpacked(batch["code"].to_numpy()).astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        if n:
            yield batch_of(i=np.arange(BITS * BITS + 1), n=np.append(total.ravel(), n).astype(np.int64))

    sums = codes.select("code").mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS + 1)
    for row in sums:
        out[row["i"]] = row["n"]
    return out


def unpacked(codes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(codes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def grouped_bits(statistics: np.ndarray, partitions: int) -> list[list[int]]:
    """Bits dealt into partitions of equal width, each bit to the most correlated ones."""
    n = max(statistics[-1], 1)
    both = statistics[:-1].reshape(BITS, BITS) / n
    mean = np.diag(both)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    related = np.abs(both - np.outer(mean, mean)) / np.outer(spread, spread)
    free, out, width = set(range(BITS)), [], BITS // partitions
    for p in range(partitions):
        size = width if p < partitions - 1 else len(free)
        entropy = {b: mean[b] * (1 - mean[b]) for b in free}
        group = [min(free, key=lambda b: (entropy[b], b))]  # the least telling bits end up together
        free.discard(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (related[b, group].mean(), -b))
            group.append(best)
            free.discard(best)
        out.append(sorted(group))
    return out


def picked(codes: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each code, as a number."""
    out = np.zeros(len(codes), np.uint64)
    for i, b in enumerate(bits):
        out |= ((codes >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out.astype(np.int64)


def histograms(codes: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """Codes of each value of each partition: at most 2^16 counters a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(bits), np.int64) for bits in groups]
        for batch in batches:
            values = batch["code"].to_numpy().view(np.uint64)
            for c, bits in zip(counts, groups):
                c += np.bincount(picked(values, bits), minlength=len(c))
        for p, c in enumerate(counts):
            some = np.flatnonzero(c)
            yield batch_of(p=np.full(len(some), p, np.int32), v=some, n=c[some])

    rows = codes.select("code").mapInArrow(run, "p int, v bigint, n bigint").groupBy("p", "v").agg(F.sum("n").alias("n")).toArrow()
    p, v, n = (rows[c].to_numpy() for c in ("p", "v", "n"))
    out = [np.zeros(1 << len(bits), np.int64) for bits in groups]
    for i in range(len(groups)):
        out[i][v[p == i]] = n[p == i]
    return out


def flips(width: int, threshold: int) -> list[int]:
    """All masks of at most ``threshold`` of ``width`` bits."""
    return [sum(1 << b for b in bits) for r in range(threshold + 1) for bits in combinations(range(width), r)]


def allotted(counts: list[np.ndarray], distance: int) -> list[int]:
    """Thresholds with the least predicted work: candidates met plus probes sent. None is tried above 2 or an
    even share of the distance, whichever is more, as the probes grow with its power."""
    partitions = len(counts)
    total = distance - partitions + 1

    def cost(p: int, t: int) -> float:
        if t < 0:
            return 0.0
        c = counts[p].astype(float)
        index = np.arange(len(c))
        masks = flips(len(c).bit_length() - 1, t)
        near = sum(c[index ^ m] for m in masks)
        return float(c @ near) / 64 + c.sum() * len(masks)  # a comparison costs far less than a row

    choices = range(-1, min(distance, max(2, -(-total // partitions))) + 1)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for p in range(partitions):
        after: dict[int, tuple[float, list[int]]] = {}
        costs = {t: cost(p, t) for t in choices}
        for spent, (before, chosen) in best.items():
            for t in choices:
                entry = (before + costs[t], [*chosen, t])
                if spent + t not in after or entry < after[spent + t]:
                    after[spent + t] = entry
        best = after
    return best[total][1]


# -- probing ------------------------------------------------------------------------------------


def probes(codes: DataFrame, groups: list[list[int]], thresholds: list[int]) -> DataFrame:
    """Each code under every partition value it may meet others at: ``p``, ``v``, ``code``, and
    ``home`` for its own value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes_ = batch["code"].to_numpy()
            for p, (bits, t) in enumerate(zip(groups, thresholds)):
                if t < 0:
                    continue
                own = picked(codes_.view(np.uint64), bits)
                for mask in flips(len(bits), t):
                    yield batch_of(p=np.full(len(own), p, np.int32), v=own ^ mask, code=codes_, home=np.full(len(own), mask == 0))

    return codes.select("code").mapInArrow(run, "p int, v bigint, code bigint, home boolean")


def forest(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the codes, by breadth-first search over block rows."""
    left = np.arange(len(codes))
    a, b = [], []
    while len(left) > 1:
        seen, queue = np.zeros(len(left), bool), [0]
        seen[0] = True
        while queue:
            i = queue.pop()
            fresh = np.flatnonzero(~seen & (np.bitwise_count(codes[left] ^ codes[left[i]]) <= distance))
            seen[fresh] = True
            queue.extend(fresh.tolist())
            a.extend([left[i]] * len(fresh))
            b.extend(left[fresh])
        left = left[~seen]
    return codes[np.array(a, np.int64)], codes[np.array(b, np.int64)]


def _links_of_groups(distance: int):
    """Links within each group of a partition whose rows are sorted by group (p, path, v)."""

    def linked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(codes) == 2:
            if np.bitwise_count(codes[0] ^ codes[1]) <= distance:
                return codes[:1], codes[1:]
            return codes[:0], codes[:0]
        return forest(codes, distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            path, v = batch["path"].to_numpy(), batch["v"].to_numpy()
            codes = batch["code"].to_numpy().view(np.uint64)
            if not len(codes):
                continue
            cut = np.flatnonzero((path[1:] != path[:-1]) | (v[1:] != v[:-1])) + 1
            bounds = np.concatenate([[0], cut, [len(codes)]])
            a, b = [], []
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                group_key, own = (path[s], v[s]), codes[s:e]
                if group_key == held_key:
                    held = np.concatenate([held, own])
                else:
                    if len(held) > 1:
                        x, y = linked(np.unique(held))
                        a.append(x)
                        b.append(y)
                    held_key, held = group_key, own
            if a:
                yield batch_of(a=np.concatenate(a).view(np.int64), b=np.concatenate(b).view(np.int64))
        if len(held) > 1:
            x, y = linked(np.unique(held))
            yield batch_of(a=x.view(np.int64), b=y.view(np.int64))

    return run


def links(codes: DataFrame, setting: NearDup = NearDup()) -> DataFrame:  # noqa: B008
    """Pairs (a, b) of distinct codes within the distance whose components are those of all links."""
    groups = grouped_bits(co_occurrence(codes), setting.partitions)
    counts = histograms(codes, groups)
    thresholds = allotted(counts, setting.distance)
    rows = written(probes(codes, groups, thresholds).withColumn("path", F.col("p").cast("long")), "probes")
    # The bits that have not been used on the way to a group; a group's path names them.
    rest = {p: [b for b in range(BITS) if b not in set(bits)] for p, bits in enumerate(groups)}
    found = []
    while True:
        sizes = written(rows.groupBy("path", "v").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("met")), "sizes")
        live = sizes.filter((F.col("n") > 1) & F.col("met"))  # a value without a home row pairs nothing new
        small = rows.join(live.filter(F.col("n") <= setting.group).select("path", "v"), ["path", "v"])
        dealt = small.select("path", "v", "code").repartition("path", "v").sortWithinPartitions("path", "v")
        found.append(written(dealt.mapInArrow(_links_of_groups(setting.distance), "a bigint, b bigint"), "links"))
        large = live.filter(F.col("n") > setting.group)
        if large.isEmpty():
            break
        rows, rest = _split_groups(written(rows.join(large.select("path", "v"), ["path", "v"]), "large"), rest, setting.distance)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _split_groups(rows: DataFrame, rest: dict[int, list[int]], distance: int) -> tuple[DataFrame, dict[int, list[int]]]:
    """Deal the rows of large groups out by the exact value of each of distance + 1 groups of their
    unused bits: two codes within the distance agree on one of them at least. Paths and values are
    renumbered; the value takes in the one before, so the sub-groups of different groups stay apart."""
    parts: dict[int, list[list[int]]] = {}
    after: dict[int, list[int]] = {}
    numbers: dict[tuple[int, int], int] = {}
    for path, bits in sorted(rest.items()):
        parts[path] = [p.tolist() for p in np.array_split(np.array(bits, np.int64), distance + 1)]
        for j, part in enumerate(parts[path]):
            numbers[path, j] = len(numbers)
            after[numbers[path, j]] = [b for b in bits if b not in set(part)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path, v = batch["path"].to_numpy(), batch["v"].to_numpy()
            codes, home = batch["code"].to_numpy(), batch["home"].to_numpy(zero_copy_only=False)
            for one in np.unique(path):
                own = path == one
                for j, part in enumerate(parts[int(one)]):
                    value = picked(codes[own].view(np.uint64), part)
                    mixed = (v[own] << np.int64(len(part))) | value
                    yield batch_of(path=np.full(len(value), numbers[int(one), j], np.int64), v=mixed, code=codes[own], home=home[own])

    used = rows.select("path", "v", "code", "home")
    return written(used.mapInArrow(run, "path bigint, v bigint, code bigint, home boolean"), "split"), after


# -- components ---------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that has an edge.

    Alternating star contraction: large stars point every larger neighbour at the smallest one,
    small stars every node and its smaller neighbours. Each step is a grouped minimum, combined
    before the shuffle, and a join that can be split at hub nodes; its result is a written table.
    """
    current = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "stars")
    before = None
    while True:
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = written(large.distinct(), "stars")
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        current = written(small.unionByName(lowest.select("u", F.col("low").alias("v"))).distinct(), "stars")
        state = current.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(u as decimal(38,0)) + v)")).first()
        if state == before:
            break
        before = state
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped(docs: DataFrame, setting: NearDup = NearDup(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``key``, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest key reachable) and
    ``text_hash`` of every row.

    Rows link if their fingerprints differ in at most ``distance`` bits; equal texts always do. Null
    texts count as empty. A null key stays null and is no component's smallest unless all are null.
    Repeated rows stay repeated. Other columns are not read, and an empty table gives no rows.
    """
    ship(docs.sparkSession)
    marked = written(fingerprints(docs, setting, key, text), "fingerprints")
    codes = written(marked.groupBy("code").agg(F.min(key).alias("_least")), "codes")
    roots = written(components(links(codes, setting)), "roots")
    placed = codes.join(roots, codes["code"] == roots["node"], "left").select("code", "_least", F.coalesce("root", "code").alias("root"))
    placed = written(placed, "placed")
    least = placed.groupBy("root").agg(F.min("_least").alias("component_id"))
    named = placed.join(least, "root").select("code", "component_id")
    return marked.join(named, "code").select(
        key, F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id", "text_hash"
    )


def text_groups(docs: DataFrame, setting: NearDup = NearDup(), text: str = "text") -> DataFrame:  # noqa: B008
    """``text_hash`` and ``component_id`` (the smallest hash of a text reachable) of every row. The components
    are those of ``grouped``, told apart where keys repeat or are null too."""
    texts = docs.select(F.xxhash64(docs[text]).alias("_key"), docs[text].alias("_text"))
    return grouped(texts, setting, "_key", "_text").select("text_hash", "component_id")


def representatives(docs: DataFrame, setting: NearDup = NearDup(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """One row of each component, with all its columns: that of the smallest key (nulls last, then
    by a hash of the text; of repeated rows one)."""
    found = written(grouped(docs, setting, key, text).select(F.col(key).alias("_key"), "component_id", F.col("text_hash").alias("_hash")), "grouped")
    return first_rows(docs, found, key, text)


def first_rows(docs: DataFrame, found: DataFrame, key: str, text: str) -> DataFrame:
    """The representatives by ``_key``, ``_hash`` (of the text) and ``component_id`` of every row."""
    first = found.groupBy("component_id").agg(
        F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "_hash")).alias("first")
    )
    chosen = first.select(F.col("first._key").alias("_key"), F.col("first._hash").alias("_hash"))
    repeated = found.groupBy("_key", "_hash").agg(F.count(F.lit(1)).alias("_copies"))
    on = chosen["_key"].eqNullSafe(repeated["_key"]) & (chosen["_hash"] == repeated["_hash"])
    chosen = written(repeated.join(chosen, on, "left_semi"), "chosen")
    name = "_text_hash"
    while name in docs.columns:
        name += "_"
    hashed = docs.withColumn(name, F.xxhash64(docs[text]))
    same = lambda ids: hashed[key].eqNullSafe(ids["_key"]) & (hashed[name] == ids["_hash"])
    single = chosen.filter("_copies = 1")
    kept = hashed.join(single, same(single), "left_semi").drop(name)
    many = chosen.filter("_copies > 1")
    if not many.isEmpty():
        again = hashed.join(many, same(many), "left_semi").dropDuplicates([key, name]).drop(name)
        kept = kept.unionByName(again)
    return kept
