"""Document fingerprints: a homomorphic multiset hash in DataFrame functions only.

Every paragraph (line with a character) hashes to a wide vector; the fingerprint is the sum over the
text's paragraphs, each place modulo a power of two. So the order of paragraphs does not matter, and
paragraphs are added to or taken from a fingerprint without the text. The vector has two parts:

- the identity, four sums modulo 2^32 hashed from the paragraph as a whole, and the number of its
  pieces modulo 2^32; equal multisets of paragraphs have equal identities;
- nine sketches of 64 places modulo 2^8. Each piece of the paragraph (a sentence) adds a byte at one
  place of the first, one in 8 pieces also of the second, one in 64 of the third, and so on. The places
  in which two sketches agree tell how many pieces differ, up to the longest text that a string holds,
  by the sketch that is neither full nor empty of differences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LANES, RATE = 64, 8
#: Two texts of 2^31 characters have at most 2^31 pieces; the coarsest of nine sketches counts 64 * ln(8) * 8^8.
SKETCHES = 9
IDENTITY = 4
HEX = 8 * (IDENTITY + 1) + 2 * LANES * SKETCHES


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p != "")


def pieces(text: Column) -> Column:
    """The sentences of all paragraphs: parts up to a full stop, question or exclamation mark."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"\n|(?<=[.!?])[ ]"), lambda p: p != "")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


#: Places of a sketch kept in one number, a byte each; the top byte stays free for carries.
PACKED = 7
LOW_BITS, HIGH_BITS = 0x7F7F7F7F7F7F7F, 0x80808080808080


def _sketch(hashes: Column, level: int) -> Column:
    """64 sums as hexadecimal bytes. A hash is cut into level bits, place and byte."""
    taken = hashes if level == 0 else F.filter(hashes, lambda h: h.bitwiseAND(RATE**level - 1) == 0)
    # Each hash becomes place * 256 + byte.
    keyed = F.transform(taken, lambda h: F.shiftrightunsigned(h, 32).bitwiseAND(LANES * 256 - 1))
    count = -(-LANES // PACKED)
    empty = F.array_repeat(F.lit(0).cast("long"), count)

    def put(sums: Column, k: Column) -> Column:
        place = F.shiftright(k, 8)
        home = F.floor(place / PACKED).cast("int")
        byte = F.call_function("shiftleft", k.bitwiseAND(255), (8 * (PACKED - 1 - place % PACKED)).cast("int"))
        # Bytes are added without carrying into each other: their low seven bits, then the eighth.
        added = lambda v: (v.bitwiseAND(LOW_BITS) + byte.bitwiseAND(LOW_BITS)).bitwiseXOR(v.bitwiseXOR(byte).bitwiseAND(HIGH_BITS))
        return F.transform(sums, lambda v, i: F.when(i == home, added(v)).otherwise(v))

    digits = lambda sums: F.array_join(F.transform(sums, lambda v: F.lpad(F.hex(v), 2 * PACKED, "0")), "")
    return F.substring(F.aggregate(keyed, empty, put, digits), 1, 2 * LANES)


def _hex32(value: Column) -> Column:
    return F.lpad(F.hex(value), 8, "0")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as 1192 hexadecimal digits; null counts as empty."""
    part = lambda s, i: F.conv(F.substring(s, 8 * i + 1, 8), 16, 10).cast("long")
    zero = F.array_repeat(F.lit(0).cast("long"), IDENTITY)
    add = lambda sums, p: _bound(
        F.sha2(p, 256), lambda s: F.array(*[(F.get(sums, F.lit(i)) + part(s, i)) % (1 << 32) for i in range(IDENTITY)])
    )
    identity = F.aggregate(paragraphs(text), zero, add, lambda sums: F.array_join(F.transform(sums, _hex32), ""))
    hashes = F.transform(pieces(text), lambda p: F.xxhash64(p))
    rest = _bound(hashes, lambda h: F.concat(_hex32(F.size(h).cast("long")), *[_sketch(h, level) for level in range(SKETCHES)]))
    return F.lower(F.concat(identity, rest))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both texts' paragraphs together, or of ``a`` without those of ``b``."""
    head = [
        _hex32(F.pmod(_number(a, 8 * i + 1, 8) + sign * _number(b, 8 * i + 1, 8), F.lit(1 << 32)))
        for i in range(IDENTITY + 1)
    ]
    places = F.sequence(F.lit(0), F.lit(LANES * SKETCHES - 1))
    start = 8 * (IDENTITY + 1) + 1
    tail = F.transform(
        places, lambda i: F.lpad(F.hex(F.pmod(_number(a, i * 2 + start, 2) + sign * _number(b, i * 2 + start, 2), F.lit(256))), 2, "0")
    )
    return F.lower(F.concat(*head, F.array_join(tail, "")))


def _number(text: Column, start, length: int) -> Column:
    begin = start if isinstance(start, Column) else F.lit(start)
    return F.conv(F.substring(text, begin, F.lit(length)), 16, 10).cast("long")


def likeness(a: Column, b: Column) -> Column:
    """The share of pieces that two fingerprints have in common, estimated from them alone; 1 if the
    fingerprints are equal."""
    n = _number(a, 8 * IDENTITY + 1, 8) + _number(b, 8 * IDENTITY + 1, 8)
    differing = F.lit(None).cast("double")
    for level in reversed(range(SKETCHES)):
        start = 8 * (IDENTITY + 1) + 2 * LANES * level + 1
        ours, theirs = F.substring(a, start, 2 * LANES), F.substring(b, start, 2 * LANES)
        same = F.aggregate(
            F.sequence(F.lit(1), F.lit(2 * LANES - 1), F.lit(2)),
            F.lit(0),
            lambda s, i: s + (F.substring(ours, i, F.lit(2)) == F.substring(theirs, i, F.lit(2))).cast("int"),
        )
        found = -LANES * F.log(F.greatest(same, F.lit(0.5)) / LANES) * (RATE**level)
        # A sketch with places enough in agreement is trusted; the finest of these decides.
        differing = F.when(same >= LANES / 8, found).otherwise(F.coalesce(differing, found))
    shared = F.greatest(n - differing, F.lit(0.0)) / F.greatest(n + differing, F.lit(1.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.least(shared, F.lit(1.0)))


def neighbours(docs: DataFrame, key: str, text: str, ranges: int | None = None) -> DataFrame:
    """``_key``, ``_text`` and ``_next``, the text of the row with the next smaller key; the row with
    the smallest key gets the text of that with the largest. Keys are whole numbers.

    Rows are cut by (key, hash of the text) into as many ranges as the session shuffles into; the first row
    of each range, one of it, also goes to the range before it as a guest, so the whole order is known after
    one shuffle of the texts.
    """
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(docs[key].cast("long"), F.lit(-(1 << 63)))
    narrow = docs.select(docs[key].alias("_key"), F.coalesce(docs[text], F.lit("")).alias("_text"), order.alias("_order"))
    narrow = narrow.withColumn("_tie", F.xxhash64("_text"))
    lows, heads = _cuts(narrow.select("_order", "_tie"), ranges)
    every = range(len(lows))
    rows = narrow.withColumn("_range", _range(F.col("_order"), F.col("_tie"), lows))
    is_head = (F.col("_order") == _at([h[0] for h in heads], "_range")) & (F.col("_tie") == _at([h[1] for h in heads], "_range"))
    guests = rows.filter(is_head).dropDuplicates(["_range"])
    # In descending order a range is followed by the one below it, and the last by the first.
    host = _at([(r + 1) % max(1, len(lows)) for r in every], "_range").cast("int")
    both = rows.withColumn("_guest", F.lit(False)).unionByName(guests.withColumns({"_range": host, "_guest": F.lit(True)}))
    placed = both.repartitionById(max(1, len(lows)), F.col("_range"))
    return placed.withColumn("_next", F.lead("_text").over(_in_order()))


def _in_order():
    """The window over a range in descending order, the guest at the end."""
    return Window.partitionBy("_range").orderBy("_guest", F.col("_order").desc(), F.col("_tie").desc(), "_text")


def _at(values: list[int], index: str) -> Column:
    """The value of a constant list, given as one short expression, at an index."""
    return F.get(F.split(F.lit(",".join(map(str, values or [0]))), ",").cast("array<bigint>"), F.col(index))


Pair = tuple[int, int]


def _cuts(keys: DataFrame, ranges: int) -> tuple[list[Pair], list[Pair]]:
    """The least and the greatest (order, tie) of each range, by rising order: two rows for each task."""
    pair = F.struct("_order", "_tie")
    placed = keys.repartitionByRange(ranges, "_order", "_tie").groupBy(F.spark_partition_id().alias("r"))
    found = placed.agg(F.min(pair).alias("low"), F.max(pair).alias("head")).collect()
    found = sorted((tuple(r["low"]), tuple(r["head"])) for r in found)
    return [r[0] for r in found], [r[1] for r in found]


def _range(order: Column, tie: Column, lows: list[Pair]) -> Column:
    """The number of the range that a row lies in, by halving."""
    if len(lows) < 2:
        return F.lit(0)
    bounds = lows[1:]
    arrays = [F.split(F.lit(",".join(str(b[i]) for b in bounds)), ",").cast("array<bigint>") for i in (0, 1)]
    step = 1 << (len(bounds).bit_length() - 1)
    steps = F.array(*[F.lit(step >> i) for i in range(step.bit_length())])

    def take(at: Column, s: Column) -> Column:
        low, low_tie = (F.get(a, at + s - 1) for a in arrays)
        return F.when((at + s <= len(bounds)) & ((low < order) | ((low == order) & (low_tie <= tie))), at + s).otherwise(at)

    return F.aggregate(steps, F.lit(0), take)


def edited(text: Column, after: Column) -> Column:
    """The last half of the code points (rounded down) replaced by the first as many of ``after``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(after, F.lit(1), half))


def document_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per row: key, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited`` and ``near_next``.

    A null text counts as empty; its fingerprint is that of no paragraph. Null keys come last in the
    descending order, rows of equal keys are ordered by a hash of their text, a single row is its own
    neighbour, and an empty table gives no rows. Other columns are not read.
    """
    near = neighbours(docs, key, text, ranges)
    changed = near.withColumns({"_edited": edited(F.col("_text"), F.col("_next")), "_print": fingerprint(F.col("_text"))})
    # Same ranges and order as before: no second shuffle or sort.
    after = changed.withColumn("_after", F.lead("_print").over(_in_order())).filter(~F.col("_guest"))
    done = after.withColumn("_edited_print", fingerprint(F.col("_edited")))
    return done.select(
        F.col("_key").alias(key),
        F.char_length("_text").cast("long").alias("n_chars"),
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        F.col("_print").alias("fingerprint"),
        F.col("_edited_print").alias("edited_fingerprint"),
        likeness(F.col("_print"), F.col("_edited_print")).alias("near_edited"),
        likeness(F.col("_print"), F.col("_after")).alias("near_next"),
    )
