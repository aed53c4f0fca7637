"""Personal data: pattern spans, and spans that a trained tagger adds.

The patterns' spans in the corpus label windows of characters; a bounded sample of these, with
varied spellings, trains a bidirectional LSTM with CRF transitions. It then reads overlapping windows
around every digit, at sign and spelled-out address in any case of letters. Each character takes its tag from the window in
which it lies furthest from the edges, so the spans of a document are put together over all windows;
a proposed span counts if its form fits its kind and it touches no pattern span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm import tagger
from gaugeline.llm.texts import batch_of, filled, map_texts, pa_schema, slices
from gaugeline.session import written
from gaugeline.ship import ship

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end


@dataclass(frozen=True)
class Settings:
    """``window`` and ``stride`` of the tagger in characters, and its training. ``address``: where the tags of an
    address do not end where its form does, the form is looked for so many characters to both sides (no
    address is longer than 320); addresses whose tags fit their form have no such bound."""

    window: int = 48
    stride: int = 24
    sample: int = 600  # training windows of each kind at most, and of windows without a span
    steps: int = 400
    address: int = 320
    seed: int = 11


# -- patterns -----------------------------------------------------------------------------------
# The leftmost matches, found in linear time: a match can begin nowhere else than stated.

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: A text without one of these holds no span of the four kinds, nor a window without one of the second.
TRIGGER = r"(?i)[0-9@]|\b(?:at|dot)\b"
TRIGGERS = re.compile(r"(?i)[0-9@]|[\[(]\s?at\s?[\])]|\bdot\b|\bat\b\s?[\w-]++(?:\.[\w-]++)++")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the patterns, and matches dropped for their digits."""
    good, dropped, end = [], [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            good.append((0, start, match.end()))
            end = match.end()
        at = text.find("@", max(at + 1, end))
    for match in IP.finditer(text):
        fits = all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in match[0].split("."))
        (good if fits else dropped).append((1, *match.span()))
    for match in CARD.finditer(text):
        digits = digits_of(match[0])
        if 13 <= len(digits) <= 19:
            (good if luhn(digits) else dropped).append((2, *match.span()))
    for match in PHONE.finditer(text):
        (good if 9 <= len(digits_of(match[0])) <= 15 else dropped).append((3, *match.span()))
    return sorted(good), dropped


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


# -- the tagger's view --------------------------------------------------------------------------

#: Characters as small numbers: ASCII as it is, other letters, everything else, and padding.
SYMBOLS = 131


def symbols_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points, np.where((points >= 0xC0) & (points < 0x2000), 128, 129)).astype(np.int64)


def windows_of(text: str, settings: Settings) -> list[int]:
    """Starts of the windows on the grid of strides that hold a part of a trigger, or of the name before
    a bare at."""
    size, stride = settings.window, settings.stride
    found: set[int] = set()
    for match in TRIGGERS.finditer(text):
        start, end = match.span()
        if end - start > 3 and match[0][0] in "aA":
            start -= start > 0 and text[start - 1].isspace()
            while start > 0 and (text[start - 1].isalnum() or text[start - 1] in LOCAL):
                start -= 1
        low = max(0, -(-(start - size + 1) // stride))
        found.update(range(low * stride, end, stride))
    return sorted(found)


def padded(symbols: np.ndarray, starts: list[int], size: int) -> np.ndarray:
    room = np.concatenate([symbols, np.full(size, SYMBOLS - 1)])
    return room[np.array(starts, np.int64)[:, None] + np.arange(size)]


ADDED = (
    re.compile(r"(?i)(?:[\w.%+-]+\s?[\[(]?\s?\bdot\b\s?[\])]?\s?)*[\w.%+-]{2,}\s?(?:@|[\[(]\s?at\s?[\])]|\bat\b)\s?[\w-]+(?:(?:\.|\s?[\[(]?\s?\bdot\b\s?[\])]?\s?)[\w-]+)+"),
    re.compile(r"[0-9]{1,3}(?: ?[\[(]?[.,][\])]? ?[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[ .\-]?[0-9]){12,18}"),
    re.compile(r"(?:\+|\(|00|[0-9])[0-9 ().\-/]*[ ().\-/][0-9 ().\-/]*[0-9]"),
)


def fits(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a proposed span has the form of its kind and stands free."""
    part = text[start:end]
    if not ADDED[kind].fullmatch(part):
        return False
    if text[start - 1 : start].isalnum() or text[end : end + 1].isalnum():
        return False
    return kind != 3 or 9 <= len(digits_of(part)) <= 15


def added_spans(text: str, tags: np.ndarray, base: list[Span], settings: Settings = Settings()) -> list[Span]:  # noqa: B008
    """Runs of equal tags that fit their kind, and addresses that a run of the kind lies on, that touch
    no other span."""
    taken = np.zeros(len(text) + 1, bool)
    for _, s, e in base:
        taken[s:e] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])) != 0)
    out = []
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        kind = int(tags[start]) - 1
        if kind < 0:
            continue
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        spans = [(start, end)] if start < end else []
        if spans and kind == 0 and not fits(text, kind, start, end):
            # The tags say that there is an address, its form where it begins and ends.
            near = ADDED[0].finditer(text, max(0, start - settings.address), end + settings.address)
            spans = [m.span() for m in near if m.start() < end and m.end() > start]
        for s, e in spans:
            if not taken[s:e].any() and fits(text, kind, s, e):
                out.append((kind, s, e))
                taken[s:e] = True
    return out


def tag_texts(texts: list[str], model: dict[str, np.ndarray], settings: Settings) -> list[np.ndarray]:
    """A tag for every character of each text (0: none)."""
    size = settings.window
    out, parts, owners = [np.zeros(len(t), np.int8) for t in texts], [], []
    for row, text in enumerate(texts):
        starts = windows_of(text, settings)
        if starts:
            parts.append(padded(symbols_of(text), starts, size))
            owners.extend((row, s) for s in starts)
    if not owners:
        return out
    every, decoded = np.concatenate(parts), []
    for at in range(0, len(every), 4096):
        decoded.append(tagger.viterbi(model, tagger.emissions(model, every[at : at + 4096])))
    depth = np.minimum(np.arange(size), np.arange(size)[::-1]) + 1
    trust = [np.zeros(len(t), np.int16) for t in texts]
    for (row, start), tags in zip(owners, np.concatenate(decoded)):
        n = min(size, len(texts[row]) - start)
        here = slice(start, start + n)
        own = depth[:n].copy()
        if start == 0:  # a text's own edge is no cut
            own[: size // 2] = size
        if start + size >= len(texts[row]):
            own[max(0, n - size // 2) :] = size
        better = own > trust[row][here]
        out[row][here][better] = tags[:n][better]
        trust[row][here][better] = own[better]
    return out


# -- training -----------------------------------------------------------------------------------


def labelled_windows(docs: DataFrame, settings: Settings, text: str) -> DataFrame:
    """Windows around pattern spans, and around all triggers without one, the first ``sample`` of each kind by
    ``rank`` (a hash) in each slice: ``kind`` (4: none), ``text``, ``tags`` (a digit for each character). Windows with a dropped match are left
    out, as their truth is not known."""
    ship(docs.sparkSession)
    ddl = "kind int, rank bigint, text string, tags string"
    schema = pa_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            rows = []
            for whole in filled(part["_text"]).filter(pc.match_substring_regex(filled(part["_text"]), TRIGGER)).to_pylist():
                good, dropped = base_spans(whole)
                tags = np.zeros(len(whole), np.int8)
                for k, s, e in good:
                    tags[s:e] = np.where(tags[s:e] == 0, k + 1, tags[s:e])
                unclear = np.zeros(len(whole) + 1, bool)
                for _, s, e in dropped:
                    unclear[s:e] = True
                centres = [(k, (s + e) // 2) for k, s, e in good]
                centres += [(4, m.start()) for m in TRIGGERS.finditer(whole) if not tags[m.start()]]
                for k, centre in centres:
                    mix = int.from_bytes(hashlib.blake2b(f"{centre}:{whole[:200]}".encode("utf-8", "replace"), digest_size=7).digest(), "big")
                    start = max(0, centre - settings.window // 2 + mix % 17 - 8)
                    end = min(len(whole), start + settings.window)
                    if not unclear[start:end].any():
                        rows.append({"kind": k, "rank": mix, "text": whole[start:end], "tags": "".join(map(str, tags[start:end]))})
            # The first ``sample`` windows of each kind over all texts are among the first of each slice.
            rows.sort(key=lambda r: (r["kind"], r["rank"], r["text"], r["tags"]))
            first = [r for _, own in groupby(rows, key=lambda r: r["kind"]) for r in islice(own, settings.sample)]
            if first:
                yield pa.RecordBatch.from_pylist(first, schema)

    return docs.select(docs[text].alias("_text")).mapInArrow(run, ddl)


def varied(text: str, tags: str, draw: np.random.Generator) -> tuple[str, str]:
    """The window with its spans in another spelling: other digits and separators, spelled-out
    signs, no plus. What is not in a span stays."""
    out, out_tags, i = [], [], 0
    while i < len(text):
        j = i
        while j < len(text) and tags[j] == tags[i]:
            j += 1
        part, tag = text[i:j], tags[i]
        if tag != "0":
            part = "".join(str(draw.integers(10)) if "0" <= c <= "9" else c for c in part)
        if tag == "1" and draw.random() < 0.6:
            upper = draw.random() < 0.2
            spelled = lambda x: x.upper() if upper else x
            part = part.replace("@", spelled(draw.choice([" at ", " (at) ", "[at]", " [at] ", "(at)"])))
            if draw.random() < 0.7:
                part = part.replace(".", spelled(draw.choice([" dot ", " (dot) ", "[dot]"])))
        elif tag == "2" and draw.random() < 0.3:
            part = part.replace(".", draw.choice(["[.]", " . ", "(.)"]))
        elif tag == "3":
            plain = digits_of(part)
            mark = draw.choice(["", " ", "-", "."])
            part = mark.join(plain[k : k + 4] for k in range(0, len(plain), 4))
        elif tag == "4":
            if draw.random() < 0.5:
                part = part.lstrip("+")
            mark = draw.choice([" ", "-", ".", "/"])
            if draw.random() < 0.6:
                part = re.sub(r"[ .\-]+", mark, part)
            if draw.random() < 0.3:
                part = part.replace("(", "").replace(")", "")
        out.append(part)
        out_tags.append(tag * len(part))
        i = j
    return "".join(out), "".join(out_tags)


def fit(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> dict[str, np.ndarray] | None:  # noqa: B008
    """Train on at most ``sample`` windows of each kind, the first by their hash. Without any labelled
    span there is no model, and the patterns stand alone."""
    found = written(labelled_windows(docs, settings, text), "windows")
    rows = []
    for kind in range(len(KINDS) + 1):
        rows += found.filter(F.col("kind") == kind).orderBy("rank", "text", "tags").limit(settings.sample).collect()
    if not any(r["kind"] < len(KINDS) for r in rows):
        return None
    draw, size = np.random.default_rng(settings.seed), settings.window
    texts, tags = [], []
    for row in rows:
        pairs = [(row["text"], row["tags"])]
        if row["kind"] < len(KINDS):
            pairs += [varied(row["text"], row["tags"], draw) for _ in range(2)]
        for t, g in pairs:
            texts.append(padded(symbols_of(t), [0], size)[0])
            tags.append(np.array([*map(int, g[:size]), *[0] * (size - len(g[:size]))]))
    shape = tagger.Shape(SYMBOLS, len(KINDS) + 1)
    return tagger.train(np.array(texts), np.array(tags), shape, settings.steps, seed=settings.seed)


# -- operators ----------------------------------------------------------------------------------


def spans_of(texts: pa.Array, model: dict[str, np.ndarray] | None, settings: Settings) -> list[tuple[list[Span], list[Span]]]:
    """Pattern spans and added spans of each text."""
    out: list[tuple[list[Span], list[Span]]] = [([], []) for _ in range(len(texts))]
    rows = np.flatnonzero(pc.match_substring_regex(texts, TRIGGER).to_numpy(zero_copy_only=False))
    some = texts.take(pa.array(rows)).to_pylist()
    tags = tag_texts(some, model, settings) if model else [np.zeros(len(t), np.int8) for t in some]
    for row, text, tag in zip(rows.tolist(), some, tags):
        base = base_spans(text)[0]
        out[row] = (base, added_spans(text, tag, base, settings))
    return out


def personal_data(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``key``, the numbers of pattern spans, ``base_sha256``, ``spans`` and ``n_added`` of every row.

    A null text counts as empty and has no spans; a null key stays null; repeated rows get equal
    spans; other columns are not read, and an empty table gives no rows.
    """
    model = fit(docs, settings, text)
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = spans_of(filled(batch["_text"]), model, settings)
        counts = np.array([[sum(1 for k, _, _ in base if k == i) for i in range(4)] for base, _ in found], np.int64).reshape(-1, 4)
        return batch_of(
            _key=batch["_key"], n_email=counts[:, 0], n_ip=counts[:, 1], n_card=counts[:, 2], n_phone=counts[:, 3],
            base_sha256=pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string()),
            spans=pa.array([listed(base + more) for base, more in found], pa.string()),
            n_added=np.array([len(more) for _, more in found], np.int64),
        )

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    schema = f"_key {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    return map_texts(narrow, work, schema, "_text").withColumnRenamed("_key", key)


def masked_text(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in brackets; of overlapping ones the hull by the first."""
    out, end = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= end:
            out += [text[end:s], f"[{KINDS[k].upper()}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def masked(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:  # noqa: B008
    """All rows with all their columns, the found spans masked; null texts stay null."""
    model = fit(docs, settings, text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = spans_of(filled(batch[text]), model, settings)
        if not any(a or b for a, b in found):
            return batch
        clean = [t if t is None or not (a or b) else masked_text(t, a + b) for t, (a, b) in zip(batch[text].to_pylist(), found)]
        return batch.set_column(batch.schema.get_field_index(text), text, pa.array(clean, pa.string()))

    return map_texts(docs, work, docs.schema, text)
