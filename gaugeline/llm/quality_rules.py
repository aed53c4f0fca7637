"""Line-first cleaning: judge every line, take the failing ones out, and reject a document that
loses too much of its text.

Lines are judged by their punctuation, by how they look like navigation (a menu in one line, or one
entry in each of several lines), and by stock phrases; equal lines are judged once. The document's own counts (words, symbols, repeated lines
and word windows) are computed beside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gaugeline.llm.texts import SMALL_SLICE, SPACE, batch_of, bytes_of, filled, map_texts, sums, table_of

SYMBOLS = table_of("#*$%&|<>")
CONTINUED = np.arange(256) & 0xC0 == 0x80
UPPER = table_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LOWER = table_of("abcdefghijklmnopqrstuvwxyz")
SHOUT = table_of("!")

#: Lower-case phrases that mark a line as boilerplate.
BOILERPLATE = (
    "licensed under", "all rights reserved", "terms of service", "terms of use", "privacy policy", "use cookies",
    "enable javascript", "sign up for", "click here", "subscribe to our",
)
SENTENCE_END = "[.!?:;…。！？]"
#: Words that part the entries of a menu.
SEPARATORS = ("/", "|", ">", "·", "•", "»", "›")


@dataclass(frozen=True)
class Rules:
    """Bounds of the rules; shares are of a line's words if not said otherwise."""

    min_words: int = 50  # fewer: rejected
    max_repeat: float = 0.5  # share of words in repeated 3-word windows
    max_symbols: float = 0.3  # symbol characters a word: punctuation noise, or the bars of a menu
    max_shouts: float = 0.3  # exclamation marks a word
    max_upper: float = 0.6  # capitals among ASCII letters, in lines of at least 3 words
    unended_words: int = 40  # a line of so many words without a sentence mark is a word list
    menu_words: tuple[int, int] = (3, 12)  # a line of so many words that all begin with a capital is a menu
    menu_entry: int = 3  # words of a menu's entry at most, beside two separators or more, or in a line of its own
    menu_lines: int = 4  # lines of one entry each, in a row, that make a menu
    max_lost: float = 0.5  # share of the document's words in failing lines


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    lists = pc.split_pattern(texts, "\n")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def _word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    inside = ~SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    starts[begins] = inside[begins]
    return starts


def _separators(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """At each byte, whether a separator that is a word of its own begins there."""
    out = np.zeros(len(data), bool)
    room = np.concatenate([data, np.full(4, 32, np.uint8)])
    last = np.zeros(len(room), bool)  # bytes that end a word
    last[: len(data)] = ~SPACE[data] & SPACE[room[1 : len(data) + 1]]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    last[ends] = ~SPACE[data[ends]]
    at = np.flatnonzero(starts)
    for word in SEPARATORS:
        parts = word.encode()
        same = last[at + len(parts) - 1]
        for i, byte in enumerate(parts):
            same &= room[at + i] == byte
        out[at[same]] = True
    return out


def failing_lines(lines: pa.Array, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each line, whether it fails a rule, and whether it may be an entry of a menu."""
    data, offsets = bytes_of(lines)
    count = lambda table: sums(table[data], offsets)
    starts = _word_starts(data, offsets)
    words = sums(starts, offsets)
    symbols, shouts, upper, lower = count(SYMBOLS), count(SHOUT), count(UPPER), count(LOWER)
    noisy = (symbols >= 2) & (symbols > rules.max_symbols * words)
    shouting = (shouts >= 2) & (shouts > rules.max_shouts * words)
    capitals = (words >= 3) & (upper > rules.max_upper * (upper + lower))
    ended = pc.match_substring_regex(lines, SENTENCE_END).to_numpy(zero_copy_only=False)
    unended = (words >= rules.unended_words) & ~ended
    titles, parts = sums(starts & UPPER[data], offsets), sums(_separators(data, offsets, starts), offsets)
    low, high = rules.menu_words
    menu = (titles == words) & (words >= low) & (words <= high)
    menu |= (parts >= 2) & (words - parts <= rules.menu_entry * (parts + 1))
    first = np.zeros(len(words), bool)
    some = np.flatnonzero(words)
    first[some] = UPPER[data[np.flatnonzero(starts)[np.cumsum(words)[some] - words[some]]]]
    entry = first & (words <= rules.menu_entry) & ~ended
    stock = np.zeros(len(words), bool)
    small = pc.ascii_lower(lines)
    for phrase in BOILERPLATE:
        stock |= pc.match_substring(small, phrase).to_numpy(zero_copy_only=False)
    return words, (words > 0) & (noisy | shouting | capitals | unended | (menu & ~ended) | stock), entry


def in_menus(rows: np.ndarray, entry: np.ndarray, filled_line: np.ndarray, rules: Rules) -> np.ndarray:
    """Which lines lie in a run of ``menu_lines`` entries or more of their text, empty lines passed over."""
    out = np.zeros(len(rows), bool)
    at = np.flatnonzero(filled_line)
    if len(at):
        new = np.concatenate([[True], (rows[at][1:] != rows[at][:-1]) | (entry[at][1:] != entry[at][:-1])])
        run = np.cumsum(new) - 1
        out[at] = entry[at] & (np.bincount(run)[run] >= rules.menu_lines)
    return out


def _codes(keys: np.ndarray) -> np.ndarray:
    """Equal keys get equal small numbers, by hashing."""
    return pc.dictionary_encode(pa.array(keys)).indices.to_numpy().astype(np.int64)


def _again(groups: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which (group, key) occur before at a smaller index, and which occur twice or more."""
    codes = _codes(keys)
    left = np.flatnonzero(np.bincount(codes)[codes] > 1)  # others occur once in the whole slice
    order = left[np.lexsort((left, groups[left], codes[left]))]
    same = (codes[order[1:]] == codes[order[:-1]]) & (groups[order[1:]] == groups[order[:-1]])
    before, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order[1:][same]] = True
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return before, twice


def _repeated_words(texts: pa.Array) -> np.ndarray:
    """Words covered by 3-word windows that the same text holds twice or more."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    rows, codes = rows[real], pc.dictionary_encode(words).indices.to_numpy()[real].astype(np.int64)
    if len(codes) < 3:
        return np.zeros(len(texts), np.int64)
    pairs = _codes(codes[:-1] << 32 | codes[1:])
    windows = pairs[:-1] << 32 | codes[2:]
    whole = rows[2:] == rows[:-2]
    twice = np.zeros(len(whole), bool)
    twice[whole] = _again(rows[2:][whole], windows[whole])[1]
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return np.bincount(rows[covered], minlength=len(texts)).astype(np.int64)


def judge(texts: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    """The counts and verdict of each text."""
    data, offsets = bytes_of(texts)
    n_words = sums(_word_starts(data, offsets), offsets)
    lines, line_offsets = _lines(texts)
    coded = pc.dictionary_encode(lines)
    words, fails, entry = failing_lines(coded.dictionary, rules)
    codes = coded.indices.to_numpy()
    rows = np.repeat(np.arange(len(texts)), np.diff(line_offsets))
    repeated, filled_line = np.zeros(len(codes), bool), words[codes] > 0
    repeated[filled_line] = _again(rows[filled_line], codes[filled_line].astype(np.int64))[0]
    lost = fails[codes] | repeated | in_menus(rows, entry[codes], filled_line, rules)
    n_lost = sums(np.where(lost, words[codes], 0), line_offsets)
    n_repeat_words = _repeated_words(texts)
    base_failed = (n_words < rules.min_words) | (n_repeat_words > rules.max_repeat * n_words)
    return {
        "n_words": n_words,
        "word_chars": sums(~SPACE[data] & ~CONTINUED[data], offsets),
        "n_symbols": sums(SYMBOLS[data], offsets),
        "n_dup_lines": sums(repeated, line_offsets),
        "n_repeat_words": n_repeat_words,
        "base_failed": base_failed,
        "kept": ~base_failed & (n_lost <= rules.max_lost * n_words),
        "n_lost_words": n_lost,
    }


COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, n_lost_words bigint"


def quality_rules(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``key``, the counts, ``base_failed``, ``kept`` and ``n_lost_words`` of every row.

    A null text counts as empty: 0 words, so it fails. A null key stays null, repeated rows are
    judged alike and stay repeated, and columns other than the two are not read.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch_of(_key=batch["_key"], **judge(filled(batch["_text"]), rules))

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    kind = docs.schema[key].dataType.simpleString()
    return map_texts(narrow, work, f"_key {kind}, {COUNTS}", "_text").withColumnRenamed("_key", key)


def cleaned(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:  # noqa: B008
    """The kept rows with all their columns, failing and repeated lines taken out of the text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = filled(batch[text])
        part = batch.filter(pa.array(judge(texts, rules)["kept"]))
        lines, offsets = _lines(filled(part[text]))
        rows = np.repeat(np.arange(part.num_rows), np.diff(offsets))
        words, fails, entry = failing_lines(lines, rules)
        filled_line, repeated = words > 0, np.zeros(len(lines), bool)
        codes = pc.dictionary_encode(lines).indices.to_numpy().astype(np.int64)
        repeated[filled_line] = _again(rows[filled_line], codes[filled_line])[0]
        stays = ~(fails | repeated | in_menus(rows, entry, filled_line, rules))
        left = lines.filter(pa.array(stays))
        ends = np.concatenate([[0], np.cumsum(np.bincount(rows[stays], minlength=part.num_rows))]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), left), "\n")
        return part.set_column(part.schema.get_field_index(text), text, joined)

    return map_texts(docs, work, docs.schema, text, SMALL_SLICE)


def kept_documents(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:  # noqa: B008
    """The rows that pass, unchanged, with all their columns."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(judge(filled(batch[text]), rules)["kept"]))

    return map_texts(docs, work, docs.schema, text)


# -- the same rules as SQL ----------------------------------------------------------------------


def rules_sql(rules: Rules = Rules()) -> str:  # noqa: B008
    """The query as DuckDB SQL over ``documents``."""
    stock = " or ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    space = r"[^\x20\x09-\x0D]+"
    parts = ", ".join(f"'{x}'" for x in SEPARATORS)
    low, high = rules.menu_words
    return rf"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
w as (select r, regexp_extract_all(text, '{space}') as w from t),
win as (select r, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] as s
  from (select r, w, unnest(range(1, greatest(len(w) - 1, 1))) as i from w)),
twice as (select r, i from (select r, i, count(*) over (partition by r, s) as n from win) where n > 1),
rep as (select r, count(distinct p) as n from (select r, unnest([i, i+1, i+2]) as p from twice) group by r),
l as (select r, i, string_split(text, chr(10))[i] as line
  from (select r, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from t)),
f as (select r, i, line, row_number() over (partition by r, line order by i) > 1 as again,
    len(regexp_extract_all(line, '(?:^|[\x20\x09-\x0D])[A-Z]')) as titles,
    len(list_filter(regexp_extract_all(line, '{space}'), lambda x: x in ({parts}))) as parts,
    regexp_matches(line, '^[\x20\x09-\x0D]*[A-Z]') as first_upper,
    len(regexp_extract_all(line, '{space}')) as words, len(regexp_extract_all(line, '[#*$%&|<>]')) as symbols,
    len(regexp_extract_all(line, '!')) as shouts, len(regexp_extract_all(line, '[A-Z]')) as upper,
    len(regexp_extract_all(line, '[a-z]')) as lower_n, regexp_matches(line, '{SENTENCE_END}') as ended from l),
e as (select *, first_upper and words <= {rules.menu_entry} and not ended as entry from f where words > 0),
g as (select *, row_number() over (partition by r order by i) - row_number() over (partition by r, entry order by i) as island from e),
m as (select *, entry and count(*) over (partition by r, entry, island) >= {rules.menu_lines} as in_menu from g),
j as (select r, words, again, in_menu or (symbols >= 2 and symbols > {rules.max_symbols} * words)
    or (shouts >= 2 and shouts > {rules.max_shouts} * words)
    or (words >= 3 and upper > {rules.max_upper} * (upper + lower_n))
    or (words >= {rules.unended_words} and not ended) or (titles = words and words between {low} and {high} and not ended)
    or (parts >= 2 and words - parts <= {rules.menu_entry} * (parts + 1) and not ended) or ({stock}) as fails from m),
d as (select r, sum(case when again then 1 else 0 end) as dup, sum(case when fails or again then words else 0 end) as lost from j group by r),
c as (select t.r, doc_id, len(w) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(dup, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, coalesce(lost, 0) as n_lost_words
  from t join w on t.r = w.r left join d on t.r = d.r left join rep on t.r = rep.r),
b as (select *, n_words < {rules.min_words} or n_repeat_words > {rules.max_repeat} * n_words as base_failed from c)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and n_lost_words <= {rules.max_lost} * n_words as kept, n_lost_words::bigint as n_lost_words
from b"""

