"""Whole texts to token ids with the tokenizers library, each different piece of text once.

A text is cut where no pre-token of the supported vocabularies can reach across: before ASCII
white space that follows a printable ASCII character, and between an ASCII letter and ASCII
punctuation (not before an apostrophe, which may begin a contraction, nor before the bar and
bracket that special tokens hold). The ids of a text are then the ids of its pieces in a row.

With a vocabulary of lower-case words, pieces of printable ASCII and the letters up to U+00FF need neither
its normalizer nor its pattern: their letters are lower-cased and their words parted here, and the library
merges the words.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gaugeline.llm.texts import SPACE, bytes_of, ranges, shared, table_of

PRINTABLE = np.zeros(256, bool)
PRINTABLE[33:127] = True
LETTER = table_of("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: ASCII punctuation that ends a run of letters.
MARK = PRINTABLE & ~LETTER & ~table_of("0123456789'|>")
#: A worker remembers the pieces of its last texts, this many and at most twice as many with older
#: ones (about 200 bytes each).
REMEMBERED = 200_000

#: What a vocabulary of lower-case words does to a text before it merges characters.
WORDS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
#: Its kinds of characters: words are runs of letters, runs of marks, and single digits.
KIND = np.zeros(256, np.int8)
KIND[PRINTABLE] = 3
KIND[table_of("0123456789")] = 2
KIND[LETTER] = 1
KIND[128:] = 1
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Pieces that are cut into words here: no apostrophe, which may begin a contraction, no bar, which stands in special tokens,
#: and of all else only letters that no normal form changes (not the signs of multiplication and division among them).
SIMPLE = re.compile(rb"(?:[\x09-\x0d\x20-\x26\x28-\x7b\x7d\x7e]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*").fullmatch
#: So many words go to the library as one text.
TOGETHER = 4096


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pieces of all texts in a row, and the number of the first piece of each text."""
    data, offsets = bytes_of(texts)
    cut = np.zeros(len(data) + 1, bool)
    if len(data):
        cut[1:-1] = (SPACE[data[1:]] & PRINTABLE[data[:-1]]) | (MARK[data[1:]] & LETTER[data[:-1]])
    cut[offsets] = True
    at = np.flatnonzero(cut).astype(np.int32)
    cuts = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])
    return cuts, np.searchsorted(at, offsets)


class Encoder:
    """Ids of whole texts; what was encoded before in the same Python worker is looked up."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merger, self.ends = merger_of(path)
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins (one entry more at the end)."""
        parts, first = pieces(texts)
        if not len(parts):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        coded = pc.dictionary_encode(parts)
        known = self._ids(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(lengths) - lengths
        codes = coded.indices.to_numpy()
        sizes = lengths[codes]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return np.frombuffer(b"".join(known), np.int32)[ranges(starts[codes], sizes)], total[first]

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each piece as bytes of 32-bit integers."""
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        fresh = []
        for word in words:
            if word not in recent:
                if word in older:
                    recent[word] = older[word]
                else:
                    fresh.append(word)
        if self.merger is not None:
            simple = [word for word in fresh if SIMPLE(word)]
            recent.update(zip(simple, self._merged(simple)))
            fresh = [word for word in fresh if word not in recent]
        coded = self.tokenizer.encode_batch_fast([x.decode() for x in fresh], add_special_tokens=False)
        for word, part in zip(fresh, coded):
            recent[word] = array("i", part.ids).tobytes()
        return [recent[word] for word in words]

    def _merged(self, simple: list[bytes]) -> list[bytes]:
        """The ids of pieces of simple bytes: each word of theirs ends with the first id that ends one."""
        data = np.frombuffer(b"".join(simple), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, simple), np.int64, len(simple)))
        kind = KIND[data]
        begins = kind > 0
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        own = ends[:-1]
        begins[own] = kind[own] > 0
        before = np.cumsum(begins)
        text = np.full(len(data) + int(before[-1] if len(before) else 0), 32, np.uint8)
        lower = LOWER[data]
        upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] < 0x9F)) + 1  # the second byte of a capital letter
        lower[upper] += 0x20
        text[np.arange(len(data)) + before] = lower
        cuts = [*(np.flatnonzero(begins)[::TOGETHER] + before[begins][::TOGETHER] - 1).tolist(), len(text)]
        raw = text.tobytes()
        coded = self.merger.encode_batch_fast([raw[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:])], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.int32), *[np.array(x.ids, np.int32) for x in coded]])
        stops = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(stops) != len(text) - len(data) + 1 or stops[-1] != len(ids):
            raise ValueError("the vocabulary does not end every word")
        at = np.concatenate([[0], stops[before[ends - 1]]]).tolist() if len(ends) else [0]
        whole = ids.tobytes()
        return [whole[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:])]


def merger_of(path: str):
    """The tokenizer of a vocabulary of lower-case words without what it does before merging, and which of
    its ids end a word. Nothing for other vocabularies."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        setting = json.load(file)
    model, special = setting["model"], [t["content"] for t in setting["added_tokens"]]
    plain = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>"}
    if any(setting.get(k) != v for k, v in WORDS.items()) or any(model.get(k) != v for k, v in plain.items()):
        return None, None
    if model.get("ignore_merges") or any("|" not in t for t in special):
        return None, None
    if any(x not in model["vocab"] or x + "</w>" not in model["vocab"] for x in pre_tokenizers.ByteLevel.alphabet()):
        return None, None
    merger = Tokenizer.from_file(path)
    merger.no_truncation()
    merger.no_padding()
    merger.normalizer = normalizers.Sequence([])
    merger.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    ends = np.zeros(max([*model["vocab"].values(), *[t["id"] for t in setting["added_tokens"]]]) + 1, bool)
    ends[[n for x, n in model["vocab"].items() if x.endswith("</w>")]] = True
    return merger, ends


def encoder_of(path: str) -> Encoder:
    """One encoder for each file and Python worker, until the worker goes on to other work on texts."""
    if path not in shared:
        shared[path] = Encoder(path)
    return shared[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each text."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, np.int32)
    own = np.ones(len(out), bool)
    offsets = offsets + np.arange(n + 1)
    own[offsets[1:] - 1] = False
    out[own] = ids
    return out, offsets
