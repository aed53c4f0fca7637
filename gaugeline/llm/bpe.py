"""Byte-pair encoding by speculation: propose tokens greedily, verify every adjacent pair, merge
exactly only where a pair fails.

A split into tokens is the merge result of a word exactly if each token is the merge result of its
own characters and each two neighbours are compatible, that is, no merge across their border would
have come before the merges that built them. So all different words of a slice first get the longest
known token at each place, all different pairs are checked together by walking down the tokens'
merge trees, and only words with an incompatible pair run through the merges one by one.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from gaugeline.llm.texts import batch_of, bytes_of, filled, map_texts, ranges
from gaugeline.llm.token_counts import byte_symbols

NEVER = np.iinfo(np.int64).max
#: Added to the last byte of a word: bytes that end a word are symbols of their own.
LAST = 256


class Bpe:
    """The merges of a vocabulary file of the word-end kind: lower case, white space dropped."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocabulary: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.names = dict((i, t) for t, i in vocabulary.items())
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.names.update((i, t) for t, i in self.special.items())
        self.table = [self.names.get(i, "").encode() for i in range(max(self.names) + 1)]
        self._pattern_of(spec)

        self.symbols = symbols = byte_symbols()
        self.base = np.full(2 * LAST, -1, np.int64)  # symbol (byte, or last byte) to token id
        for char, byte in symbols.items():
            self.base[byte] = vocabulary[char]
            self.base[byte + LAST] = vocabulary[char + suffix]
        size = len(self.table)
        self.made = np.full(size, -1, np.int64)  # the merge that makes a token; -1: a symbol
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        spelled: dict[int, tuple[int, ...]] = {int(self.base[s]): (s,) for s in range(2 * LAST)}
        keys, ranks, results = [], [], []
        self.ordered = True  # no merge comes before those that make its parts
        for rank, (a, b) in enumerate(merges):
            x, y, z = vocabulary[a], vocabulary[b], vocabulary[a + b]
            keys.append(x << 32 | y)
            ranks.append(rank)
            results.append(z)
            if self.made[z] < 0 and z not in spelled:
                self.made[z], self.left[z], self.right[z] = rank, x, y
                spelled[z] = spelled[x] + spelled[y]
            self.ordered &= bool(self.made[x] < rank and self.made[y] < rank)
        order = np.argsort(keys)
        self.keys = np.append(np.array(keys, np.int64)[order], NEVER)
        self.ranks = np.append(np.array(ranks, np.int64)[order], NEVER)
        self.results = np.append(np.array(results, np.int64)[order], -1)
        self._tries(spelled)

    def _pattern_of(self, spec: dict) -> None:
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.pattern = regex.compile(pattern + "|\n")
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        # Characters that Unicode versions class differently: their words take the library's own
        # normaliser and splitter.
        every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
        here = set(regex.findall(r"[\p{L}\p{N}]", every))
        there = {c for c in every if unicodedata.category(c)[0] in "LN"}
        self.unsettled = frozenset(here ^ there)

    def _tries(self, spelled: dict[int, tuple[int, ...]]) -> None:
        """A trie of every token that is the merge result of its own symbols."""
        tokens = sorted(spelled)
        flat = np.array([s for t in tokens for s in spelled[t]], np.int64)
        lengths = np.array([len(spelled[t]) for t in tokens])
        ids, offsets = self.merged(self.base[flat], np.concatenate([[0], np.cumsum(lengths)]))
        single = np.diff(offsets) == 1
        edges: dict[int, int] = {}
        accepts = [-1]
        for t, ok, first in zip(tokens, single, offsets):
            if not ok or ids[first] != t:
                continue
            node = 0
            for s in spelled[t]:
                key = node * 2 * LAST + s
                if key not in edges:
                    edges[key] = len(accepts)
                    accepts.append(-1)
                node = edges[key]
            accepts[node] = t
        order = sorted(edges)
        self.edge_keys = np.array([*order, NEVER], np.int64)
        self.edge_ends = np.array([*(edges[k] for k in order), 0], np.int64)
        self.accepts = np.array(accepts, np.int64)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each pair (NEVER if there is none) and its result."""
        keys = a << 32 | b
        at = np.searchsorted(self.keys, keys)
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], NEVER), np.where(hit, self.results[at], -1)

    def proposed(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each place, from left to right; all words step together."""
        at, ends = offsets[:-1].copy(), offsets[1:]
        token_at = np.full(len(symbols), -1, np.int64)
        live = np.flatnonzero(at < ends)
        while len(live):
            node, reach = np.zeros(len(live), np.int64), at[live]
            stop, token = reach.copy(), np.full(len(live), -1, np.int64)
            walk = np.arange(len(live))
            while len(walk):
                keys = node[walk] * 2 * LAST + symbols[reach[walk]]
                found = np.searchsorted(self.edge_keys, keys)
                walk, found = walk[hit := self.edge_keys[found] == keys], found[hit]
                node[walk] = self.edge_ends[found]
                reach[walk] += 1
                accepted = self.accepts[node[walk]]
                good = walk[accepted >= 0]
                token[good], stop[good] = accepted[accepted >= 0], reach[good]
                walk = walk[reach[walk] < ends[live[walk]]]
            token_at[at[live]] = token
            at[live] = stop
            live = live[at[live] < ends[live]]
        chosen = token_at >= 0
        counts = np.concatenate([[0], np.cumsum(chosen)])
        return token_at[chosen], counts[offsets]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge across the border of each pair comes before the merges that end at it."""
        good = np.ones(len(a), bool)
        todo = np.arange(len(a))
        x, y = a.copy(), b.copy()
        until_x, until_y = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(todo):
            rank = self.rank_of(x, y)[0]
            clash = (rank < until_x) & (rank <= until_y) & (rank < NEVER)
            good[todo[clash]] = False
            made_x, made_y = self.made[x], self.made[y]
            stay = ~clash & ((made_x >= 0) | (made_y >= 0))
            todo, x, y = todo[stay], x[stay], y[stay]
            until_x, until_y, made_x, made_y = until_x[stay], until_y[stay], made_x[stay], made_y[stay]
            undo_x = made_x > made_y  # the later merge is undone first; of equal ones the left came first
            until_x, until_y = np.where(undo_x, made_x, until_x), np.where(undo_x, until_y, made_y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def merged(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging: in every word at once, the first pair of lowest rank, until none is left."""
        n = len(offsets) - 1
        word = np.repeat(np.arange(n), np.diff(offsets))
        done_ids, done_words = [], []

        def ranked(a, b, same):
            rank, result = self.rank_of(a, b)
            return np.where(same, rank, NEVER), result

        ids = ids.copy()
        rank, result = ranked(ids, np.append(ids[1:], 0), np.append(word[1:] == word[:-1], False)[: len(ids)])
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(ids)))
            best = np.minimum.reduceat(rank, starts)
            open_ = best < NEVER
            if not open_.all():
                stay = np.repeat(open_, sizes)
                done_ids.append(ids[~stay])
                done_words.append(word[~stay])
                ids, word, rank, result = ids[stay], word[stay], rank[stay], result[stay]
                if not len(ids):
                    break
                starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                sizes, best = sizes[open_], best[open_]
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            hits = hits[np.concatenate([[True], word[hits[1:]] != word[hits[:-1]]])]
            ids[hits] = result[hits]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            moved = np.cumsum(keep) - 1
            ids, word, rank, result = ids[keep], word[keep], rank[keep], result[keep]
            at = moved[hits]
            for i in (at, at[at > 0] - 1):
                after = np.minimum(i + 1, len(ids) - 1)
                rank[i], result[i] = ranked(ids[i], ids[after], (after > i) & (word[i] == word[after]))
        if not done_ids:
            return ids, np.zeros(n + 1, np.int64)
        all_ids, all_words = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(all_words, kind="stable")
        return all_ids[order], np.concatenate([[0], np.cumsum(np.bincount(all_words, minlength=n))])

    def words(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every word: speculate, verify, merge what fails."""
        ids, at = self.proposed(symbols, offsets)
        if self.ordered:
            border = np.ones(len(ids), bool)
            border[at[:-1][np.diff(at) > 0]] = False
            second = np.flatnonzero(border)
            keys = ids[second - 1] << 32 | ids[second]
            coded = pc.dictionary_encode(pa.array(keys))
            pairs = coded.dictionary.to_numpy()
            good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[coded.indices.to_numpy()] if len(pairs) else np.zeros(0, bool)
            owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
            failed = np.zeros(len(at) - 1, bool)
            failed[owner[second[~good]]] = True
        else:  # the pair check needs merges in order of dependence
            failed = np.diff(at) > 1
        wrong = np.flatnonzero(failed)
        if not len(wrong):
            return ids, at
        sizes = np.diff(offsets)[wrong]
        exact, exact_at = self.merged(self.base[symbols[ranges(offsets[wrong], sizes)]], np.concatenate([[0], np.cumsum(sizes)]))
        lengths = np.diff(at)
        lengths[wrong] = np.diff(exact_at)
        both, starts = np.concatenate([ids, exact]), at[:-1].copy()
        starts[wrong] = exact_at[:-1] + len(ids)
        return both[ranges(starts, lengths)], np.concatenate([[0], np.cumsum(lengths)])

    def split(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """Pre-tokens of all words in a row, and the number of each word's first."""
        parts = self.pattern.findall(self._normal("\n".join(words)))
        breaks = np.fromiter((p == "\n" for p in parts), bool, len(parts))
        firsts = np.concatenate([[0], np.cumsum(~breaks)])
        at = np.concatenate([[0], firsts[np.flatnonzero(breaks) + 1], [firsts[-1]]])
        return [p for p in parts if p != "\n"], at

    def _split_odd(self, words: list[str]) -> tuple[list[str], np.ndarray, dict[int, int]]:
        """The same for single words that may hold special tokens or characters in dispute, and the
        places that hold a special token's id instead."""
        parts, at, special = [], [0], {}
        for word in words:
            end = 0
            for match in self.special_pattern.finditer(word):
                parts.extend(self._library_parts(word[end : match.start()]))
                special[len(parts)] = self.special[match[0]]
                parts.append(match[0])
                end = match.end()
            parts.extend(self._library_parts(word[end:]))
            at.append(len(parts))
        return parts, np.array(at), special

    def _library_parts(self, text: str) -> list[str]:
        if not text:
            return []
        split = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(self.symbols[c] for c in part).decode() for part, _ in split]

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # Lower-casing works character by character there: no final sigma.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text begins (one entry more at the end)."""
        lists = pc.ascii_split_whitespace(texts)
        text_at = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.slice(text_at[0], text_at[-1] - text_at[0])
        text_at = text_at - text_at[0]
        if not len(words):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        coded = pc.dictionary_encode(words)
        different = coded.dictionary.to_pylist()
        is_odd = np.fromiter(("<|" in w or not (w.isascii() or self.unsettled.isdisjoint(w)) for w in different), bool, len(different))
        order = np.argsort(is_odd, kind="stable")
        n_plain = len(different) - int(is_odd.sum())
        listed = [different[i] for i in order]
        parts, part_at = self.split(listed[:n_plain]) if n_plain else ([], np.zeros(1, np.int64))
        more, more_at, special = self._split_odd(listed[n_plain:])
        special = {k + len(parts): v for k, v in special.items()}
        part_at = np.concatenate([part_at, more_at[1:] + len(parts)])
        parts = parts + more
        ids, at = self._parts(parts, special)
        word_at = at[part_at]
        place = np.empty(len(listed), np.int64)
        place[order] = np.arange(len(listed))
        own = place[coded.indices.to_numpy()]
        lengths = np.diff(word_at)[own]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids[ranges(word_at[:-1][own], lengths)], total[text_at]

    def _parts(self, parts: list[str], special: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each pre-token."""
        if not parts:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        coded = pc.dictionary_encode(pa.array(parts, pa.string()))
        data, offsets = bytes_of(coded.dictionary)
        symbols = data.astype(np.int64)
        symbols[offsets[1:] - 1] += LAST
        ids, at = self.words(symbols, offsets)
        own = coded.indices.to_numpy().astype(np.int64)
        starts, lengths = at[:-1][own], np.diff(at)[own]
        if special:
            places, values = np.array(list(special)), np.array(list(special.values()))
            starts[places], lengths[places] = len(ids) + np.arange(len(places)), 1
            ids = np.concatenate([ids, values])
        return ids[ranges(starts, lengths)], np.concatenate([[0], np.cumsum(lengths)])

    def decode(self, ids: list[int]) -> bytes:
        """The tokens as they stand in the vocabulary, joined by spaces; the file names no decoder."""
        return b" ".join(_picked(self.table, ids))


def _picked(table: list[bytes], ids: list[int]) -> tuple[bytes, ...]:
    if len(ids) < 2:
        return tuple(table[i] for i in ids)
    return itemgetter(*ids)(table)


_coders: dict[str, Bpe] = {}
_decimals: list[bytes] = []


def coder_of(path: str) -> Bpe:
    """One coder for each file and Python worker."""
    if path not in _coders:
        _coders[path] = Bpe(path)
    return _coders[path]


def encoded(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` (an array) of every row; null texts count as empty and give no ids."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, at = coder_of(vocabulary).encode(filled(batch["_text"]))
        return batch_of(_key=batch["_key"], ids=pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32))))

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    return map_texts(narrow, work, f"_key {kind}, ids array<int>", "_text").withColumnRenamed("_key", key)


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, and hashes of the ids (decimal, joined by a space) and of the decoded
    text. A null text counts as empty, null keys stay null, repeated rows stay repeated, and columns
    other than the two are not read."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = coder_of(vocabulary)
        if len(_decimals) < len(coder.table):
            _decimals[:] = [str(i).encode() for i in range(len(coder.table))]
        ids, at = coder.encode(filled(batch["_text"]))
        listed, at_list = ids.tolist(), at.tolist()
        hashes, decoded = [], []
        for a, b in zip(at_list, at_list[1:]):
            own = listed[a:b]
            hashes.append(hashlib.sha256(b" ".join(_picked(_decimals, own))).hexdigest())
            decoded.append(hashlib.sha256(coder.decode(own)).hexdigest())
        return batch_of(_key=batch["_key"], n_tokens=np.diff(at), ids_sha256=pa.array(hashes, pa.string()), decoded_sha256=pa.array(decoded, pa.string()))

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    schema = f"_key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_texts(narrow, work, schema, "_text").withColumnRenamed("_key", key)
