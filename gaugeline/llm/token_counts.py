"""Token counts by a longest-match automaton, in time linear in the text.

The vocabulary's word-initial and continuing pieces are two tries over bytes. Every node has a
failure link and the number of pieces that are complete once the link is followed, so the greedy
word-piece split of a word is counted byte by byte without building a piece and without going
back. All different words of a slice run through the automaton together.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from gaugeline.llm.texts import batch_of, bytes_of, filled, map_texts, sums

#: Words of more bytes are walked on their own, the others side by side.
SIDE_BY_SIDE = 256


class PieceCounter:
    """Greedy longest-match piece counts. ``first`` are pieces that begin a word, ``rest`` those
    that continue one. A word that no sequence of pieces spells counts as one unknown token."""

    def __init__(self, first: Iterable[bytes], rest: Iterable[bytes]):
        edges: list[dict[int, int]] = [{}, {}]  # nodes 0 and 1: the roots
        is_piece = [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                node = root
                for byte in piece:
                    after = edges[node].get(byte)
                    if after is None:
                        after = edges[node][byte] = len(edges)
                        edges.append({})
                        is_piece.append(False)
                    node = after
                is_piece[node] |= node > 1
        link, popped = [-1] * len(edges), [0] * len(edges)
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for byte, after in edges[node].items():
                if is_piece[after]:
                    link[after], popped[after] = 1, 1
                else:
                    at, count = link[node], popped[node]
                    while at >= 0 and byte not in edges[at]:
                        count += popped[at]
                        at = link[at]
                    if at >= 0:
                        link[after], popped[after] = edges[at][byte], count
                queue.append(after)
        self.edges = edges
        self.link, self.popped = np.array(link), np.array(popped)
        keys = np.array([node * 256 + byte for node, out in enumerate(edges) for byte in out], np.int64)
        ends = np.array([after for out in edges for after in out.values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.ends = np.append(keys[order], np.iinfo(np.int64).max), np.append(ends[order], -1)

    def step(self, states: np.ndarray, counts: np.ndarray, symbols: np.ndarray) -> None:
        """Read one byte in every state; -1 is the dead state of unknown words."""
        todo = np.flatnonzero(states >= 0)
        while len(todo):
            keys = states[todo] * 256 + symbols[todo]
            found = np.searchsorted(self.keys, keys)
            hit = self.keys[found] == keys
            states[todo[hit]] = self.ends[found[hit]]
            todo = todo[~hit]
            self.follow(states, counts, todo)
            todo = todo[states[todo] >= 0]

    def follow(self, states: np.ndarray, counts: np.ndarray, at: np.ndarray) -> None:
        counts[at] += self.popped[states[at]]
        states[at] = self.link[states[at]]

    def close(self, states: np.ndarray, counts: np.ndarray) -> None:
        """The end of the words: take what is still open."""
        todo = np.flatnonzero(states > 1)
        while len(todo):
            self.follow(states, counts, todo)
            todo = todo[states[todo] > 1]
        counts[states < 0] = 1

    def one(self, word: bytes) -> int:
        node, count = 0, 0
        for byte in word:
            while byte not in self.edges[node]:
                if self.link[node] < 0:
                    return 1
                count += self.popped[node]
                node = self.link[node]
            node = self.edges[node][byte]
        while node > 1:
            count += self.popped[node]
            node = self.link[node]
        return 1 if node < 0 else int(count)

    def counts(self, words: pa.Array) -> np.ndarray:
        """Pieces of each word."""
        data, offsets = bytes_of(words)
        lengths = np.diff(offsets)
        out = np.zeros(len(lengths), np.int64)
        for i in np.flatnonzero(lengths > SIDE_BY_SIDE):
            out[i] = self.one(data[offsets[i] : offsets[i + 1]].tobytes())
        side = np.flatnonzero(lengths <= SIDE_BY_SIDE)
        order = side[np.argsort(-lengths[side], kind="stable")]
        starts, sizes = offsets[order], lengths[order]
        states, counts = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for i in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -i, "left"))
            self.step(states[:live], counts[:live], data[starts[:live] + i].astype(np.int64))
        self.close(states, counts)
        out[order] = counts
        return out


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def pieces_of(path: str) -> tuple[set[bytes], set[bytes]]:
    """The word-initial and continuing pieces of a byte-level vocabulary file, in which a leading
    space marks the first kind. Single bytes are added to both, so that every word is spelled."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    symbols = byte_symbols()
    single = {bytes([b]) for b in range(256)}
    first, rest = set(single), set(single)
    for piece in vocabulary:
        if all(c in symbols for c in piece):
            spelled = bytes(symbols[c] for c in piece)
            if spelled[:1] == b" ":
                first.add(spelled[1:])
            else:
                rest.add(spelled)
    return first - {b""}, rest - {b""}


_counters: dict[str, PieceCounter] = {}


def counter_of(path: str) -> PieceCounter:
    """One automaton for each vocabulary and Python worker."""
    if path not in _counters:
        _counters[path] = PieceCounter(*pieces_of(path))
    return _counters[path]


def count_texts(texts: pa.Array, counter: PieceCounter) -> tuple[np.ndarray, np.ndarray]:
    """Words and pieces of each text; words are runs without ASCII white space."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py())
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = pc.dictionary_encode(words)
    pieces = counter.counts(coded.dictionary)
    each = pieces[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
    is_word = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)  # white space at an end gives ""
    return sums(is_word, offsets), sums(each, offsets)


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_words`` and ``n_tokens`` of every row.

    ``vocabulary`` is the path of a byte-level vocabulary file on every executor. A null text
    counts as empty (0 words, 0 tokens), a null key stays null, repeated rows stay repeated, and
    columns other than ``key`` and ``text`` are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_tokens = count_texts(filled(batch["_text"]), counter_of(vocabulary))
        return batch_of(_key=batch["_key"], n_words=n_words, n_tokens=n_tokens)

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    counted = map_texts(narrow, work, f"_key {kind}, n_words bigint, n_tokens bigint", "_text")
    return counted.withColumnRenamed("_key", key)
