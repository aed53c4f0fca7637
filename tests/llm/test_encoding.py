"""Ids of whole texts against the tokenizers library, and which pieces go through all of its steps."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gaugeline.llm.encoding import SIMPLE, Encoder
from gaugeline.llm.queries import BYTE_BPE, WORD_BPE

SIGNS = [*map(chr, range(128)), *"éßÀÞ×÷ÿÖçÉºµİǅ中𝔸́<> \n\t  abAB12", "<|endoftext|>", "</w>", "'s", "'LL", "don't", " The"]


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_ids_are_those_of_the_library(path):
    pick = random.Random(5)
    texts = ["".join(pick.choice(SIGNS) for _ in range(pick.randint(0, 50))) for _ in range(3000)]
    texts += ["", " ", "\n\n", "12 34", "</w>", "É", "x" * 5000, " ".join(["Wörter", "mots"] * 5000)]
    ids, offsets = Encoder(path).encode(pa.array(texts))
    plain = Tokenizer.from_file(path)
    plain.no_truncation()
    plain.no_padding()
    for row, coded in enumerate(plain.encode_batch(texts, add_special_tokens=False)):
        assert ids[offsets[row] : offsets[row + 1]].tolist() == coded.ids


def test_words_are_merged_without_patterns():
    encoder = Encoder(WORD_BPE)
    slow, whole = [], encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **how):
            slow.extend(texts)
            return whole.encode_batch_fast(texts, **how)

    encoder.tokenizer = Counted()
    encoder.encode(pa.array(["Un élève, l'école et 12 mots. Größe × 中"]))
    assert slow == [" l'école", " × 中"]
    assert not SIMPLE("e\u0301".encode()) and not SIMPLE(b"<|endoftext|>") and SIMPLE("Gr\u00f6\u00dfe, 3".encode())
    assert Encoder(BYTE_BPE).merger is None
