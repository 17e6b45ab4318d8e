import random

import public_tokenizers
import pyarrow as pa
import pytest

from skyledger.llm import tokens
from skyledger.llm.tokens import Encoder

ALPHABET = "abcXYZ  \n\t'’.,!_-é́ñ²½Ⅷ٣漢字  \x1c ſİß<|>s't 0123\r"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_tokenizer(name):
    encoder, rnd = Encoder(public_tokenizers.path(name)), random.Random(5)
    texts = ["".join(rnd.choices(ALPHABET, k=rnd.randrange(16))) for _ in range(4000)]
    texts += [None, "", "plain words, twice. plain words", "<|endoftext|>x"]
    ids, counts = encoder.encode(pa.array(texts))
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at : at + n].tolist() == encoder.ids(text or "").tolist()
        at += n
    sliced = list(encoder.encode_in_slices(pa.array(texts)))
    assert sum(len(s[1]) for s in sliced) == at
    assert encoder.encode(pa.array([], pa.string()))[1].tolist() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_white_space_marks_and_neighbours_in_slices(name, monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 2000)
    encoder, rnd = Encoder(public_tokenizers.path(name)), random.Random(7)
    parts = ["word", "Ünder", "naïve", "İ", "漢字", "мир", "42", "'s", "'ll", "'", "=", "\u0338", "\u0301"]
    parts += [".", ",", "&&&", " ", "  ", "\n", "\n\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0"]
    parts += ["\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\u200b", "×", "가", "\u1100", "😀"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(9))) for _ in range(6000)]
    texts += [a + b + c for a in parts for b in parts for c in ("", "x", " ", "\u0301")]
    slices = list(encoder.encode_in_slices(pa.array(texts)[1:]))
    assert len(slices) > 9
    ids = [i for _, found, _ in slices for i in found.tolist()]
    counts = [n for _, _, sizes in slices for n in sizes.tolist()]
    at = 0
    for text, n in zip(texts[1:], counts, strict=True):
        assert ids[at : at + n] == encoder.ids(text).tolist(), repr(text)
        at += n
    assert at == len(ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_word_is_remembered_once_whatever_stands_beside_it(name):
    encoder = Encoder(public_tokenizers.path(name))
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    texts = [f"so {a}.\n{b}, {a}{mark}" for a in words for b in words for mark in "!?;:"]
    encoder.encode(pa.array(texts))
    # With and without a space before it, and the marks; not every pair of neighbours.
    kept = sum(len(x) for x in vars(encoder).values() if isinstance(x, dict))
    assert kept <= 2 * len(words) + 10
