"""Token ids of whole texts, with a bounded memory of pieces already encoded.

Byte-level and word-end vocabularies never build a token across the start of a white-space run,
across the end of a run of letters and digits before ASCII punctuation, or across a line end that
stands alone. Texts are cut at all such places at once, on their bytes; each distinct piece is
encoded once by the tokenizer itself, and the ids are put together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from skyledger.llm.storage import release_memory

ID = np.dtype("<u4")
REMEMBERED = 400_000  # distinct pieces kept per Python worker, none of which is longer than
REMEMBERED_LENGTH = 64
SLICE_BYTES = 8 << 20  # texts encoded together
GATHERED_BYTES = 6 << 20  # small batches are encoded together, which shares their words
#: ASCII punctuation, which no normal form joins to a letter.
_MARK = re.compile(r"[!-/:-@\[-`{-~]")
#: Letters and digits whose forms stay letters and digits, of one or two bytes.
_WORD = re.compile(r"[0-9A-Za-zÀ-ÖØ-öø-įı-ʯ]")
_IS_SPACE, _IS_MARK, _IS_WORD, _IS_LINE = 1, 2, 4, 8
_KINDS = np.array(
    [
        _IS_SPACE * (c in " \t\n\v\f\r") | _IS_MARK * bool(_MARK.match(c))
        | _IS_WORD * bool(_WORD.match(c)) | _IS_LINE * (c in "\t\n\r")
        for c in map(chr, range(128))
    ] + [0] * 128,
    np.uint8,
)
_TWO_BYTE_WORD = np.array([c >= 0x80 and bool(_WORD.match(chr(c))) for c in range(0x2C0)])
#: White space beyond ASCII, as Unicode has it, by its first byte.
_WIDE_SPACE: dict[int, list[bytes]] = {}
for _c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))):
    _WIDE_SPACE.setdefault(_c.encode()[0], []).append(_c.encode())


def _cuts(data: np.ndarray) -> np.ndarray:
    """Whether texts are cut before each of their bytes, but for the starts of texts."""
    kinds = _KINDS[data]
    if (data >= 0x80).any():
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xCA))
        codes = (data[lead] & 0x1F).astype(np.int16) << 6 | data[lead + 1] & 0x3F
        kinds[lead[_TWO_BYTE_WORD[codes]] + 1] = _IS_WORD
        for first, spaces in _WIDE_SPACE.items():
            lead = np.flatnonzero(data == first)
            for space in spaces if len(lead) else ():
                here = lead
                for k in range(1, len(space)):
                    here = here[data[here + k] == space[k]]
                for k in range(len(space)):
                    kinds[here + k] = _IS_SPACE
    solid = (kinds & _IS_SPACE) == 0
    cuts = np.zeros(len(data), bool)
    # White space goes with what follows it, as its ids depend on that.
    cuts[1:] = solid[:-1] & ~solid[1:]
    cuts[1:] |= (kinds[:-1] & _IS_WORD != 0) & (kinds[1:] & _IS_MARK != 0)
    cuts[2:] |= (kinds[1:-1] & _IS_LINE != 0) & solid[:-2] & solid[2:]
    return cuts


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.vocabulary)]
        # In a run of words set apart by one space, these tokens begin or end a word.
        self.begins = np.array([n.startswith("Ġ") for n in names])
        self.ends = np.array([n.endswith("</w>") for n in names])
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        # The fast form gives the same ids and does not work out where they stand in the text.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=ID)

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, each a space and letters, many in one call."""
        found: dict[str, bytes] = {}
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            ids = self.ids("".join(some))
            if self.ends.any():
                cuts = np.flatnonzero(self.ends[ids]) + 1
                bounds = np.concatenate(([0], cuts))
            else:
                cuts = np.flatnonzero(self.begins[ids])
                bounds = np.concatenate((cuts, [len(ids)]))
            if len(cuts) != len(some) or bounds[0] != 0 or bounds[-1] != len(ids):
                # A word of several cuts, or a vocabulary without such tokens.
                found.update((word, self.ids(word).tobytes()) for word in some)
                continue
            raw, bounds = ids.tobytes(), (4 * bounds).tolist()
            found.update(
                (word, raw[lo:hi]) for word, lo, hi in zip(some, bounds, bounds[1:])
            )
        return found

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each distinct piece."""
        found = list(map(self.known.get, pieces))
        new = [i for i, ids in enumerate(found) if ids is None]
        unseen = [pieces[i] for i in new]
        fresh = self._words([x for x in unseen if x[0] == " " and x[1:].isalpha()])
        for piece in unseen:
            if piece not in fresh:
                fresh[piece] = self.ids(piece).tobytes()
        for i, piece in zip(new, unseen):
            found[i] = fresh[piece]
        if (room := REMEMBERED - len(self.known)) > 0:
            short = (x for x in fresh.items() if len(x[0]) <= REMEMBERED_LENGTH)
            self.known.update(islice(short, room))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has. Null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        if not pc.sum(pc.binary_length(texts)).as_py():
            return np.empty(0, ID), np.zeros(len(texts), np.int64)
        offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        cuts = _cuts(data)
        cuts[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cuts)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)
        ).dictionary_encode()
        at = pieces.indices.to_numpy()
        entries = self._pieces(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        joined = pa.array(entries, pa.large_binary()).take(pieces.indices)
        _, ends, ids = joined.buffers()
        # Ids before each piece, and after the last one.
        before = np.frombuffer(ends, np.int64, len(starts) + 1) // ID.itemsize
        counts = np.diff(before[np.searchsorted(starts, offsets)])
        return np.frombuffer(ids, ID, before[-1]) if ids else np.empty(0, ID), counts

    def encode_in_slices(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """As encode, for slices of bounded size: first row of the slice, ids, counts."""
        texts = texts.cast(pa.large_string())
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
        at = 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right")))
            yield (at, *self.encode(texts[at:end]))
            at = end
        release_memory()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
