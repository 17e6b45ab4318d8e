"""Sets of word shingles of texts, and their minima under many hash functions, made by column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from skyledger.llm.storage import release_memory

WIDTH = 5
POSITIONS = 64
SLICE_BYTES = 8 << 20
_U = np.uint64


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=_U) << _U(1) | _U(1)


_FACTORS = _odd(WIDTH, 1)
_XOR, _TIMES = _odd(POSITIONS, 2), _odd(POSITIONS, 3)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each number over all 64 bits."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and how many words each text has.

    A word is a run without space, tab or line end. Distinct words are hashed once.
    """
    cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = cut.flatten().dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.array([xxhash.xxh3_64_intdigest(w.encode()) for w in names], _U)
    filled = np.array([bool(w) for w in names])
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    real = filled[at] if len(at) else np.empty(0, bool)
    before = np.concatenate(([0], np.cumsum(real)))
    ends = np.cumsum(counts)
    return hashes[at[real]], before[ends] - before[ends - counts]


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text: its runs of WIDTH words.

    A text of fewer words is one shingle of all of them; one without words has none.
    """
    texts = texts.cast(pa.large_string())
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right")))
        hashes, counts = word_hashes(texts[at:end])
        n = max(0, len(hashes) - WIDTH + 1)
        runs = np.zeros(n, _U)
        for k in range(WIDTH):
            runs += hashes[k : k + n] * _FACTORS[k]
        runs = _mixed(runs)
        first = 0
        for count in counts.tolist():
            if count >= WIDTH:
                yield np.unique(runs[first : first + count - WIDTH + 1])
            elif count:
                own = hashes[first : first + count] * _FACTORS[:count]
                yield _mixed(own.sum(keepdims=True) + _U(count))
            else:
                yield np.empty(0, _U)
            first += count
        at = end
    release_memory()


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest hash of the set under each of POSITIONS functions, as 32 bits."""
    least = np.full(POSITIONS, np.iinfo(_U).max, _U)
    for at in range(0, len(shingles), 1 << 13):
        some = shingles[at : at + (1 << 13), None]
        least = np.minimum(least, ((some ^ _XOR) * _TIMES).min(0))
    return (least >> _U(32)).astype("<u4")
