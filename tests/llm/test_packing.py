import bisect
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import packing
from skyledger.llm.tokens import ID, Encoder
from tests.llm.samples import documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9), st.integers(0, 30))
def test_fullest_combination(lengths, capacity):
    best = max(
        sum(c) for k in range(len(lengths) + 1) for c in combinations(lengths, k) if sum(c) <= capacity
    )
    taken = packing.fullest(dict(Counter(lengths)), capacity)
    assert sum(taken) == best and not Counter(taken) - Counter(lengths)


def best_fit(falling, capacity):
    """Sequences that best-fit decreasing takes."""
    free, n = [], 0
    for length in falling:
        at = bisect.bisect_left(free, length)
        n += at == len(free)
        left = (capacity if at == len(free) else free.pop(at)) - length
        bisect.insort(free, left)
    return n


@pytest.mark.parametrize("seed", range(4))
def test_plan_packs_all_and_nearly_fills(seed):
    rnd = random.Random(seed)
    lengths = Counter(rnd.randint(1, 100) for _ in range(3000))
    made = packing.plan(dict(lengths), 100)
    # Runs of a length begin where the one before ends, so all pieces have a place.
    bins = defaultdict(int)
    runs = defaultdict(list)
    for length, first, sequence, _ in zip(*made[:4]):
        runs[int(length)].append((int(first), int(sequence)))
    for length, starts in runs.items():
        starts.sort()
        ends = [s for s, _ in starts[1:]] + [lengths[length]]
        assert starts[0][0] == 0
        for (first, sequence), end in zip(starts, ends):
            for i in range(end - first):
                bins[sequence + i] += length
    assert max(bins.values()) <= 100 and len(bins) == made.n_sequences
    assert made.n_sequences <= best_fit(sorted(lengths.elements(), reverse=True), 100) + 1


@pytest.mark.parametrize("capacity", [16, 4096])
def test_documents_are_packed_without_gaps(spark, capacity):
    found = packing.pack_documents(frame(spark), PATH, 1, capacity).collect()
    tokens, wanted = Encoder(PATH), Counter()
    for doc_id, text, *_ in documents():
        ids = [*tokens.ids(text or "").tolist(), 1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            wanted[doc_id, piece, start, tuple(ids[start : start + capacity])] += 1
    got = Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, ID).tolist())) for r in found)
    assert got == wanted
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, []), PATH).collect() == []


def test_small_batches_are_encoded_together(monkeypatch):
    calls = []

    class Counted(Encoder):
        def encode(self, texts):
            calls.append(len(texts))
            return super().encode(texts)

    class Task:
        get = classmethod(lambda cls: cls())
        partitionId = lambda self: 3

    monkeypatch.setattr(packing, "TaskContext", Task)
    monkeypatch.setattr(packing, "encoder", Counted)
    texts = ["one two", None, "", "three " * 30, "one two"] * 8
    batches = [
        pa.RecordBatch.from_pydict({"doc_id": pa.array([i], pa.int64()), "text": pa.array([text], pa.string())})
        for i, text in enumerate(texts)
    ]
    cut = packing._cutter(PATH, 1, 8)
    pieces = [p for batch in cut(iter(batches)) for p in batch.to_pylist()]
    assert calls == [len(texts)]
    plain = Encoder(PATH)
    seen = {}
    at = 0
    for i, text in enumerate(texts):
        ids = [*plain.ids(text or "").tolist(), 1]
        for k, start in enumerate(range(0, len(ids), 8)):
            part = ids[start : start + 8]
            assert pieces[at] == {
                "doc_id": i, "piece": k, "start": start, "length": len(part),
                "ids": np.array(part, ID).tobytes(), "part": 3, "nth": seen.get(len(part), 0),
            }
            seen[len(part)] = seen.get(len(part), 0) + 1
            at += 1
    assert at == len(pieces)
