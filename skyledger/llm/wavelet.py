"""Token ids of documents as wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents. Level 0 stores the highest bit of every id; each
further level stores the next bit after the ids were parted, stably, by the bit before. With the
number of ones before each block, one id, a count or the place of an occurrence is found by
reading one block per level.

File: magic, compressed bit blocks level by level, compressed index, then length and crc32 of the
index and the magic again. The index has the numbers of tokens, documents and levels, zeros per
level, ends of blocks, ones before blocks, ends of documents and document ids.

Defined results: a null text has the end id only, an empty text too; a null doc_id comes first and
stays null; rows of one doc_id follow each other in the order of their texts' hashes; repeated
rows are all kept; an empty table gives no file and no row. Other columns are not stored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.storage import WholeFile, file_system, gathered, spread, stored
from skyledger.llm.tokens import GATHERED_BYTES, ID, encoder
from skyledger.operators.shared import scratch_path

MAGIC = b"SLWM0001"
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 1 << 22  # a shard is closed at the end of the document that reaches this
MANIFEST = "part int, shard int, path string, n_docs bigint, n_tokens bigint"
DOCUMENTS = "doc_id bigint, part int, shard int, start bigint, n_tokens bigint, ids binary"


def _places(bits: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Places of the zeros and then of the ones; places are moved faster than by a mask."""
    ones = np.unpackbits(bits, count=n, bitorder="little").view(bool)
    yield np.flatnonzero(~ones)
    yield np.flatnonzero(ones)


def build(ids: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[int]]:
    """Packed bits and number of zeros of each level."""
    kind = np.uint16 if levels <= 16 else np.uint32
    rest = ids.astype(kind)
    planes, zeros = [], []
    for level in range(levels):
        bits = np.packbits(rest & kind(1 << (levels - 1 - level)) != 0, bitorder="little")
        left, right = (rest.take(places) for places in _places(bits, len(rest)))
        planes.append(bits)
        zeros.append(len(left))
        rest = np.concatenate((left, right))
    return planes, zeros


def unbuild(planes: list[np.ndarray], zeros: list[int], n: int) -> np.ndarray:
    """All ids in their order, from the lowest level up."""
    levels = len(planes)
    kind = np.uint16 if levels <= 16 else np.uint32
    below = np.zeros(n, kind)
    for level in reversed(range(levels)):
        below[zeros[level] :] |= kind(1 << (levels - 1 - level))
        here, at = np.empty(n, kind), 0
        for places in _places(planes[level], n):
            here[places] = below[at : at + len(places)]
            at += len(places)
        below = here
    return below.astype(ID)


def write_shard(out, ids: np.ndarray, ends: np.ndarray, doc_ids: list[int | None], levels: int):
    planes, zeros = build(ids, levels)
    pack = zstandard.ZstdCompressor(level=1).compress
    step = BLOCK_BITS // 8
    out.write(MAGIC)
    at, block_ends, ones_before = len(MAGIC), [], []
    for plane in planes:
        ones = 0
        for lo in range(0, len(plane), step):
            block = plane[lo : lo + step]
            raw = block.tobytes()
            body = min(raw, pack(raw), key=len)  # a block of its full length is not compressed
            out.write(body)
            at += len(body)
            block_ends.append(at)
            ones_before.append(ones)
            ones += int(np.bitwise_count(block).sum())
    known = np.array([x is not None for x in doc_ids], np.uint8)
    head = np.array([len(ids), len(doc_ids), levels], "<u8")
    parts = (
        head, np.array(zeros, "<u8"), np.array(block_ends, "<u8"), np.array(ones_before, "<u8"),
        ends.astype("<u8"), np.array([x or 0 for x in doc_ids], "<i8"), known,
    )
    index = pack(b"".join(p.tobytes() for p in parts))
    out.write(index)
    out.write(struct.pack("<QI", len(index), zlib.crc32(index)) + MAGIC)


class WaveletFile:
    """Reads a shard; only the blocks that a question needs are read and unpacked."""

    TAIL = 12 + len(MAGIC)

    def __init__(self, uri: str):
        files, path = file_system(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        length, crc, magic = struct.unpack(f"<QI{len(MAGIC)}s", self._read(size - self.TAIL, size))
        index = self._read(size - self.TAIL - length, size - self.TAIL)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"{uri} is not a whole shard")
        self.unpack = zstandard.ZstdDecompressor().decompress
        raw = self.unpack(index, max_output_size=1 << 31)
        self.n, n_docs, self.levels = np.frombuffer(raw, "<u8", 3).tolist()
        self.blocks = -(-(-(-self.n // 8)) // (BLOCK_BITS // 8))
        at = 24

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            at += count * np.dtype(kind).itemsize
            return np.frombuffer(raw, kind, count, at - count * np.dtype(kind).itemsize)

        self.zeros = take("<u8", self.levels).tolist()
        self.block_ends = take("<u8", self.levels * self.blocks).tolist()
        self.ones_before = take("<u8", self.levels * self.blocks).tolist()
        self.ends = take("<u8", n_docs).astype(np.int64)
        ids, known = take("<i8", n_docs).tolist(), take("u1", n_docs).tolist()
        self.doc_ids = [x if k else None for x, k in zip(ids, known)]

    def _read(self, lo: int, hi: int) -> bytes:
        self.file.seek(lo)
        return self.file.read(hi - lo)

    def close(self) -> None:
        self.file.close()

    def _block(self, level: int, block: int) -> bytes:
        k = level * self.blocks + block
        body = self._read(self.block_ends[k - 1] if k else len(MAGIC), self.block_ends[k])
        size = min(BLOCK_BITS // 8, -(-self.n // 8) - block * (BLOCK_BITS // 8))
        return body if len(body) == size else self.unpack(body, max_output_size=size)

    def _ones(self, level: int, i: int) -> tuple[int, int]:
        """Ones before place i, and the bit there (0 past the end)."""
        if i >= self.n:
            return self.n - self.zeros[level], 0
        block, within = divmod(i, BLOCK_BITS)
        bits = np.frombuffer(self._block(level, block), np.uint8)
        whole, rest = divmod(within, 8)
        ones = int(np.bitwise_count(bits[:whole]).sum()) + int(bits[whole] & ((1 << rest) - 1)).bit_count()
        return self.ones_before[level * self.blocks + block] + ones, int(bits[whole]) >> rest & 1

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            ones, bit = self._ones(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.levels):
            a, b = self._ones(level, lo)[0], self._ones(level, hi)[0]
            if token >> (self.levels - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often an id occurs in places lo to hi."""
        first, last = self._range(token, lo, self.n if hi is None else hi)
        return last - first

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) one or zero of a level."""
        lo, hi = 0, self.blocks - 1
        row = level * self.blocks
        before = lambda b: (
            self.ones_before[row + b] if bit else b * BLOCK_BITS - self.ones_before[row + b]
        )
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if before(mid) <= k else (lo, mid - 1)
        bits = np.unpackbits(np.frombuffer(self._block(level, lo), np.uint8), bitorder="little")
        bits = bits[: self.n - lo * BLOCK_BITS]
        return lo * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - before(lo)])

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        first, last = self._range(token, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i = first + k
        for level in reversed(range(self.levels)):
            bit = token >> (self.levels - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> Iterator[int]:
        return (self.select(token, k) for k in range(self.count(token)))

    def ids(self) -> np.ndarray:
        """All ids, level by level."""
        planes = [
            np.frombuffer(b"".join(self._block(v, b) for b in range(self.blocks)), np.uint8)
            for v in range(self.levels)
        ]
        return unbuild(planes, self.zeros, self.n)


def _writer(tokenizer: str, end_id: int, folder: str, shard_tokens: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        tokens = encoder(tokenizer)
        levels = max(tokens.vocabulary - 1, end_id).bit_length()
        ids, counts, doc_ids, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/shard-{part:06d}-{shard:06d}.wm"
            ends = np.cumsum(np.concatenate(counts))
            with WholeFile(path) as out:
                write_shard(out, np.concatenate(ids), ends, doc_ids, levels)
            row = {"part": [part], "shard": [shard], "path": [path]}
            row |= {"n_docs": [len(doc_ids)], "n_tokens": [int(ends[-1])]}
            return pa.RecordBatch.from_pydict(row, MANIFEST_ARROW)

        for batch in gathered(batches, GATHERED_BYTES):
            keys = batch.column("doc_id").to_pylist()
            for at, found, sizes in tokens.encode_in_slices(batch.column("text")):
                # The end id goes behind each document of the slice.
                found = np.insert(found, np.cumsum(sizes), end_id).astype(ID)
                sizes = sizes + 1
                lo = 0
                ends = np.cumsum(sizes)
                while lo < len(sizes):
                    used = ends[lo - 1] if lo else 0
                    hi = int(np.searchsorted(ends, used + shard_tokens - held)) + 1
                    hi = min(hi, len(sizes))
                    ids.append(found[used : ends[hi - 1]])
                    counts.append(sizes[lo:hi])
                    doc_ids += keys[at + lo : at + hi]
                    held += int(ends[hi - 1] - used)
                    lo = hi
                    if held >= shard_tokens:
                        yield close()
                        ids, counts, doc_ids, held = [], [], [], 0
                        shard += 1
        if doc_ids:
            yield close()

    return write


MANIFEST_ARROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.int32()), ("path", pa.string()),
     ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)
DOCUMENTS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("shard", pa.int32()), ("start", pa.int64()),
     ("n_tokens", pa.int64()), ("ids", pa.large_binary())]
)


def write_shards(
    documents: DataFrame, tokenizer: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Write all documents in ascending doc_id order; one row per file, in `part, shard` order.

    Documents are range-partitioned by doc_id (and text, so that one id held by many rows is
    spread too). A task holds one shard at a time. Files and manifest are on shared storage.
    """
    folder = scratch_path(documents.sparkSession, "wavelet")
    # Sorting needs no text: equal keys differ in a hash of it.
    ordered = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("_tie")
    )
    ordered = ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    write = _writer(tokenizer, end_id, folder, shard_tokens)
    return stored(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "wavelet_manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = WaveletFile(row["path"])
            ids, ends = shard.ids(), shard.ends
            shard.close()
            # A few MB at a time go on to the JVM.
            cuts = np.searchsorted(ends, np.arange(1 << 20, len(ids), 1 << 20)).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, len(ends)]):
                if lo == hi:
                    continue
                bounds = np.concatenate((ends[lo - 1 : lo] if lo else [0], ends[lo:hi]))
                data = ids[bounds[0] : bounds[-1]].tobytes()
                places = pa.array((bounds - bounds[0]) * 4, pa.int64())
                blobs = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo, [None, places.buffers()[1], pa.py_buffer(data)]
                )
                columns = [
                    pa.array(shard.doc_ids[lo:hi], pa.int64()),
                    pa.array([row["part"]] * (hi - lo), pa.int32()),
                    pa.array([row["shard"]] * (hi - lo), pa.int32()),
                    pa.array(row["start"] + bounds[:-1], pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    blobs,
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=DOCUMENTS_ARROW)


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document of the files: its place among all ids, their number and the ids themselves.

    The manifest has one row per shard of millions of ids, so adding up its counts in one task
    handles a table some hundred thousand times smaller than the documents.
    """
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")
    placed = stored(manifest.select("part", "shard", "path", start), "wavelet_starts")
    return spread(placed, placed.count()).mapInArrow(_read, DOCUMENTS)
