"""Packing documents into sequences of bounded length by minimum bin slack.

Only lengths matter for the plan, and there are at most as many as a sequence has places. So the
plan is made of a histogram: for the longest length left, subset sums over the lengths left (one
bit per place, each length as often as it is left) give the fullest sequence that holds it. That
combination is taken as often as all its lengths are left, which removes it from the histogram.
The plan is the same size for any number of documents.

Pieces get their place in the plan by their rank among pieces of their length: rank within the
task that cut them, plus how many pieces of that length earlier tasks have.

Defined results: null and empty texts are one piece of the end id alone; repeated rows and ids are
packed as often as they occur; ties in length are taken in the order the pieces were cut; an empty
table gives no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.storage import gathered, stored
from skyledger.llm.tokens import GATHERED_BYTES, ID, encoder

SEQUENCE = 4096
BROADCAST_ROWS = 1_000_000  # bases of two numbers and a length each: at most 30 MB
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary, part int, nth bigint"
PIECES_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
     ("length", pa.int64()), ("ids", pa.large_binary()), ("part", pa.int32()),
     ("nth", pa.int64())]
)


class Plan(NamedTuple):
    """Runs of pieces of one length: from rank `first` on, one per sequence from `sequence` on."""

    lengths: np.ndarray
    firsts: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    n_sequences: int


def fullest(left: dict[int, int], capacity: int) -> list[int]:
    """Lengths, each at most as often as it is left, whose sum is the largest within capacity.

    Bit s of a set tells whether sum s can be made. Lengths are added from long to short until the
    capacity itself is reached, and the sets are then read backwards.
    """
    if capacity <= 0:
        return []
    mask = (1 << capacity + 1) - 1
    sums, steps = 1, []
    for length in sorted((x for x in left if x <= capacity and left[x]), reverse=True):
        count, chunk = min(left[length], capacity // length), 1
        while count:  # 1, 2, 4, ... copies at a time
            used = min(chunk, count)
            steps.append((length, used, sums))
            sums |= sums << length * used & mask
            count -= used
            chunk *= 2
        if sums >> capacity & 1:
            break
    total = sums.bit_length() - 1
    taken = []
    for length, used, before in reversed(steps):
        # Left out where the sum can be made without it, that is of longer lengths.
        if not before >> total & 1:
            taken += [length] * used
            total -= length * used
    return taken


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    left = {length: n for length, n in sorted(histogram.items()) if n}
    used = dict.fromkeys(left, 0)
    rows, sequences = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        combination = [longest, *fullest(left, capacity - longest)]
        left[longest] += 1
        need = {length: combination.count(length) for length in combination}
        times = min(left[length] // n for length, n in need.items())
        offset = 0
        for length in combination:
            rows.append((length, used[length], sequences, offset))
            used[length] += times
            offset += length
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequences += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(*(table[:, i].copy() for i in range(4)), sequences)


def _cutter(tokenizer: str, end_id: int, capacity: int) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        tokens = encoder(tokenizer)
        for batch in gathered(batches, GATHERED_BYTES):
            keys = batch.column("doc_id")
            for at, ids, sizes in tokens.encode_in_slices(batch.column("text")):
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype(ID)
                sizes = sizes + 1
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                nth_piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth_piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                ends = np.cumsum(length)
                places = pa.array(np.concatenate(([0], ends)) * ID.itemsize, pa.int64())
                blobs = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(doc),
                    [None, places.buffers()[1], pa.py_buffer(ids.tobytes())],
                )
                # Rank among the pieces of this task that have the same length.
                by_length = np.argsort(length, kind="stable")
                ordered = length[by_length]
                run = np.searchsorted(ordered, ordered)
                nth = np.empty(len(doc), np.int64)
                nth[by_length] = np.arange(len(doc)) - run + seen[ordered]
                seen += np.bincount(length, minlength=capacity + 1)
                columns = [
                    keys.take(pa.array(at + doc)).cast(pa.int64()),
                    pa.array(nth_piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    blobs,
                    pa.array(np.full(len(doc), part), pa.int32()),
                    pa.array(nth, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=PIECES_ARROW)

    return cut


def cut_documents(documents: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of at most `capacity` ids on shared storage, ranked by length within their task."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stored(texts.mapInArrow(_cutter(tokenizer, end_id, capacity), PIECES), "pieces")


def pack_pieces(pieces: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """Adds `sequence_id` and `offset` to pieces made by cut_documents."""
    spark = pieces.sparkSession
    cells = stored(pieces.groupBy("part", "length").count(), "piece_cells")
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    made = spark.sparkContext.broadcast(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_base"))
    if cells.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p = made.value
        # The last run of this length that starts at or before the rank.
        step = np.int64(1) << 40
        run = np.searchsorted(p.lengths * step + p.firsts, length * step + rank, "right") - 1
        return pd.DataFrame(
            {"sequence_id": p.sequences[run] + (rank - p.firsts[run]), "offset": p.offsets[run]}
        )

    ranked = pieces.join(bases, ["part", "length"])
    placed = ranked.withColumn("_at", place("length", F.col("_base") + F.col("nth")))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids",
        F.col("_at.sequence_id").alias("sequence_id"), F.col("_at.offset").alias("offset"),
    )


def pack_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = SEQUENCE
) -> DataFrame:
    """One row per piece: its document, place there, ids, and place in a sequence."""
    return pack_pieces(cut_documents(documents, tokenizer, end_id, capacity), capacity)
