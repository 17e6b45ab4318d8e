"""Self-join of texts by Jaccard similarity of their word shingles, by chosen paths.

Texts with the same set of shingles form a class, and classes are joined. The set of a class is
embedded as (position, smallest hash at that position), so that two sets share about as large a
part of their tokens as their similarity. All classes start in one node per run. A node is split by
sampled tokens: at each level two positions of the run are chosen, and a class goes on to a child
for its token at each of them. Two classes with similarity s share a given token with probability s,
so they meet again in a child with 1 - (1 - s)^2, and the chance that they part somewhere on the way
is below PART for any depth. Runs, each with its own order of positions, are repeated until the
target recall. A node of at most SMALL classes is compared by brute force. So is one that its
tokens no longer part, having kept most of its parent: classes that are all alike, which are
compared block by block.

In each node, embeddings tell which classes can have a partner there at all; only for those the
texts are fetched and the sets compared exactly. A pair that meets in several nodes counts in the
one with the smallest number. No pair is put out: each node gives, per class, the number of
documents it is linked to there, and one edge to the first class that it hangs together with.
Connected groups are then found by passing on the smallest class number and shortening paths.

Result: doc_id, class_id (the smallest doc_id of the connected group), copies (documents with the
same set of shingles, itself included), links (documents with similarity from THRESHOLD on).

Defined results: a null text is empty; a text without words is linked to nothing and its own group;
texts of fewer than five words are one shingle; repeated rows are copies of each other; a null
doc_id is a document too, and the class_id of a group is null only if all its ids are; an empty
table gives no rows. Other columns are not carried by `similar_groups`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.shingles import POSITIONS, minima, shingle_sets
from skyledger.llm.storage import stored
from skyledger.operators.shared import settle

THRESHOLD = 0.8
RECALL = 0.9999
SMALL = 256  # classes in a node that is compared as it is
KEPT = 0.5  # a node that kept this part of a large parent is not split further
BLOCK = 512  # classes of a large node that are compared with another block at a time
BLOCK_SHINGLES = 400_000
NEAR = 0.55  # share of equal positions from which a pair is compared exactly: five deviations
FIRST, SECOND = 0xD6E8FEB86659FD93, 0xA5A3564E27F2E9A5


def part_probability(s: float = THRESHOLD) -> float:
    """Smallest root of q = ((1 - s) + s q)^2: two choices per level, any number of levels."""
    q = 0.0
    for _ in range(200):
        q = ((1 - s) + s * q) ** 2
    return q


def runs_for(recall: float, s: float = THRESHOLD) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(part_probability(s))))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets, sizes, tokens = [], [], []
        for shingles in shingle_sets(batch.column("text")):
            sets.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            sizes.append(len(shingles))
            tokens.append(minima(shingles).tobytes() if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("doc_id"), pa.array(sets, pa.binary()),
             pa.array(sizes, pa.int64()), pa.array(tokens, pa.binary())],
            names=["doc", "doc_id", "shingle_set", "n", "tokens"],
        )


def _combined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A new 63-bit number from two."""
    x = a.astype(np.uint64) * np.uint64(FIRST) + b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(SECOND)
    x ^= x >> np.uint64(29)
    return (x & np.uint64((1 << 63) - 1)).astype(np.int64)


def _chooser(level: int, runs: int) -> Callable:
    """Children of nodes at a level. Level 0 has no nodes yet: every class starts in each run."""
    orders = [np.random.default_rng(100 + run).permutation(POSITIONS) for run in range(runs)]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), "<u4")
            tokens = tokens.reshape(n, POSITIONS)
            cls = batch.column("cls").to_numpy()
            for run in range(runs):
                if level:
                    own = np.flatnonzero(batch.column("run").to_numpy() == run)
                    nodes = batch.column("node").to_numpy()[own]
                    parent = batch.column("size").to_numpy()[own]
                else:
                    own, nodes = np.arange(n), np.zeros(n, np.int64)
                    parent = np.full(n, np.iinfo(np.int64).max)
                for nth in (0, 1):
                    place = int(orders[run][(2 * level + nth) % POSITIONS])
                    token = tokens[own, place].astype(np.int64) + (place + 1 + (run << 8) << 32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), run, np.int32)),
                         pa.array(_combined(nodes + level, token)), pa.array(cls[own]),
                         pa.array(parent)],
                        names=["run", "node", "cls", "parent"],
                    )

    return choose


def nodes_to_compare(classes: DataFrame, runs: int) -> DataFrame:
    """Memberships (node, cls, size) of all nodes that are to be compared by brute force."""
    schema = "run int, node bigint, cls bigint, parent bigint"
    tokens = classes.select("cls", "tokens")
    frontier, found, level = tokens.mapInArrow(_chooser(0, runs), schema), None, 0
    while True:
        members = stored(frontier, "path_members")
        sizes = members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        members = members.join(sizes, "node")
        # Past the last pair of positions nothing can be split.
        dense = F.col("size") >= KEPT * F.col("parent") if 2 * level + 4 <= POSITIONS else F.lit(True)
        done = (F.col("size") <= SMALL) | dense
        sized = stored(members.select("run", "node", "cls", "size", done.alias("done")), "path_sized")
        ready = sized.where("done").select("node", "cls", "size")
        found = ready if found is None else found.unionByName(ready)
        large = settle(sized.where("not done").drop("done"), "path_large")
        if not large.rows:
            return found
        level += 1
        frontier = large.frame.join(tokens, "cls").mapInArrow(_chooser(level, runs), schema)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, in sorted batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(len(table) - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(table)]
        for lo, hi in zip(cuts[:-2], cuts[1:-1]):
            yield table.slice(lo, hi - lo)
        held = table.slice(cuts[-2])
    if held is not None:
        yield held


UNIT = ["node", "i", "j"]


def units(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Memberships by unit of work: a node, or two blocks (maybe the same) of a large one."""
    totals = members.join(classes.select("cls", "n"), "cls")
    heavy = totals.groupBy("node").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    heavy = heavy.select("node", blocks.alias("blocks")).where("blocks > 1")
    rows = members.join(heavy, "node", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls", "node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return rows.select(
        "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls",
        (F.col("own") == F.least("own", "other")).alias("left"),
    )


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each unit, the classes whose embedding is near that of another one."""
    for unit in _groups(batches, UNIT):
        n = len(unit)
        if n < 2:
            continue
        tokens = np.frombuffer(b"".join(unit.column("tokens").to_pylist()), "<u4").reshape(n, POSITIONS)
        left = unit.column("left").to_numpy(zero_copy_only=False)
        alone = bool((unit.column("i").to_numpy() == unit.column("j").to_numpy()).all())
        near = np.zeros(n, bool)
        for i in range(n - 1):
            rest = slice(i + 1, n)
            equal = (tokens[rest] == tokens[i]).sum(1) >= NEAR * POSITIONS
            if not alone:
                equal &= left[rest] != left[i]
            if equal.any():
                near[i] = True
                near[rest] |= equal
        if near.any():
            yield from unit.select([*UNIT, "cls", "left"]).filter(pa.array(near)).to_batches()


def _bits(lists: list[np.ndarray]) -> np.ndarray:
    """A row of bits per sorted list: which of the values that several lists have are in it."""
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    _, at, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = (np.cumsum(shared) - 1)[at]
    kept = shared[at]
    owner, column = owner[kept], column[kept]
    width = int(shared.sum()) // 64 + 1
    bits = np.zeros(len(lists) * width, np.uint64)
    if len(column):
        # Lists are sorted, so bits of one word stand together.
        word = owner * width + column // 64
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        ones = np.uint64(1) << (column % 64).astype(np.uint64)
        bits[word[starts]] = np.bitwise_or.reduceat(ones, starts)
    return bits.reshape(len(lists), width)


def _compare(threshold: float) -> Callable:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _groups(batches, UNIT):
            n = len(unit)
            if n < 2:
                continue
            node = unit.column("node")[0].as_py()
            cls = unit.column("cls").to_numpy()
            weight = unit.column("copies").to_numpy()
            left = unit.column("left").to_numpy(zero_copy_only=False)
            alone = unit.column("i")[0].as_py() == unit.column("j")[0].as_py()
            sets = [s for chunk in unit.column("text").chunks for s in shingle_sets(chunk)]
            sizes = np.array([len(s) for s in sets])
            tokens = _bits(sets)
            met = unit.column("nodes").to_pylist()
            earlier = _bits([np.array(sorted(x for x in m if x < node), np.int64) for m in met])
            links = np.zeros(n, np.int64)
            first = np.arange(n)
            for i in range(n - 1):
                rest = slice(i + 1, n)
                common = np.bitwise_count(tokens[rest] & tokens[i]).sum(1, dtype=np.int64)
                hit = common >= threshold * (sizes[rest] + sizes[i] - common) - 1e-9
                if not alone:
                    hit &= left[rest] != left[i]
                if not hit.any():
                    continue
                hit &= ~(earlier[rest] & earlier[i]).any(1)
                at = np.flatnonzero(hit) + i + 1
                links[i] += weight[at].sum()
                links[at] += weight[i]
                # Groups within the unit: the smallest row that hangs together with each.
                joined = np.unique(first[np.append(at, i)])
                first[np.isin(first, joined)] = joined[0]
            linked = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[linked]), pa.array(links[linked]), pa.array(cls[first[linked]])],
                names=["cls", "links", "beside"],
            )

    return compare


def connected(edges: DataFrame) -> DataFrame:
    """The smallest class number of each connected group, for edges `cls`, `beside`.

    Each step passes on the smallest number among neighbours and then looks up the number of that
    number, so long chains shrink by half. Messages are combined before the shuffle.
    """
    both = edges.select("cls", "beside").where("cls <> beside")
    both = both.unionByName(both.select(F.col("beside").alias("cls"), F.col("cls").alias("beside")))
    both = stored(both.distinct(), "component_edges")
    labels = stored(both.groupBy("cls").agg(F.least("cls", F.min("beside")).alias("label")), "component_labels")
    while True:
        told = both.join(labels.withColumnRenamed("cls", "beside"), "beside")
        told = told.groupBy("cls").agg(F.min("label").alias("told"))
        moved = labels.join(told, "cls").select("cls", F.least("label", "told").alias("label"), F.col("label").alias("old"))
        moved = stored(moved, "component_labels")
        above = moved.select(F.col("cls").alias("label"), F.col("label").alias("above"))
        step = moved.join(above, "label", "left")
        step = step.select("cls", F.least("label", "above").alias("label"), "old")
        settled = settle(step, "component_labels").frame
        labels = settled.select("cls", "label")
        if not settled.where("label <> old").limit(1).count():
            return labels


def similar_groups(documents: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, copies and links of every document."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = rows.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text")
    schema = "doc bigint, doc_id bigint, shingle_set binary, n bigint, tokens binary"
    made = stored(rows.mapInArrow(_features, schema), "shingle_features")
    per_set = made.where("n > 0").groupBy("shingle_set").agg(
        F.min(F.struct("doc_id", "doc")).alias("first"), F.count("*").alias("copies"),
        F.min("doc_id").alias("least_id"), F.max("n").alias("n"), F.max("tokens").alias("tokens"),
    )
    # Numbers are given once, as the table is written.
    classes = stored(
        per_set.select(F.monotonically_increasing_id().alias("cls"), "*").select(
            "cls", "shingle_set", "copies", "n", "tokens", "least_id", F.col("first.doc").alias("doc")
        ),
        "shingle_classes",
    )
    members = nodes_to_compare(classes, runs_for(recall, threshold))
    work = units(members, classes).join(classes.select("cls", "tokens"), "cls")
    work = work.repartition(*UNIT).sortWithinPartitions(*UNIT)
    active = work.select(*UNIT, "cls", "left", "tokens").mapInArrow(
        _with_partners, "node bigint, i bigint, j bigint, cls bigint, left boolean"
    )
    active = stored(active, "path_active")
    alive = active.select("cls").distinct()
    visited = members.join(alive, "cls", "left_semi").groupBy("cls").agg(F.collect_set("node").alias("nodes"))
    chosen = classes.join(alive, "cls", "left_semi").select("cls", "copies", "doc")
    texts = rows.select("doc", "text").join(chosen, "doc").dropDuplicates(["cls"]).drop("doc")
    fetched = stored(texts.join(visited, "cls"), "path_texts")
    compared = active.join(fetched, "cls").repartition(*UNIT).sortWithinPartitions(*UNIT)
    compared = compared.select(*UNIT, "cls", "left", "copies", "nodes", "text").mapInArrow(
        _compare(threshold), "cls bigint, links bigint, beside bigint"
    )
    compared = stored(compared, "path_links")
    labels = connected(compared)
    counted = compared.groupBy("cls").agg(F.sum("links").alias("links"))
    grouped = classes.join(labels, "cls", "left").join(counted, "cls", "left")
    grouped = stored(
        grouped.select(
            "shingle_set", "copies", "least_id", F.coalesce("label", "cls").alias("label"),
            F.coalesce("links", F.lit(0)).alias("links"),
        ),
        "class_groups",
    )
    least = grouped.groupBy("label").agg(F.min("least_id").alias("class_id"))
    answer = grouped.join(least, "label").select("shingle_set", "class_id", "copies", "links")
    alone = made.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("copies"), F.lit(0).cast("bigint").alias("links"))
    found = made.where("n > 0").select("doc_id", "shingle_set").join(answer, "shingle_set")
    found = found.select("doc_id", "class_id", "copies", (F.col("links") + F.col("copies") - 1).alias("links"))
    return found.unionByName(alone)


def first_of_groups(documents: DataFrame) -> DataFrame:
    """The first row of each connected group of documents, in the order of their rows."""
    rows = stored(
        documents.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_id")),
        "similar_documents",
    )
    groups = similar_groups(rows.select(F.col("_id").alias("doc_id"), "_row.text"))
    first = stored(groups.where("doc_id = class_id").select(F.col("doc_id").alias("_id")), "first_rows")
    return rows.join(first, "_id", "left_semi").select("_row.*")
