"""Conversation structure repair: the cheapest edits after which roles read `(s?(ua)+)?`.

Rows of a conversation are in order of turn (nulls first), role and the MD5 of the text. Every row
is kept (K), given the other role (R), or deleted (D), and empty rows may be inserted (I). The edits
in order are the audit; of the cheapest audits the one that is least by ASCII counts.

Faults are found by Spark: equal rows are counted first, so a text repeated all over a conversation
is one row here, and first occurrences are looked up. Rows then shrink to one byte each (initial of
the role and fault), cut into slices of sorted rows, so no task collects the texts of a group.

The audit is a dynamic program over four states of the role pattern. A state holds its cost and the
last node of its audit; nodes are linked to the edit before, so audits share their prefixes and a
row adds a few nodes. Two audits of equal cost that reach the same state are never prefixes of one
another (the rest would be insertions, which cost), so they differ first at some letter. It is
found by climbing both from equal depth while the rolling hashes of the prefixes differ, over jumps
that double; equal hashes are verified. A jump per node is enough, as nodes of equal depth jump
equally far.

Texts are then read once in order, beside the audit of their conversation, as a stream.

One conversation's audit is one value, and a hash of its texts has no parallel form: both are of
the length of that conversation whatever the method, so one task handles its bytes (one a row) and
its stream of texts, and no more than a batch of texts is held.

Defined results: null role and text are one space; a null conv_id is a conversation of its own; a
null turn comes first and does not count for gaps; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skyledger.llm.storage import stored
from skyledger.operators.lookups import lookup_join

BLANKS = " \t\n\x0b\x0c\r"
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)  # faults; the greatest of a row counts
INITIALS = "sua"
OTHER = len(INITIALS)
ROLES = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1  # costs
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states: what the last kept row was
ENDS = (NOTHING, ASSISTANT)
NEXT = {NOTHING: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # initials that may follow
REACHED = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
BASE, MODULUS = 1_000_003, (1 << 61) - 1
ROWS = 2000  # rows of one batch of repaired messages

FACTS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_FACT_NAMES = [f.split()[0] for f in FACTS.split(", ")]
_FACT_TYPES = [pa.string() if f == "audit" else pa.int64() for f in _FACT_NAMES]


class Audits:
    """Strings that share their prefixes; a string is the number of its last node."""

    def __init__(self):
        self.letter, self.parent, self.jump = bytearray(b"\0"), array("q", [0]), array("q", [0])
        self.depth, self.hash = array("q", [0]), array("q", [0])

    def append(self, node: int, letter: int) -> int:
        """The string of `node` and one more letter."""
        new = len(self.letter)
        hop = self.jump[node]
        far = self.depth[node] - self.depth[hop] == self.depth[hop] - self.depth[self.jump[hop]]
        self.letter.append(letter)
        self.parent.append(node)
        self.jump.append(self.jump[hop] if far and node else node)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * BASE + letter) % MODULUS)
        return new

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            hop = self.jump[node]
            node = hop if self.depth[hop] >= depth else self.parent[node]
        return node

    def same(self, a: int, b: int) -> bool:
        """Equality of two strings of one length: by hash, and verified letter by letter."""
        if self.hash[a] != self.hash[b]:
            return False
        while a != b and self.letter[a] == self.letter[b]:
            a, b = self.parent[a], self.parent[b]
        return a == b

    def less(self, a: int, b: int) -> bool:
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        while not self.same(self.parent[x], self.parent[y]):
            p, q = self.jump[x], self.jump[y]
            x, y = (self.parent[x], self.parent[y]) if self.same(p, q) else (p, q)
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        out = bytearray()
        while node:
            out.append(self.letter[node])
            node = self.parent[node]
        return out[::-1].decode()


K, R, D, I = b"KRDI"  # noqa: E741


def cheapest_audit(symbols: bytes) -> tuple[int, str]:
    """Cost and audit of rows given as 4 * initial + fault."""
    audits = Audits()
    best: dict[int, tuple[int, int]] = {NOTHING: (0, 0)}

    def offer(to: dict[int, tuple[int, int]], state: int, cost: int, node: int, letter: int) -> None:
        known = to.get(state)
        if known is None or cost < known[0]:
            to[state] = cost, audits.append(node, letter)
        elif cost == known[0]:
            other = audits.append(node, letter)
            if audits.less(other, known[1]):
                to[state] = cost, other

    def insert(at: dict[int, tuple[int, int]]) -> None:
        """Insertions at one place; two lead anywhere, more would lead back at a cost."""
        for state in (NOTHING, SYSTEM, ASSISTANT):
            if state in at:
                offer(at, USER, at[state][0] + INSERT, at[state][1], I)
        if USER in at:
            offer(at, ASSISTANT, at[USER][0] + INSERT, at[USER][1], I)

    insert(best)
    for symbol in symbols:
        initial, fault = symbol >> 2, symbol & 3
        role = INITIALS[initial] if initial < OTHER else ""
        after: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in best.items():
            offer(after, state, cost + DELETE, node, D)
            if fault < DUPLICATE:
                kept = cost + (CUT_OFF if fault == TRUNCATED else 0)
                if role and role in NEXT[state]:
                    offer(after, REACHED[role], kept, node, K)
                offer(after, REACHED[NEXT[state][-1]], kept + REROLE, node, R)
        insert(after)
        best = after
    ends = [best[s] for s in ENDS if s in best]
    cost = min(c for c, _ in ends)
    first, *rest = [node for c, node in ends if c == cost]
    for node in rest:
        first = node if audits.less(node, first) else first
    return cost, audits.text(first)


def in_order(messages: DataFrame) -> DataFrame:
    """Rows as they are repaired: conv_id, turn, role, text, and the digest that orders ties."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return messages.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn(
        "digest", F.md5("text")
    )


def damaged(messages: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn, to try the repair on."""
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = F.crc32(F.encode(name, "utf-8")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1).cast("int"))
    return messages.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        text.alias("text"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


def _symbols(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number `n`, and the symbols of the first and of the others."""
    end = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    )
    letter = F.substring("role", 1, 1)
    initial = F.lit(OTHER)
    for i, known in enumerate(INITIALS):
        initial = F.when(letter == known, i).otherwise(initial)
    keys = ["conv_id", "turn", "role", "digest"]
    distinct = stored(
        rows.select(*keys, initial.alias("initial"), fault.alias("fault"))
        .groupBy(*keys, "initial", "fault").agg(F.count(F.lit(1)).alias("n")),
        "distinct_rows",
    )
    text_key = ["conv_id", "role", "digest"]
    seen = distinct.groupBy(*text_key).agg(
        F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")
    )
    looked_up = lookup_join(
        distinct, seen.where("turns > 1").drop("turns"), text_key, null_safe=True
    )
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    repeat = F.greatest("fault", F.lit(DUPLICATE))
    return looked_up.select(
        *keys, "n", (4 * F.col("initial") + F.when(later, repeat).otherwise(F.col("fault"))).alias("one"),
        (4 * F.col("initial") + repeat).alias("more"),
    )


def _cutter(id_type: pa.DataType) -> Callable:
    """Sorted rows to one row per conversation and slice, with its bytes and its turns."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rows = (row for batch in batches for row in batch.to_pylist())
        for conv_id, group in groupby(rows, itemgetter("conv_id")):
            symbols, turns, first, last = bytearray(), 0, None, None
            for row in group:
                symbols += bytes([row["one"]]) + bytes([row["more"]]) * (row["n"] - 1)
                if row["turn"] is not None and row["turn"] != last:
                    first, last, turns = row["turn"] if first is None else first, row["turn"], turns + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv_id], id_type), pa.array([part], pa.int32()),
                 pa.array([bytes(symbols)], pa.binary()), pa.array([turns], pa.int64()),
                 pa.array([first], pa.int64()), pa.array([last], pa.int64())],
                ["conv_id", "part", "symbols", "turns", "first", "last"],
            )

    return cut


def _facts_of(slices: list[dict]) -> dict:
    symbols, distinct, least, greatest = bytearray(), 0, None, None
    for piece in slices:
        symbols += piece["symbols"]
        if piece["turns"]:
            distinct += piece["turns"] - (piece["first"] == greatest)
            least, greatest = piece["first"] if least is None else least, piece["last"]
    initials = [s >> 2 for s in symbols]
    faults = [s & 3 for s in symbols]
    legal = {(0, 1), (1, 2), (2, 1)}  # su, ua, au
    cost, audit = cheapest_audit(bytes(symbols))
    return {
        "gaps": greatest - least + 1 - distinct if distinct else 0,
        "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
        "illegal": sum(pair not in legal for pair in zip(initials, initials[1:])), "cost": cost, "audit": audit,
    }


def _auditor(id_type: pa.DataType) -> Callable:
    schema = pa.schema([("conv_id", id_type), *zip(_FACT_NAMES, _FACT_TYPES)])

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [{"conv_id": row["conv_id"]} | _facts_of(row["slices"]) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(made, schema)

    return audit


def audits(rows: DataFrame, originals: DataFrame) -> DataFrame:
    """Faults, cost and audit of the conversations of `originals`, whose rows are now `rows`.

    `rows` are as `in_order` gives them; a conversation without rows has zeros.
    """
    id_sql = originals.schema["conv_id"].dataType.simpleString()
    id_type = to_arrow_type(originals.schema["conv_id"].dataType)
    keys = ["conv_id", "turn", "role", "digest"]
    ordered = _symbols(rows).repartitionByRange(*keys).sortWithinPartitions(*keys)
    cut = ordered.select("conv_id", "turn", "n", "one", "more").mapInArrow(
        _cutter(id_type),
        f"conv_id {id_sql}, part int, symbols binary, turns bigint, first bigint, last bigint",
    )
    sliced = cut.select("conv_id", F.struct("part", "symbols", "turns", "first", "last").alias("slice"))
    names = originals.select("conv_id").distinct().withColumn("slice", F.lit(None).cast(sliced.schema["slice"].dataType))
    grouped = sliced.unionByName(names).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("slice")).alias("slices")
    )
    return grouped.mapInArrow(_auditor(id_type), f"conv_id {id_sql}, {FACTS}")


def _beside(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """The facts of each conversation, followed by its rows in order."""
    heads = facts.select("conv_id", F.struct(*_FACT_NAMES).alias("facts"))
    every = heads.withColumn("kind", F.lit(0)).unionByName(
        rows.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    order = ["conv_id", "kind", "turn", "role", "digest"]
    return every.repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "facts", "turn", "role", "text"
    )


def _role_after(state: int, role: str) -> tuple[str, int]:
    """The role an edited row gets, and the state after it."""
    initial = NEXT[state][-1]
    return ROLES[initial], REACHED[initial]


def replay(rows: Iterator[dict]) -> Iterator[tuple[dict, str | None, int | None, str | None, str | None]]:
    """Edits as they follow from the audits: head, letter, turn, role, text.

    `rows` are those of `_beside`. A head comes once with no letter, before its edits.
    """
    head, audit, at, state = None, "", 0, NOTHING

    def inserts():
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at += 1
            role, state = _role_after(state, "")
            yield head, "I", None, role, ""

    for row in rows:
        if row["facts"] is not None:
            if head is not None:
                yield from inserts()
            head, audit, at, state = row, row["facts"]["audit"], 0, NOTHING
            yield head, None, None, None, None
            continue
        yield from inserts()
        letter, role = audit[at], row["role"]
        at += 1
        if letter == "K":
            state = REACHED[role[0]]
        elif letter == "R":
            role, state = _role_after(state, role)
        yield head, letter, row["turn"], role, row["text"]
    if head is not None:
        yield from inserts()


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    return (row for batch in batches for row in batch.to_pylist())


def _writer(id_type: pa.DataType) -> Callable:
    schema = pa.schema(
        [("conv_id", id_type), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
         ("role", pa.string()), ("text", pa.string())]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size, place = [], 0, 0
        for head, letter, turn, role, text in replay(_rows_of(batches)):
            if letter is None:
                place = 0
            elif letter != "D":
                made.append(
                    {"conv_id": head["conv_id"], "place": place, "edit": letter, "turn": turn, "role": role, "text": text}
                )
                place, size = place + 1, size + len(text)
            if len(made) >= ROWS or size > 4 << 20:
                yield pa.RecordBatch.from_pylist(made, schema)
                made, size = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    return write


def repaired(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Messages after the edits: conv_id, place from 0, edit (K, R or I), turn, role, text."""
    id_sql = facts.schema["conv_id"].dataType.simpleString()
    write = _writer(to_arrow_type(facts.schema["conv_id"].dataType))
    return _beside(rows, facts).mapInArrow(
        write, f"conv_id {id_sql}, place bigint, edit string, turn bigint, role string, text string"
    )


def _digester(id_type: pa.DataType) -> Callable:
    schema = pa.schema(
        [("conv_id", id_type), *zip(_FACT_NAMES, _FACT_TYPES), ("repaired_sha256", pa.string())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, head, sha, none = [], None, hashlib.sha256(), True
        done = lambda: {"conv_id": head["conv_id"], **head["facts"], "repaired_sha256": sha.hexdigest()}
        for found, letter, _, role, text in replay(_rows_of(batches)):
            if letter is None:
                if head is not None:
                    made.append(done())
                head, sha, none = found, hashlib.sha256(), True
            elif letter != "D":
                sha.update(f"{'' if none else chr(10)}{role}:{text}".encode())
                none = False
            if len(made) >= ROWS:
                yield pa.RecordBatch.from_pylist(made, schema)
                made = []
        if head is not None:
            made.append(done())
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    return digest


def report(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """The facts of every conversation and the SHA-256 of its repaired `role:text` lines."""
    id_sql = facts.schema["conv_id"].dataType.simpleString()
    digest = _digester(to_arrow_type(facts.schema["conv_id"].dataType))
    return _beside(rows, facts).mapInArrow(digest, f"conv_id {id_sql}, {FACTS}, repaired_sha256 string")


def repair_damage(messages: DataFrame) -> DataFrame:
    """Damage messages and report the repair of every conversation."""
    rows = in_order(damaged(messages))
    return report(rows, audits(rows, messages))
