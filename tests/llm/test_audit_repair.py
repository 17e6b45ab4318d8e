import hashlib
import random
import re
import zlib

import duckdb
import pytest

from skyledger.llm import audit_repair as a
from skyledger.llm.audit_sql import REPAIR_SQL
from skyledger.llm.queries import QUERIES
from tests.compare import difference
from tests.conftest import rows

SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, n int"
SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def damage(messages):
    for conv_id, turn, role, text in messages:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv_id, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)


def faults(conversation):
    seen, out = set(), []
    for _, _, role, text in conversation:
        kind = "fine"
        if not text.strip(SPACE):
            kind = "blank"
        elif (role, text) in seen:
            kind = "duplicate"
        elif text.rstrip(SPACE)[-1] not in ".!?":
            kind = "truncated"
        seen.add((role, text))
        out.append(kind)
    return out


def every_repair(conversation, kinds, most_inserts):
    """All edit sequences with legal results: cost, audit, repaired rows."""
    found = []

    def go(i, cost, audit, kept, inserts):
        if i == len(conversation) and LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in kept)):
            found.append((cost, audit, kept))
        if inserts < most_inserts:
            for role in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*kept, (role, "")], inserts + 1)
        if i < len(conversation):
            role, text = conversation[i][2:]
            go(i + 1, cost + 3, audit + "D", kept, inserts)
            if kinds[i] in ("fine", "truncated"):
                more = kinds[i] == "truncated"
                go(i + 1, cost + more, audit + "K", [*kept, (role, text)], inserts)
                for other in ("user", "assistant"):
                    go(i + 1, cost + more + 2, audit + "R", [*kept, (other, text)], inserts)

    go(0, 0, "", [], 0)
    return min(found)


def by_hand(messages, most_inserts=4):
    conversations = {m[0]: [] for m in messages}
    for row in damage(messages):
        conversations[row[0]].append(row)
    out = []
    for conv_id, found in conversations.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        kinds = faults(found)
        turns = [r[1] for r in found if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = zip(found, found[1:])
        illegal = sum(p[2][:1] + q[2][:1] not in ("su", "ua", "au") for p, q in pairs)
        cost, audit, kept = every_repair(found, kinds, most_inserts)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append(
            (conv_id, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
             illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def sample(seed, n, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why?", "é.", None, "a b.  "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    out = []
    for conv_id in [*range(n), None]:
        for i in range(rnd.randrange(1, longest)):
            out.append((conv_id, rnd.choice([i, i, i, i + 1, i + 3, None]), rnd.choice(roles), rnd.choice(texts)))
    return out


def frame(spark, messages):
    return spark.createDataFrame([(*m, "x", 1) for m in messages], SCHEMA).repartition(3)


def test_equals_trying_all_repairs(spark):
    messages = sample(1, 120, 5)
    assert rows(a.repair_damage(frame(spark, messages))) == by_hand(messages)


def test_sql_equals_trying_all_repairs():
    messages = sample(4, 60, 5)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", messages)
    assert sorted(con.execute(REPAIR_SQL).fetchall(), key=repr) == by_hand(messages)


def test_query_equals_sql(spark, con, sf_dir):
    assert difference(QUERIES["op12_audit_repair"](spark, sf_dir), con, REPAIR_SQL) == ""


def test_conversation_cut_into_slices(spark):
    messages = sample(2, 3, 6)
    sliced = a.in_order(a.damaged(frame(spark, messages)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts = a.audits(sliced, frame(spark, messages))
        assert rows(a.report(sliced, facts)) == by_hand(messages)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_rows_have_the_reported_digest(spark):
    messages = sample(3, 40, 6)
    original = frame(spark, messages)
    placed = a.in_order(a.damaged(original))
    facts = a.audits(placed, original)
    texts = {r[0]: [] for r in messages}
    for r in a.repaired(placed, facts).orderBy("place").collect():
        texts[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in a.report(placed, facts).collect():
        text = "\n".join(texts[r["conv_id"]])
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def least_by_strings(symbols):
    """The same program with whole strings in place of nodes."""
    best = {a.NOTHING: (0, "")}

    def close(at):
        for _ in range(2):
            for state in list(at):
                to = a.REACHED[a.NEXT[state][-1]]
                at[to] = min(at.get(to, (1 << 60, "")), (at[state][0] + 2, at[state][1] + "I"))

    close(best)
    for s in symbols:
        role, fault, after = "sua?"[s >> 2], s & 3, {}
        for state, (cost, text) in best.items():
            options = [(state, cost + 3, "D")]
            if fault < a.DUPLICATE:
                options.append((a.REACHED[a.NEXT[state][-1]], cost + 2 + fault, "R"))
                if role in a.NEXT[state]:
                    options.append((a.REACHED[role], cost + fault, "K"))
            for to, c, letter in options:
                after[to] = min(after.get(to, (1 << 60, "")), (c, text + letter))
        close(after)
        best = after
    return min(best[s] for s in a.ENDS if s in best)


@pytest.mark.parametrize("length", [0, 1, 7, 60, 400])
def test_nodes_equal_strings(length):
    rnd = random.Random(length)
    for _ in range(40):
        symbols = bytes(rnd.choice([0, 4, 8, 12]) + rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(length))
        assert a.cheapest_audit(symbols) == least_by_strings(symbols)


def test_order_of_strings_even_if_all_hashes_collide(monkeypatch):
    rnd = random.Random(5)
    for modulus in (a.MODULUS, 1):
        monkeypatch.setattr(a, "MODULUS", modulus)
        made, known = a.Audits(), {"": 0}
        for _ in range(300):
            before = rnd.choice(sorted(known))
            text = before + rnd.choice("DIKR")
            if text not in known:
                known[text] = made.append(known[before], ord(text[-1]))
        for _ in range(3000):
            x, y = rnd.sample(sorted(known), 2)
            assert made.less(known[x], known[y]) == (x < y)
            assert made.text(known[x]) == x


def test_hot_text_and_long_conversation(spark):
    """One conversation with most rows, most of them equal, over many turns."""
    messages = [(1, t, "user", "Same.") for t in range(3000)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "x" * 300_000 + ".")]
    found = {r["conv_id"]: r for r in a.repair_damage(frame(spark, messages)).collect()}
    left = sorted((r for r in damage(messages) if r[0] == 1), key=lambda r: r[1])
    assert found[1]["duplicate"] == faults(left).count("duplicate")
    assert len(found[1]["audit"]) >= len(left) and found[1]["audit"].count("K") == 1


def test_empty_table(spark):
    assert rows(a.repair_damage(frame(spark, []))) == []
