import itertools
import random
import re

import pytest

from skyledger.llm import quotations

SCHEMA = "conv_id bigint, turn int, role string, text string, body string"
MAIL = [
    (1, 0, "user", "Hello there.\nShall we meet on Monday?\n\nBest, Ann", "clash"),
    (1, 1, "assistant", "On 3 May Ann wrote:\n> shall we  meet on Monday?\nYes, at ten.", None),
    (1, 2, "user", "And the budget?", None),
    (1, 3, "assistant", "> > Shall we meet on Monday?\n> Yes, at ten.\n\nTen it is.", None),
    (1, 4, "user", ">And the budget?\nStill open.\n> never written by anyone", None),
    (2, 0, "user", "> And the budget?\nOther talk.", None),
    (3, None, None, None, None),
    (None, 0, "user", "Yes, at ten.", None),
    (4, 0, "user", "Same.", None),
    (4, 0, "user", "Same.", None),
]


def test_replies_follow_quotes(spark):
    found = quotations.link_quotations(spark.createDataFrame(MAIL, SCHEMA)).collect()
    assert len(found) == len(MAIL)
    by = {(r.conv_id, r.turn): r for r in found}
    assert by[1, 1].reply_to == 0 and by[1, 1].body == "Yes, at ten."
    # The outermost quote decides, not the older one within it.
    assert by[1, 3].reply_to == 1 and by[1, 3].body == "Ten it is." and by[1, 3].n_quotes == 2
    assert by[1, 4].reply_to == 2 and by[1, 4].n_linked == 1 and by[1, 4].n_quotes == 2
    assert [by[1, t].thread for t in range(5)] == [0, 0, 2, 0, 2]
    assert by[2, 0].reply_to is None and by[2, 0].body == "Other talk." and by[2, 0].thread == 0
    assert by[3, None].body == "" and by[3, None].thread is None
    assert by[1, 0].body.startswith("Hello") and by[1, 1].formatted == "<|assistant|>\nYes, at ten.\n"


def test_reply_order(spark):
    ordered = quotations.in_reply_order(
        quotations.link_quotations(spark.createDataFrame(MAIL, SCHEMA))
    ).collect()
    assert [r.turn for r in ordered if r.conv_id == 1] == [0, 1, 3, 2, 4]


@pytest.mark.parametrize("depth", [1, 2, 9])
def test_long_chains_end_at_their_first_message(spark, depth):
    rows = [(7, 0, "user", "line 0", None)]
    rows += [(7, t, "user", f"> line {t - 1}\nline {t}", None) for t in range(1, depth + 1)]
    found = quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.thread for r in found} == {0}
    assert all(r.reply_to == r.turn - 1 for r in found if r.turn)


def test_empty_and_very_long(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quotations.link_quotations(empty).collect() == []
    lines = "\n".join(f"> quoted {i}" if i % 2 else f"own {i}" for i in range(4000))
    rows = [(1, 0, "user", "quoted 1", None), (1, 1, "user", lines, None)]
    found = {r.turn: r for r in quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1].n_quotes == 2000 and found[1].reply_to == 0


def test_paragraphs_of_a_passage_with_new_line_breaks(spark):
    rows = [
        (1, 0, "user", "First part\nof the plan.\n\nSecond part\nof the plan.\n\nThird part\nof it.", None),
        (1, 1, "user", "Other talk.", None),
        (1, 2, "user", "> First part of\n> the plan.\n>\n> Second part of\n> the plan.\nAgreed.", None),
    ]
    found = {r.turn: r for r in quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[2].reply_to == 0 and found[2].thread == 0 and found[2].n_quotes == found[2].n_linked == 1


def test_quotes_that_link_to_nothing_are_kept(spark):
    text = "x > y\n>>> import os\n> \n\nprint\n> one\n> two\n> Same."
    rows = [(1, 0, "user", "Same.", None), (1, 1, "user", text, None), (1, 2, "user", "> Same.", None)]
    found = {r.turn: r for r in quotations.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1].body == "x > y\n\nprint" and found[1].unlinked == ["import os"]
    assert found[1].n_quotes == 2 and found[1].n_linked == 1 and found[1].reply_to == 0
    assert found[0].unlinked == found[2].unlinked == []


def by_hand(messages):
    """Replies by plain loops: passages before paragraphs before lines, of the outermost level."""

    def norm(t):
        return re.sub(r"[\s>]+", " ", t.lower()).strip()

    def split(text):
        lines = []
        for line in re.split("\r?\n", text):
            marks = re.match(r"(?:[ \t]*>)*", line).group()
            lines.append((marks.count(">"), re.sub(r"^(?:[ \t]*>)+[ \t]?", "", line)))
        return lines

    first = {}
    for conv, turn, text in sorted(messages):
        own = "\n".join(c for level, c in split(text) if level == 0)
        own = re.sub(r"\n\s*\n+", "\n\n", re.sub(r"\A\s+|\s+\Z", "", own))
        for piece in {own, *own.split("\n\n"), *own.split("\n")}:
            if norm(piece):
                first.setdefault((conv, norm(piece)), turn)
    out = {}
    for conv, turn, text in messages:
        best = None
        for level, group in itertools.groupby(split(text), key=lambda x: x[0]):
            lines = [c for _, c in group]
            if not level:
                continue
            parts = re.split(r"\n[\s>]*\n", "\n".join(lines))
            forms = [(2, " ".join(lines)), *((1, p) for p in parts if len(parts) > 1), *((0, c) for c in lines)]
            found = [(kind, first[conv, norm(t)]) for kind, t in forms if first.get((conv, norm(t)), turn) < turn]
            if found:
                kind, origin = max(found)
                best = max(best or (-99, 0, 0), (-level, kind, origin))
        out[conv, turn] = best and best[2]
    return out


def test_equals_plain_loops(spark):
    rnd = random.Random(1)
    lines = ["Yes, at ten.", "And the budget?", "a b", "c", "", "Thanks"]
    messages = []
    for conv in range(25):
        for turn in range(6):
            text = "\n".join(rnd.choice(["", "", "> ", ">> "]) + rnd.choice(lines) for _ in range(rnd.randrange(1, 7)))
            messages.append((conv, turn, text))
    frame = spark.createDataFrame([(c, t, "user", x, None) for c, t, x in messages], SCHEMA)
    found = {(r.conv_id, r.turn): r.reply_to for r in quotations.link_quotations(frame).collect()}
    assert found == by_hand(messages)
