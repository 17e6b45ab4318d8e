import random
import re

import pytest

from skyledger.llm import chosen_path
from tests.llm.samples import SCHEMA, WORDS, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(text or "")
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """Links and smallest id of the group of each id, by comparing all pairs."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    links = [0] * len(sets)
    group = list(range(len(sets)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                group[max(x, y)] = min(x, y)
    ids = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            ids[root(i)] = min(doc_id, ids.get(root(i), doc_id))
    return sorted(
        ((d, ids.get(root(i)), links[i]) for i, (d, _) in enumerate(sets)), key=repr
    )


def answer(df):
    return sorted(((r.doc_id, r.class_id, r.links) for r in df.collect()), key=repr)


def test_odd_documents(spark):
    assert answer(chosen_path.similar_groups(frame(spark))) == brute(documents())


def near_copies(n, words, changes, seed=3):
    """Copies of one text with some words changed, among unrelated texts that share a passage."""
    rnd = random.Random(seed)
    base = [rnd.choice(WORDS) + str(rnd.randrange(500)) for _ in range(words)]
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rnd.randrange(changes)):
            own[rnd.randrange(words)] = f"new{rnd.randrange(10**6)}"
        rows.append((i, " ".join(own), None, None, None, 1, "x"))
    for i in range(n, n + n // 4):
        other = " ".join(rnd.choice(WORDS) + str(rnd.randrange(500)) for _ in range(words))
        rows.append((i, f"{other} {passage}", None, None, None, 1, "x"))
    return rows


@pytest.mark.parametrize("small, block", [(chosen_path.SMALL, chosen_path.BLOCK), (8, 32)])
def test_many_near_copies_lose_no_link(spark, monkeypatch, small, block):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "BLOCK", block)
    rows = near_copies(160, 120, 5)
    assert answer(chosen_path.similar_groups(frame(spark, rows))) == brute(rows)


def test_runs_reach_the_recall():
    q = chosen_path.part_probability(0.8)
    assert abs(q - 0.0625) < 1e-6
    assert q ** chosen_path.runs_for(0.9999) <= 1e-4 + 1e-9


def test_chains_are_one_group(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 90)] + [(200, 205)], "cls bigint, beside bigint")
    labels = {r.cls: r.label for r in chosen_path.connected(edges).collect()}
    assert {labels[i] for i in range(91)} == {0} and labels[205] == 200


def test_one_of_each_group_stays(spark):
    rows = near_copies(20, 120, 3) + near_copies(20, 120, 1)[:5]
    kept = chosen_path.first_of_groups(frame(spark, rows))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    ids = [r.doc_id for r in kept.collect()]
    assert sum(i < 20 for i in ids) == 1 and sorted(i for i in ids if i >= 20) == [20, 21, 22, 23, 24]
    assert chosen_path.first_of_groups(frame(spark, [])).collect() == []
