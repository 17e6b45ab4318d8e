import re
from collections import Counter, defaultdict
from itertools import cycle

import pytest
from pyspark.sql import functions as F

from skyledger.llm import mixing
from tests.llm.samples import SCHEMA, documents, frame, prose


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Water level by repeated sharing out."""
    weight = dict(zip(sorted(sizes, key=lambda k: (k is None, k or "")), cycle((5, 2, 1))))
    total, full, left = 1.5 * sum(sizes.values()), {}, set(sizes)
    while left:
        share = total / sum(weight[k] for k in left)
        over = [k for k in left if share * weight[k] > 2 * sizes[k]]
        if not over:
            return full | {k: share * weight[k] for k in left}
        for k in over:
            full[k] = 2 * sizes[k]
            total -= full[k]
            left.remove(k)
    return full


def corpus():
    rows = []
    for source, n in (("a", 3), ("b", 40), ("c", 12), (None, 20), ("hot", 90), ("z", 2)):
        rows += [(len(rows) + i, prose(i, 20 + 13 * (i % 17)), "x", source, 1, 1, "x") for i in range(n)]
    return rows


@pytest.mark.parametrize("rows", [corpus(), documents()], ids=["corpus", "odd"])
def test_takes_follow_targets(spark, rows):
    found = mixing.mix(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((r[0], words(r[1])) for r in rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    for source, wanted in targets(sizes).items():
        assert abs(target[source] - wanted) < 1e-6 * max(1, wanted)
        assert abs(taken[source] - wanted) <= 2 * mixing.BLOCK_WORDS
    again = mixing.mix(frame(spark, rows[::-1]))
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, found), key=repr)


@pytest.mark.parametrize("n", [1, 2, 97, 1000])
def test_every_pass_is_a_permutation(spark, n):
    slots = spark.range(3 * n).select(F.col("id").alias("j"), F.lit("k").alias("key"), F.lit(n).cast("bigint").alias("blocks"))
    found = mixing._permuted(slots, 1).groupBy("pass").agg(F.countDistinct("block"), F.min("block"), F.max("block"))
    assert {tuple(r)[1:] for r in found.collect()} == {(n, 0, n - 1)}


def test_documents_of_the_mix(spark):
    docs = frame(spark, corpus())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += words(r.text)
        assert r.n_chars == len(r.text)
    assert +Counter({r.doc_id: r.taken for r in mixing.mix(docs).collect()}) == taken


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.mixed_documents(frame(spark, [])).collect() == []
