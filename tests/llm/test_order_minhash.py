import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyledger.llm import order_minhash
from tests.llm.samples import documents, frame, prose


def answers(spark, rows):
    return order_minhash.compare_with_edits(frame(spark, rows)).collect()


def test_edited_texts(spark):
    rows = [r for r in documents() if r[0] not in (4, 5, 6)]  # unique ids
    order = sorted(((d, t or "") for d, t, *_ in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    found = {r.doc_id: r for r in answers(spark, rows)}
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = found[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert len(found) == len(rows)


def test_repeated_rows_and_an_only_document(spark):
    found = answers(spark, documents())
    assert len(found) == len(documents())
    same = [r for r in found if r.doc_id == 6]
    assert len(same) == 2 and len({r.fingerprint for r in same}) == 1
    assert max(r.near_next for r in same) == 1.0
    one = answers(spark, [documents()[8]])[0]
    assert one.near_next == 1.0
    assert answers(spark, []) == []


def test_equal_texts_have_equal_fingerprints(spark):
    found = answers(spark, documents())
    by_text = {}
    texts = {d: t or "" for d, t, *_ in documents()}
    for r in found:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert by_text[""] == "" and by_text["tie"] != ""


def test_occurrences_are_numbered(spark):
    text = "a b c " * 50 + "d e f a b c"
    rows = order_minhash.numbered_runs(spark.createDataFrame([(1, text)], "id int, text string"), "text")
    found = [r["_h"] for r in rows.orderBy("_i").collect()]
    assert len(found) == len(set(found)) == len(text.split()) - 2
    # The n-th occurrence has the same hash wherever it stands.
    late = order_minhash.numbered_runs(spark.createDataFrame([(1, "x " + text)], "id int, text string"), "text")
    assert set(found) <= {r["_h"] for r in late.collect()}


@pytest.mark.parametrize("n", [400])
def test_order_counts(spark, n):
    """Moved blocks keep most runs, yet are less alike than a text with as many runs changed."""
    words = prose(7, n).split()
    swapped = words[n // 2 :] + words[: n // 2]
    changed = words[:-4] + ["other"] * 4
    rows = spark.createDataFrame(
        [(0, " ".join(words)), (1, " ".join(swapped)), (2, " ".join(changed))], "id int, text string"
    )
    s = {r.id: r.signature for r in order_minhash.signatures(rows, "text", ["id"]).collect()}
    alike = lambda a, b: sum(x == y for x, y in zip(s[a], s[b])) / order_minhash.COMPONENTS
    assert alike(0, 2) > 0.8 and alike(0, 1) < 0.75


def test_slices_do_not_change_the_answer(spark):
    rows = [(i * 7 % 101, prose(i, 30), None, None, 1, 1, "x") for i in range(101)]
    whole = Counter(map(tuple, answers(spark, rows)))
    docs = frame(spark, rows)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        few = Counter(map(tuple, order_minhash.compare_with_edits(docs).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert whole == few
    assert docs.agg(F.count("*")).first()[0] == 101
