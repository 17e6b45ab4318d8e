import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import language
from skyledger.llm.queries import held_out, language_model
from tests.llm.samples import SCHEMA, documents, frame


def test_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language.predict(docs.where(held_out()), language_model(docs))
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 20 and right >= 0.97 * n


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the river and the stone", "en"), ("der Fluss und die Brücke", "de"),
            ("le fleuve et la pierre", "fr"), ("the", None), (None, "fr"), ("the fog", "en")]
    return language.fit(spark.createDataFrame(rows, "text string, lang string"), least=1)


def judged(scorer, *texts):
    return list(zip(*scorer.score(pa.array(texts, pa.string()))))


def test_words_first_then_shorter_and_shorter_grams(model):
    scorer = language.Scorer(model)
    assert scorer.languages == ["de", "en", "fr"]
    found = judged(scorer, "The river", "Brücken", None, "pierres fleuves", "qqq xyzzy", "")
    assert [x[0] for x in found][:4] == ["en", "de", "und", "fr"]
    assert found[4][1] < 0.9 and found[5] == ("und", 0.0)
    assert judged(scorer, None, "", "12 34 ²", "… !!") == [("und", 0.0)] * 4
    assert judged(scorer) == []


def test_equals_scoring_word_by_word(spark, sf_dir):
    """The definition in plain Python: known words, else the mean of the longest known n-grams."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fitted = language_model(docs)
    texts = [r.text for r in docs.select("text").collect()]

    def weight(word):
        if word in fitted.rows:
            return fitted.weights[fitted.rows[word]]
        for n in (4, 3, 2, 1):
            marked = f"<{word}>" if n > 1 else word
            grams = [f"{n}:{marked[i : i + n]}" for i in range(len(marked) - n + 1)]
            known = [fitted.weights[fitted.rows[g]] for g in grams if g in fitted.rows]
            if known:
                return np.mean(known, 0)
        return np.zeros(len(fitted.languages))

    found = judged(language.Scorer(fitted), *texts)
    for text, (name, score) in zip(texts, found):
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        sums = sum((weight(w) for w in words), np.zeros(len(fitted.languages)))
        if words:
            share = np.exp(sums - sums.max())
            assert name == fitted.languages[int(share.argmax())]
            assert abs(score - share.max() / share.sum()) < 1e-9


def test_null_ids_are_not_held_out_and_equal_sums_go_to_the_first(spark):
    rows = [(None, "aa"), (5, "aa"), (5, "bb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert docs.where(held_out()).count() <= 2 and docs.where(held_out().isNull()).count() == 0
    twins = language.fit(spark.createDataFrame([("x y", "b"), ("x y", "a")], "text string, lang string"), least=1)
    assert judged(language.Scorer(twins), "x") == [("a", 0.5)]


def test_odd_documents_keep_their_columns(spark, model):
    found = language.predict(frame(spark).withColumn("score", F.lit("x")), model)
    assert found.columns == [c.split()[0] for c in SCHEMA.split(", ")] + ["lang_pred", "score"]
    rows = found.collect()
    assert len(rows) == len(documents())
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_to_learn_from(spark):
    empty = language.fit(frame(spark, []).select("text", "lang"))
    assert {r.lang_pred for r in language.predict(frame(spark), empty).collect()} == {"und"}
    assert language.predict(frame(spark, []), empty).collect() == []


def test_a_sample_is_bounded(spark):
    rows = spark.range(4000).select(F.col("id").cast("string").alias("text"), F.lit("aa").alias("lang"))
    assert 350 < language.sample(rows, 500).count() < 650 and language.sample(rows).count() == 4000
