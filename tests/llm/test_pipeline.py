import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm.storage import scratch_folders, stored
from skyledger.llm.tokens import ID
from tests.llm import samples


def test_stages_hand_documents_on(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        counts.append(docs.count())
        assert (docs.columns == columns) == (i + 1 < len(corpus_pipeline.STAGES))
    known, alone, masked, mixed, pieces = counts
    assert known >= alone == masked and 0 < mixed <= 2 * masked and pieces >= mixed
    again = corpus_pipeline.run(spark, sf_dir)
    total = lambda df: sum(len(np.frombuffer(r.ids, ID)) for r in df.select("ids").collect())
    assert total(again) == total(docs)


def all_stages(spark, docs, folder):
    """Row counts of every stage, run as they are to be: each written and read again."""
    counts = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, "")
        assert i == len(corpus_pipeline.STAGES) - 1 or found.columns == docs.columns
        found.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        counts.append(docs.count())
    return counts


def test_odd_rows(spark, tmp_path):
    rows = samples.documents()
    known, alone, masked, *_ = all_stages(spark, samples.frame(spark), str(tmp_path))
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert known <= len(lettered) and 0 < alone == masked <= len({r[1] for r in lettered})


def test_empty_table(spark, tmp_path):
    assert all_stages(spark, samples.frame(spark, []), str(tmp_path)) == [0] * 5


def test_documents_stay_where_nothing_can_be_learned(spark):
    docs = samples.frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, docs, "").count() == docs.count()


def test_a_stage_deletes_what_the_one_before_left(spark):
    @corpus_pipeline._tidy(None)
    def first(spark, docs, sf_dir):
        return stored(docs, "of_the_first")

    @corpus_pipeline._tidy("first")
    def second(spark, docs, sf_dir):
        return stored(docs, "of_the_second")

    before = scratch_folders(spark)
    assert first(spark, spark.range(3), "").count() == 3
    left = scratch_folders(spark) - before
    assert second(spark, spark.range(4), "").count() == 4
    assert len(left) == 1 and not left & scratch_folders(spark)
