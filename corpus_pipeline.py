"""A whole corpus, from raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents. When a
stage begins, what the one before it left in the shared folder is deleted, as its output is written
by then.

Null texts are empty; they have no language and go with the first stage. Repeated rows are near
copies, of which one stays. An empty table gives no rows. Where no document has a language label,
nothing can be learned, and the first stage keeps all documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import chosen_path, language, mixing, packing, secret_scan
from skyledger.llm.queries import language_model
from skyledger.llm.storage import ready, scratch_folders, stored
from skyledger.operators.shared import remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LEAST_SCORE = 0.5  # a text whose language is no likelier than this is rejected


_left: dict[str, set[str]] = {}  # folders of intermediate tables, by the stage that made them


def _tidy(follows: str | None) -> Callable[[Stage], Stage]:
    """A stage that begins by deleting what the stage it follows has left."""

    def make(stage: Stage) -> Stage:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for folder in _left.pop(follows, ()) if follows else ():
                remove(spark, folder)
            before = scratch_folders(spark)
            found = stage(spark, docs, sf_dir)
            _left[stage.__name__] = scratch_folders(spark) - before
            return found

        return run_stage

    return make


@_tidy(None)
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter, or without a likely one, go."""
    ready(spark)
    model = language_model(docs)
    if not model.languages:
        return docs
    found = language.predict(docs.select(F.struct("*").alias("row"), "text"), model)
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.where(sure).select("row.*")


@_tidy("identify_language")
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each connected group with shingle similarity of 0.8 or more.

    A document that is like no kept one goes with the chain of similar ones it belongs to.
    """
    ready(spark)
    return chosen_path.first_of_groups(docs)


@_tidy("drop_near_copies")
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return secret_scan.redact(docs)


@_tidy("mask_secrets")
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and with as much of their text, as the mix takes them."""
    return mixing.mixed_documents(docs)


@_tidy("mix_sources")
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids: one row per piece of a document."""
    ready(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

ORACLE_SQL = None  # language models, similarity joins and tokenizers have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents table to packed sequences."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


pipeline = run
