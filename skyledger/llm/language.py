"""Language of a text by known words, and by character n-grams for words not known.

A word that occurred in training scores by its log frequency in each language. Any other word
falls back to its n-grams of four characters, and to three, two and one where none of those
occurred (a word is taken with a mark at each end). A text has the language with the highest sum;
its score is that language's share when all sums are turned into probabilities.

Training counts on Spark and keeps the words and n-grams that occur LEAST_COUNT times or more. It is
fitted on a bounded sample, at most SAMPLE_ROWS labelled rows per language, drawn by a hash of the
text, which bounds the model too.

A word is a run of letters. Texts are lowered, cut and numbered a batch at a time, each distinct word
is looked up once, and the weights of a text are summed over its numbers.

Defined results: a null text, or one without a letter, is `und` with score 0; a null doc_id is not
held out; rows without a
language are no training rows; without any training row every text is `und`; equal sums give the
language that sorts first; repeated rows count as often as they occur. Other columns of the
documents are kept, `lang_pred` and `score` are replaced where they exist.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from skyledger.llm.storage import release_memory, stored, with_columns_of

SAMPLE_ROWS = 20_000  # labelled rows per language
LEAST_COUNT = 3  # occurrences in the sample; rarer words fall back to n-grams
LONGEST_GRAM = 4
REMEMBERED = 150_000  # scored words kept per Python worker
UNKNOWN = "und"
_OTHER = r"[^\p{L}]+"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case words of all texts, and the text each stands in. Null has none."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    parts = pc.split_pattern(pc.replace_substring_regex(lowered, _OTHER, " "), " ")
    text_of = pc.list_parent_indices(parts).to_numpy()
    words = parts.flatten()
    there = pc.binary_length(words).to_numpy() > 0
    return words.filter(pa.array(there)), text_of[there]


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies: a row of `weights` per word or n-gram, a column per language."""

    languages: list[str]
    terms: pa.Array  # words as they are; n-grams behind their length and a colon
    weights: np.ndarray

    @cached_property
    def rows(self) -> dict[str, int]:
        """Row of each term. It is made where it is needed and does not travel."""
        return {t: i for i, t in enumerate(self.terms.to_pylist())}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "rows"}


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, text_of = words_of(batch.column("text"))
        langs, coded = batch.column("lang").dictionary_encode(), words.dictionary_encode()
        lang_of = langs.indices.to_numpy().astype(np.int64)[text_of]
        found, n = np.unique(
            lang_of * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True
        )
        if len(found):
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(found // len(coded.dictionary))),
                 coded.dictionary.take(pa.array(found % len(coded.dictionary))).cast(pa.string()),
                 pa.array(n.astype(np.int64))],
                names=["lang", "term", "n"],
            )


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for row in batch.to_pylist():
            for n in range(1, LONGEST_GRAM + 1):
                for gram in grams_of(row["term"], n):
                    found[row["lang"], f"{n}:{gram}"] += row["n"]
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([found[k] for k in keys], pa.int64())],
            names=["lang", "term", "n"],
        )


def sample(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most about `rows` labelled rows of each language, by a hash of the text."""
    counted = labelled.where(F.col("lang").isNotNull()).groupBy("lang").count().collect()
    if not counted:
        return labelled
    shares = [F.lit(x) for r in counted for x in (r["lang"], min(1.0, rows / r["count"]))]
    share = F.create_map(*shares)
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return labelled.where(place < F.element_at(share, F.col("lang")))


def fit(labelled: DataFrame, least: int = LEAST_COUNT) -> Model:
    """Count words and n-grams of rows with `text` and a non-null `lang`, and keep the frequent."""
    rows = labelled.where(F.col("lang").isNotNull()).select("text", F.col("lang").cast("string").alias("lang"))
    schema = "lang string, term string, n bigint"
    words = rows.mapInArrow(_counts, schema).groupBy("lang", "term").agg(F.sum("n").alias("n"))
    words = stored(words, "language_words")
    grams = words.mapInArrow(_gram_counts, schema).groupBy("lang", "term").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    kept = []
    for terms in (words, grams):
        per_language = [
            F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}")
            for i, x in enumerate(languages)
        ]
        by_term = terms.groupBy("term").agg(F.sum("n").alias("_all"), *per_language)
        # Columns, not rows: the driver holds no object per term.
        kept.append(by_term.where(F.col("_all") >= least).drop("_all").toArrow().sort_by("term"))
    found = pa.concat_tables(kept)
    counts = np.zeros((len(found), len(languages)))
    for i in range(len(languages)):
        counts[:, i] = found.column(f"n{i}").to_numpy()
    terms = found.column("term").combine_chunks()
    terms = terms if isinstance(terms, pa.Array) else pa.concat_arrays(terms.chunks)
    # Words share one sum of frequencies, n-grams of each length another.
    kinds = pc.utf8_slice_codeunits(terms, 0, 1).to_numpy(zero_copy_only=False).astype("U1")
    kinds[: len(kept[0])] = "w"
    weights = np.zeros_like(counts)
    for kind in set(kinds.tolist()):
        own = kinds == kind
        weights[own] = np.log((counts[own] + 0.5) / (counts[own].sum(0) + 0.5 * own.sum()))
    return Model(languages, terms, weights)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.languages = model.languages
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1 << 12, len(model.languages)))

    def _vector(self, word: str) -> np.ndarray:
        known = self.model.rows
        if word in known:
            return self.model.weights[known[word]]
        for n in range(LONGEST_GRAM, 0, -1):
            found = [known[g] for g in (f"{n}:{x}" for x in grams_of(word, n)) if g in known]
            if found:
                return self.model.weights[found].mean(0)
        return np.zeros(len(self.languages))

    def _row(self, word: str) -> int:
        row = self.rows.get(word)
        if row is None:
            row = self.rows[word] = len(self.rows)
            if row == len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.table[row] = self._vector(word)
        return row

    def score(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        if len(self.rows) > REMEMBERED:
            self.rows.clear()
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        words, text_of = words_of(texts)
        if not self.languages or not len(words):
            return names, scores
        coded = words.dictionary_encode()
        known = np.fromiter(map(self._row, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        places = known[coded.indices.to_numpy()]
        starts = np.flatnonzero(np.diff(text_of, prepend=-1))
        # One language at a time, so that a batch needs a number per word and no more.
        sums = np.stack([np.add.reduceat(column[places], starts) for column in self.table.T], 1)
        likely = np.exp(sums - sums.max(1, keepdims=True))
        best = likely.argmax(1)
        share = likely[np.arange(len(best)), best] / likely.sum(1)
        for text, language, score in zip(text_of[starts].tolist(), best.tolist(), share.tolist()):
            names[text], scores[text] = self.languages[language], score
        return names, scores


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """Adds `lang_pred` and `score`, from the column `text` alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    documents = documents.drop("lang_pred", "score")
    added = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            names, scores = scorer.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )
            release_memory()

    return documents.mapInArrow(run, with_columns_of(documents, added))
