"""Text rules against plain Python on random text."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.functions.numbers import price_text, to_double
from skyledger.functions.text import slug, strip, strip_lower

ALPHABET = list("0123456789.,+-eE $x") + ["\t", "\n", "\x1c", " ", " ", "٣", "５", "Ä", "Σ", "İ", "東"]


@pytest.fixture(scope="module")
def texts(spark):
    random.seed(7)
    made = ["".join(random.choices(ALPHABET, k=random.randrange(0, 12))) for _ in range(2000)]
    frame = spark.createDataFrame(list(enumerate(made)), "i int, v string").cache()
    return made, frame


def found(frame, expression):
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_strip_lower_slug(texts):
    made, frame = texts
    assert found(frame, strip("v")) == [t.strip() for t in made]
    assert found(frame, strip_lower("v")) == [t.strip().lower() for t in made]
    assert found(frame, slug("v")) == [t.strip().lower().replace(" ", "_") for t in made]


PRICES = {
    "": None, "none": None, "1,200.50 KD": 1200.5, "-5": 5.0, "-5.5": -5.5, "+.75x": 0.75,
    "a7b8.5": 7.0, "1.2.3": 1.2, "..5": 0.5, "- 3": 3.0, ",5": 5.0, "x-0.50": -0.5, "٣": 3.0,
    "５.５": 5.5, "12.": 12.0,
}


def test_price(spark):
    frame = spark.createDataFrame(list(enumerate(PRICES)), "i int, v string")
    assert found(frame, price_text("v")) == list(PRICES.values())


def test_numbers_are_those_python_reads_too(texts):
    """Whatever counts as a number is read to the value Python reads."""
    made, frame = texts
    values = found(frame, to_double("v"))
    assert sum(v is not None for v in values) > 20
    for text, value in zip(made, values):
        if value is not None:
            assert value == float(text)


def test_whole_documents_keep_their_length(spark, sf_dir):
    """No text is cut: stripping a document only removes whitespace at its ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for row in docs.select("text", strip("text").alias("s"), F.length("text").alias("n")).collect():
        assert row.s == row.text.strip() and row.n == len(row.text)
