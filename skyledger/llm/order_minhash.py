"""Fingerprints by order MinHash, whose likeness follows edit distance rather than shared content.

A text is its runs of K words, each numbered by how often it occurred before in the text. For each
component of the fingerprint, the smallest run under each of L hash functions is selected; the
selected runs are put in the order in which they stand in the text, and that tuple is hashed. Texts
share a component if they select the same runs in the same order.

Runs are numbered within the row: where a text repeats a run, runs are sorted with their places,
and a search among the neighbours of equal hash gives the number. Then each run is one row of an
aggregate with one minimum per hash function, combined before the shuffle, so no text and no list
of runs is shuffled for it.

The document after each one is found by window within slices of the doc_id range (cut at
quantiles); a slice also gets the first document of the next slice, so no row order over the whole
table is needed.

Defined results: a null text is empty; a text without words has the empty fingerprint, which is
like another empty one (1) and unlike any other (0); texts of fewer than K words are one run; of
equal doc_ids the order is that of a hash of their texts; a null doc_id comes first; repeated rows
are kept; an only document is its own next one; an empty table gives no rows. Other columns are not
carried. In texts of more than 16 million words later places count as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.words import hashed_runs, words

K = 3
L = 2
COMPONENTS = 32
PLACE_BITS = 24
SLICES_PER_PARTITION = 4
MAX_SLICES = 1 << 14


def _occurrence(j: Column) -> Column:
    """Number of neighbours before place j of `_sorted` that have its hash, by doubling steps."""
    own = F.get("_sorted", j)["h"]

    def further(found: Column, step: Column) -> Column:
        at = j - found - step
        same = F.coalesce(F.get("_sorted", at)["h"] == own, F.lit(False))
        return F.when(same, found + step).otherwise(found)

    # A step beyond the start of the array finds null, so the same steps serve any place.
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(31))])
    near = F.coalesce(F.get("_sorted", j - 1)["h"] == own, F.lit(False))
    return F.when(near, F.aggregate(steps, F.lit(0), further)).otherwise(F.lit(0))


def numbered_runs(rows: DataFrame, text: str) -> DataFrame:
    """A row for each run of the text: `_h`, a hash of run and number, and its place `_i`.

    Texts without words have one row with nulls.
    """
    rows = rows.withColumn("_words", words(F.col(text))).drop(text)
    some = F.when(F.size("_words") > 0, F.array(F.xxhash64("_words"))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_runs", F.when(F.size("_words") >= K, hashed_runs("_words", K)).otherwise(some))
    rows = rows.drop("_words")
    repeats = F.size("_runs") > F.size(F.array_distinct("_runs"))
    pairs = F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(pairs)))

    def renamed(run: Column, j: Column) -> Column:
        n = _occurrence(j)
        return F.struct(F.when(n == 0, run["h"]).otherwise(F.xxhash64(run["h"], n)).alias("h"), run["i"].alias("i"))

    runs = F.when(F.col("_sorted").isNull(), pairs).otherwise(F.transform("_sorted", renamed))
    rows = rows.select(*[c for c in rows.columns if c not in ("_runs", "_sorted")], F.explode_outer(runs).alias("_run"))
    return rows.select("*", F.col("_run.h").alias("_h"), F.col("_run.i").alias("_i")).drop("_run")


def signatures(rows: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """The fingerprint of each row, as array `signature`, null where the text has no words.

    Rows of equal keys are taken as parts of one text, so the keys have to tell rows apart.
    """
    runs = numbered_runs(rows.select(*keys, text), text)
    last = (1 << PLACE_BITS) - 1
    place = F.least(F.col("_i").cast("bigint"), F.lit(last))

    def smallest(f: int) -> Column:
        hashed = F.shiftleft(F.xxhash64(F.lit(f), "_h"), PLACE_BITS)
        return F.min(F.when(F.col("_h").isNotNull(), hashed.bitwiseOR(place))).alias(f"_m{f}")

    least = runs.groupBy(*keys).agg(*[smallest(f) for f in range(COMPONENTS * L)])
    components = []
    for c in range(COMPONENTS):
        selected = [
            F.struct(F.col(f"_m{f}").bitwiseAND(last).alias("at"), F.shiftright(f"_m{f}", PLACE_BITS).alias("h"))
            for f in range(c * L, (c + 1) * L)
        ]
        in_order = F.transform(F.sort_array(F.array(*selected)), lambda x: x["h"])
        components.append(F.xxhash64(in_order))
    return least.select(*keys, F.when(F.col("_m0").isNotNull(), F.array(*components)).alias("signature"))


def fingerprint(signature: Column) -> Column:
    """The signature as text."""
    parts = F.transform(signature, lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.coalesce(F.array_join(parts, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    both_empty = (a.isNull() & b.isNull()).cast("double")
    return F.coalesce(equal / F.lit(float(COMPONENTS)), both_empty)


def _slice_of(bounds: list[int]) -> Column:
    """How many bounds are below the doc_id, by binary search; 0 for null."""
    table = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(bounds)).bit_length()))])

    def further(found: Column, step: Column) -> Column:
        below = F.coalesce(F.get(table, found + step - 1) < F.col("doc_id"), F.lit(False))
        return F.when(below, found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), further)


def sliced(documents: DataFrame) -> DataFrame:
    """doc_id, text and slice; the first document of each slice is also in the slice before it,
    where it is marked `_guest` and comes last. The last slice has the first document of all.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = min(MAX_SLICES, SLICES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    quantiles = [i / n for i in range(1, n)]
    found = rows.agg(F.percentile_approx("doc_id", quantiles, 10 * n).alias("q")).first()["q"]
    own_slice = _slice_of(sorted(set(found))) if found else F.lit(0)
    rows = rows.select("*", own_slice.alias("slice"), F.xxhash64("text").alias("_tie"))
    # At most MAX_SLICES rows of three numbers.
    firsts = rows.groupBy("slice").agg(F.min(F.struct("doc_id", "_tie")).alias("first")).orderBy("slice").collect()
    guests = [(a["slice"], b["first"]["doc_id"], b["first"]["_tie"]) for a, b in zip(firsts, firsts[1:] + firsts[:1])]
    guests = spark.createDataFrame(guests, "_host int, _id bigint, _guest_tie bigint")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_guest_tie"))
    own = F.struct("slice", F.lit(False).alias("guest"))
    visit = F.struct(F.col("_host").alias("slice"), F.lit(True).alias("guest"))
    places = F.when(F.col("_host").isNull(), F.array(own)).otherwise(F.array(own, visit))
    placed = rows.join(F.broadcast(guests), same, "left").select("doc_id", "text", "_tie", F.explode(places).alias("_at"))
    return placed.select("doc_id", "text", "_tie", F.col("_at.slice").alias("slice"), F.col("_at.guest").alias("_guest"))


def edited_by_next(documents: DataFrame) -> DataFrame:
    """Each document with its edited text: its second half is overwritten from the next document.

    Has `slice` and `_nth`, its place in the slice, and the guests of `sliced`.
    """
    order = Window.partitionBy("slice").orderBy("_guest", "doc_id", "_tie")
    rows = sliced(documents).select(
        "slice", "_guest", "doc_id", "text",
        F.row_number().over(order).alias("_nth"), F.lead("text").over(order).alias("_next"),
    )
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("_next", F.lit(1), half))
    return rows.select(
        "slice", "_nth", "_guest", "doc_id", "text", n.cast("bigint").alias("n_chars"), edited.alias("edited")
    )


def compare_with_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of each document and its edited text, and their likeness."""
    rows = edited_by_next(documents)
    both = F.array(
        F.struct(F.lit(False).alias("e"), F.col("text").alias("t")),
        F.struct(F.lit(True).alias("e"), F.coalesce("edited", F.lit("")).alias("t")),
    )
    digest = F.unhex(F.sha2(F.coalesce("edited", F.lit("")), 256)).alias("_sha")
    rows = rows.select("slice", "_nth", "_guest", "doc_id", "n_chars", digest, F.explode(both).alias("_kind"))
    rows = rows.select("*", F.col("_kind.e").alias("_edited"), F.col("_kind.t").alias("_text")).drop("_kind")
    keys = ["slice", "_nth", "_guest", "doc_id", "n_chars", "_sha"]
    made = signatures(rows, "_text", [*keys, "_edited"])
    # Two rows per document become one, beside the signature of the document after it.
    made = made.groupBy(*keys).agg(
        F.first(F.when(~F.col("_edited"), F.col("signature")), ignorenulls=True).alias("own"),
        F.first(F.when(F.col("_edited"), F.col("signature")), ignorenulls=True).alias("edited"),
    )
    order = Window.partitionBy("slice").orderBy("_nth")
    made = made.withColumn("next", F.lead("own").over(order)).where(~F.col("_guest"))
    return made.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("_sha")).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
