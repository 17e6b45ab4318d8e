"""Mixing sources to target weights, in blocks of words drawn for output shards.

The documents of a source, one after another, are its stream of words, cut into blocks of fixed
length. The mix is a row of slots, a fixed number per output shard. Every slot draws its source by
the target weights, which makes the counts of a shard multinomial; draws beyond the number of slots
that a source is to get are passed on to the sources that came out short. The j-th slot of a source
takes block p(j) for a pseudorandom permutation p of the source's blocks, a new one for each pass.
So no block is taken more than one time oftener than another of its source.

Targets stop at MAX_REPEATS times a source's size; the excess is shared out again by weight. In the
order of sizes by weight, the sources that are full come first, so one pass over running sums finds
the level at which the others stop.

Rows of a source are placed by running sums within salts (hash of doc_id and size), so one source
may hold most rows; the tables with a row per source, or per source and salt, are small.

Defined results: a null text has size 0 and takes 0; a null source is a source of its own, last in
order; of rows with equal doc_id the smaller size comes first; repeated rows are placed one after
another; sources of size 0 have target 0; an empty table gives no rows. Further columns are not
carried. Reruns with the same seed agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.storage import stored
from skyledger.llm.words import word_count, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
SALTS = 256
ROUNDS = 10
SEED = 20
BUCKETS = 1024


def _key(source: str = "source") -> Column:
    """The source as a key that is never null."""
    return F.when(F.col(source).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source)))


def _before(value: str, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def placed(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, key and `start`, the place of its first word in the source's stream.

    On shared storage, as both the targets and the blocks are made of it.
    """
    salt = F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS))
    row = [c for c in ("_id",) if c in documents.columns]  # a key of the rows, where they have one
    sizes = documents.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"), *row,
    )
    sizes = stored(sizes.select("*", _key().alias("key"), salt.alias("salt")), "mix_sizes")
    cells = sizes.groupBy("key", "salt").agg(F.sum("size").alias("cell_size"))
    cells = cells.select("key", "salt", _before("cell_size", Window.partitionBy("key").orderBy("salt")).alias("base"))
    own = Window.partitionBy("key", "salt").orderBy("doc_id", "size", *row)
    start = F.col("base") + _before("size", own)
    rows = sizes.join(cells, ["key", "salt"])
    return stored(rows.select("doc_id", "source", "size", "key", start.alias("start"), *row), "mix_placed")


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: key, source_size, target, number of blocks and of slots."""
    sources = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    sources = sources.withColumn("weight", F.get(weights, F.pmod(rank, F.lit(len(WEIGHTS)))))
    most = F.col("source_size") * F.lit(float(MAX_REPEATS))
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filling = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "key")
    sources = sources.withColumn("most", most)
    # If all sources before this one are full, the others stop at this many words per weight.
    rest = F.lit(SHARE) * F.sum("source_size").over(every) - _before("most", filling)
    weight_left = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    sources = sources.withColumn("level", rest / weight_left)
    stops = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "key", "level"))).over(every)
    level = F.coalesce(stops["level"], F.lit(float("inf")))
    sources = sources.withColumn("target", F.least(F.col("most"), level * F.col("weight")))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS)
    sources = sources.withColumn("blocks", blocks)
    slots = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size")))
    sources = sources.withColumn("slots", F.coalesce(slots, F.lit(0)).cast("bigint"))
    return stored(sources.select("key", "source_size", "target", "blocks", "slots"), "mix_targets")


def _ranges(table: DataFrame, count: str, width: int) -> DataFrame:
    """Ranges [lo, hi) of a row of numbers that gives each key `count` of them, by bucket."""
    at = Window.partitionBy(F.lit(0)).orderBy("key")
    table = table.where(F.col(count) > 0).withColumn("lo", _before(count, at))
    table = table.withColumn("hi", F.col("lo") + F.col(count))
    first, last = F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width)
    return table.withColumn("bucket", F.explode(F.sequence(first, last)))


def _in_range(rows: DataFrame, ranges: DataFrame, number: str, width: int) -> DataFrame:
    """Joins each row to the one range that holds its number."""
    rows = rows.withColumn("bucket", F.floor(F.col(number) / width))
    inside = (F.col(number) >= F.col("lo")) & (F.col(number) < F.col("hi"))
    return rows.join(ranges, "bucket").where(inside).drop("bucket")


def _permuted(slots: DataFrame, seed: int) -> DataFrame:
    """Adds `block`: swap-or-not rounds, each of which pairs the numbers below n and swaps some."""
    n = F.col("blocks")
    rows = slots.withColumn("pass", F.floor(F.col("j") / n))

    def swapped(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, "key", "pass"), n) - x, n)
        swap = F.xxhash64(F.lit(seed), r, "key", "pass", F.greatest(x, other)) % 2 == 0
        return F.when(swap, other).otherwise(x)

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return rows.withColumn("block", F.aggregate(rounds, F.pmod(F.col("j"), n), swapped))


def mixed_slots(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix: shard, slot, source key and block, one row per block taken."""
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).first()["n"]
    width = max(1, -(-total // BUCKETS))
    drawn = spark.range(total).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"),
        F.col("id").alias("slot"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total))).alias("ticket"),
    )
    drawn = _in_range(drawn, _ranges(sources.select("key", "slots"), "slots", width), "ticket", width)
    drawn = stored(drawn.select("shard", "slot", "key"), "mix_drawn")
    counts = stored(drawn.groupBy("shard", "key").count(), "mix_counts")
    by_shard = Window.partitionBy("key").orderBy("shard")
    earlier = counts.select("shard", "key", _before("count", by_shard).alias("earlier"))
    nth = F.row_number().over(Window.partitionBy("shard", "key").orderBy("slot")) - 1
    slots = drawn.join(earlier, ["shard", "key"]).select("shard", "slot", "key", (F.col("earlier") + nth).alias("j"))
    # What a source drew beyond its slots goes, number by number, to those that drew too few.
    got = counts.groupBy("key").agg(F.sum("count").alias("got"))
    balance = sources.join(got, "key", "left").select(
        "key", "slots", "blocks", F.coalesce("got", F.lit(0)).alias("got")
    )
    at = Window.partitionBy(F.lit(0)).orderBy("key")
    over = F.greatest(F.col("got") - F.col("slots"), F.lit(0))
    short = F.greatest(F.col("slots") - F.col("got"), F.lit(0))
    balance = balance.withColumn("over", over).withColumn("short", short).withColumn("over_base", _before("over", at))
    balance = stored(balance, "mix_balance")
    slots = slots.join(balance.select("key", "slots", "over_base"), "key")
    extra = F.col("j") >= F.col("slots")
    own = slots.where(~extra).select("shard", "slot", "key", "j")
    passed = slots.where(extra).select(
        "shard", "slot", (F.col("over_base") + F.col("j") - F.col("slots")).alias("number")
    )
    takers = _ranges(balance.select("key", "got", "short"), "short", width)
    taken = _in_range(passed, takers, "number", width)
    taken = taken.select("shard", "slot", "key", (F.col("got") + F.col("number") - F.col("lo")).alias("j"))
    slots = own.unionByName(taken).join(balance.select("key", "blocks"), "key")
    return _permuted(slots, seed).select("shard", "slot", "key", "block", "j")


def uses(slots: DataFrame) -> DataFrame:
    """How often each block is taken; those that are not have no row."""
    return slots.groupBy("key", "block").agg(F.count("*").alias("uses"))


def document_blocks(rows: DataFrame) -> DataFrame:
    """A row for each block that a placed document has words in: which of its words, and how many."""
    end = F.col("start") + F.col("size")
    first, last = F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS)
    parts = rows.where(F.col("size") > 0).withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS)
    hi = F.least(end, (F.col("block") + 1) * BLOCK_WORDS)
    return parts.withColumn("first_word", lo - F.col("start")).withColumn("n_words", hi - lo)


def taken_words(rows: DataFrame, sources: DataFrame, slots: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words that the mix takes, repeats counted."""
    parts = document_blocks(rows).join(uses(slots), ["key", "block"])
    # A place in a stream is one document's only, so it tells documents of one id apart.
    per_document = parts.groupBy("key", "start").agg(F.sum(F.col("n_words") * F.col("uses")).alias("taken"))
    filled = rows.where(F.col("size") > 0).join(per_document, ["key", "start"], "left")
    empty = rows.where(F.col("size") == 0).withColumn("taken", F.lit(0).cast("bigint"))
    found = filled.unionByName(empty).join(sources, "key")
    return found.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mix(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """What the mix takes of each document."""
    rows = placed(documents)
    sources = targets(rows)
    return taken_words(rows, sources, mixed_slots(sources, seed))


def mixed_documents(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row for each time that words of a document are taken.

    The first row has the words of all blocks that are taken, the next those taken twice, and so on;
    a row that has all words keeps the text as it is, others have their words with single spaces.
    """
    whole = stored(
        documents.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_id")),
        "mix_documents",
    )
    rows = placed(whole.select("_row.doc_id", "_row.source", "_row.text", "_id"))
    sources = targets(rows)
    parts = document_blocks(rows).join(uses(mixed_slots(sources, seed)), ["key", "block"])
    turns = parts.withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("uses"))))
    spans = turns.groupBy("_id", "_turn").agg(
        (F.sum("n_words") == F.first("size")).alias("_all"),
        F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("_spans"),
    )
    found = whole.join(spans, "_id").select("*", F.when(~F.col("_all"), words(F.col("_row.text"))).alias("_words"))
    # The array of words is read twice here, which keeps it a column of its own.
    part = F.flatten(F.transform("_spans", lambda s: F.slice("_words", s["first_word"].cast("int") + 1, s["n_words"].cast("int"))))
    text = F.when(F.col("_words").isNull(), F.col("_row.text")).otherwise(F.array_join(part, " "))
    found = found.select("_row", text.alias("_text"))
    renewed = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("bigint")}
    columns = [
        renewed[f.name].cast(f.dataType).alias(f.name) if f.name in renewed else F.col("_row")[f.name].alias(f.name)
        for f in documents.schema
    ]
    return found.select(*columns)
