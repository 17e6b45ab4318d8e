"""Files that hold one JSON array of objects each, read by as many tasks as their size asks for.

A file is cut at every closing brace, which the text source does in splits of any file. Whether a
piece begins inside a string follows from the quotes before it: a backslash only occurs in strings
and takes the next character with it, and a brace is never that character, so the unescaped
quotes of a piece can be counted by themselves. With that known, brackets outside strings give the
depth at which every piece ends, and a brace that comes back to the depth of the array ends a record.
All three are running sums: within a split by a window, over splits by one small row for each.

Nothing but one split, or one record, is ever in one task. A file that is no array, has other values
than objects, or ends early fails the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators.lookups import lookup_join
from skyledger.operators.shared import settle

SPLIT = ["file", "start"]
ESCAPE = r"(?s)\\."


def _running(pieces: DataFrame, amount: str, name: str) -> DataFrame:
    """Adds the sum of `amount` over all earlier pieces of the file."""
    inside = Window.partitionBy(*SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = pieces.groupBy(*SPLIT).agg(F.sum(amount).alias("_sum"))
    splits = splits.select(*SPLIT, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = pieces.withColumn("_within", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return (
        lookup_join(within, splits, SPLIT, "inner")
        .withColumn(name, F.col("_within") + F.col("_offset"))
        .drop("_within", "_offset")
    )


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each closing brace, without it: file, start of the split, place in it, text."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"),
    )


def _outside(text: Column, in_string: Column) -> Column:
    """A piece without escapes and without what stands in strings."""
    plain = F.regexp_replace(text, ESCAPE, "")
    plain = F.when(in_string, F.regexp_replace(plain, r'\A[^"]*("|\z)', "")).otherwise(plain)
    return F.regexp_replace(plain, r'"[^"]*("|\z)', "")


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """The objects of the arrays of all files as JSON text, in the column `record`."""
    pieces = _pieces(spark, path)
    pieces = pieces.withColumn("quotes", F.regexp_count(F.regexp_replace("text", ESCAPE, ""), F.lit('"')))
    pieces = settle(pieces, "json_pieces").frame
    # The last piece of a file has no brace behind it.
    last = pieces.groupBy("file").agg(F.max(F.struct("start", "at")).alias("last"))
    pieces = lookup_join(_running(pieces, "quotes", "before"), last, ["file"], "inner")
    ended = ~F.struct("start", "at").eqNullSafe(F.col("last"))
    closed = ended & ((F.col("before") + F.col("quotes")) % 2 == 0)
    outside = _outside(F.col("text"), F.col("before") % 2 == 1)
    brackets = F.regexp_count(outside, F.lit(r"[\[{]")) - F.regexp_count(outside, F.lit(r"\]"))
    pieces = pieces.select(
        *SPLIT, "at", "text", closed.alias("closed"), (brackets - closed.cast("int")).alias("deeper")
    )
    pieces = _running(settle(pieces, "json_depths").frame, "deeper", "depth")
    ends = F.col("closed") & (F.col("depth") + F.col("deeper") == 1)
    pieces = settle(pieces.select(*SPLIT, "at", "text", ends.cast("int").alias("ends")), "json_ends").frame
    numbered = _running(pieces, "ends", "number")
    parts = F.sort_array(F.collect_list(F.struct("start", "at", "text")))
    found = numbered.groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "}").alias("text"), F.max("ends").alias("whole")
    )
    first, whole = F.col("number") == 0, F.col("whole") == 1
    head = F.regexp_replace("text", r"\A\s*[\[,]\s*", "")
    starts = F.col("text").rlike(r"\A\s*,\s*\{") | (first & F.col("text").rlike(r"\A\s*\[\s*\{"))
    done = F.col("text").rlike(r"\A\s*\]\s*\z") & ~first | first & F.col("text").rlike(r"\A\s*\[\s*\]\s*\z")
    message = F.concat(
        F.when(first, "expected a JSON array, found: ").otherwise("no record of a JSON array: "),
        F.substring(F.ltrim("text"), F.lit(1), F.lit(20)),
    )
    broken = F.raise_error(message).cast("string")
    record = F.when(whole & starts, F.concat(head, F.lit("}"))).when(~whole & done, F.lit(None)).otherwise(broken)
    return found.select(record.alias("record")).where(F.col("record").isNotNull())
