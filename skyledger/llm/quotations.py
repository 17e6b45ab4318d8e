"""Conversations in reply order, with replies found by what they quote.

Lines that begin with `>` are quoted, and the number of marks is the level. Neighbouring lines of
one level are a passage. Passages, their paragraphs (parted by blank quoted lines) and single lines are
normalised and hashed, and so are
the bodies, paragraphs and lines that messages wrote themselves. A quoted passage is linked to the
message of its conversation that wrote it first, if that came before. A message replies to the
message linked by its outermost quotes: by whole passages before paragraphs before single lines, to
the latest of several. Passages that link to nothing are not lost: `unlinked` holds their texts in order,
as they may be quotes from elsewhere, or lines that begin with a mark for another reason. A thread is a message with all replies to it and to those.

Reply order is conversation, thread, turn: every message comes after the one it answers, and
threads stay together. Each message keeps its row, so a conversation of any size is spread over
tasks; threads are found by doubling steps over the links alone.

Defined results: a null text is an empty body; a null conversation or turn links to nothing; of
messages with the same turn all have the same place; repeated rows are all kept; an empty table
gives no rows; all other columns are kept, added ones replace columns of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.storage import stored

MARKS = r"^(?:[ \t]*>)+"
SAID = r"(?i)^(on|am|le|el)\b.*(wrote|schrieb.*|écrit|escribió) ?:$"  # a line that announces a quote
ADDED = ("body", "reply_to", "thread", "n_quotes", "n_linked", "unlinked", "formatted")
WHOLE, PARAGRAPH, LINE = 2, 1, 0


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s>]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Adds `_lines` (level, content) and `_own`, the body without quotes and their announcements."""
    lines = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\r?\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARKS + r"[ \t]?", "").alias("content"),
        ),
    )
    rows = messages.withColumn("_lines", lines)
    quoted = lambda i: F.coalesce(F.get("_lines", i)["level"] > 0, F.lit(False))
    own = F.filter("_lines", lambda x, i: (x["level"] == 0) & ~(x["content"].rlike(SAID) & quoted(i + 1)))
    body = F.array_join(F.transform(own, lambda x: x["content"]), "\n")
    # Gaps that quotes leave close to one empty line.
    body = F.regexp_replace(F.regexp_replace(body, r"\A\s+|\s+\z", ""), r"\n\s*\n+", "\n\n")
    return rows.withColumn("_own", body)


def _passages(rows: DataFrame) -> DataFrame:
    """Quoted passages: conv_id, turn, level, place in the message, lines."""
    level = lambda i: F.get("_lines", i)["level"]
    rows = rows.where(F.exists("_lines", lambda x: x["level"] > 0))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: ~level(i).eqNullSafe(level(i - 1))
    )
    rows = rows.withColumn("_starts", starts)

    def passage(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("_starts", k + 1), F.size("_lines"))
        inside = F.transform(F.slice("_lines", start + 1, end - start), lambda x: x["content"])
        return F.struct(level(start).alias("level"), inside.alias("lines"))

    passages = F.filter(F.transform("_starts", passage), lambda p: p["level"] > 0)
    rows = rows.select("conv_id", "turn", "_id", F.posexplode(passages).alias("_passage", "_p"))
    return rows.select("conv_id", "turn", "_id", "_passage", "_p.level", "_p.lines")


def _quotes(rows: DataFrame) -> DataFrame:
    """Hashes of quoted passages: conv_id, turn, level, rank of the kind, hash."""
    # A passage without a blank line is one paragraph, which is the passage itself.
    paragraphs = F.split(F.array_join("lines", "\n"), r"\n[\s>]*\n")
    paragraphs = F.when(F.size(paragraphs) > 1, paragraphs).otherwise(F.array().cast("array<string>"))
    forms = F.concat(
        F.array(F.struct(F.lit(WHOLE).alias("kind"), F.array_join("lines", " ").alias("t"))),
        F.transform(paragraphs, lambda x: F.struct(F.lit(PARAGRAPH).alias("kind"), x.alias("t"))),
        F.transform("lines", lambda x: F.struct(F.lit(LINE).alias("kind"), x.alias("t"))),
    )
    rows = rows.select("conv_id", "turn", "_id", "level", "_passage", F.explode(forms).alias("_f"))
    return _hashed(rows, "conv_id", "turn", "_id", "level", "_passage", "_f.kind", text="_f.t")


def _originals(rows: DataFrame) -> DataFrame:
    """First turn of each passage that a conversation's messages wrote: conv_id, hash, origin."""
    pieces = F.array_distinct(
        F.concat(F.array("_own"), F.split("_own", "\n\n"), F.split("_own", "\n"))
    )
    texts = rows.select("conv_id", "turn", F.explode(pieces).alias("_t"))
    hashed = _hashed(texts, "conv_id", "turn", text="_t")
    return hashed.groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))


def _hashed(rows: DataFrame, *columns: str, text: str) -> DataFrame:
    rows = rows.select(*columns, normal(F.col(text)).alias("_n")).where(F.length("_n") > 0)
    return rows.withColumn("hash", F.sha2("_n", 256)).drop("_n")


def links(rows: DataFrame) -> DataFrame:
    """Per message row: `n_quotes`, `n_linked` and `reply_to`, the turn it answers."""
    quoted = _passages(rows)
    found = _quotes(quoted).join(_originals(rows), ["conv_id", "hash"], "left")
    found = found.withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin")))
    passages = found.groupBy("_id", "_passage", "level").agg(
        F.max(F.when(F.col("origin").isNotNull(), F.struct("kind", "origin"))).alias("best")
    )
    texts = quoted.select("_id", "_passage", "level", F.array_join("lines", "\n").alias("_text"))
    # Blank passages are no quotes.
    passages = texts.join(passages, ["_id", "_passage", "level"], "left")
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("level")).alias("l"), "best.kind", "best.origin"))
    loose = (normal(F.col("_text")) != "") & F.col("best").isNull()
    texts = F.sort_array(F.collect_list(F.when(loose, F.struct("_passage", "_text"))))
    return passages.groupBy("_id").agg(
        F.count_if(normal(F.col("_text")) != "").alias("n_quotes"), F.count("best").alias("n_linked"),
        F.max(best)["origin"].alias("reply_to"), F.transform(texts, lambda x: x["_text"]).alias("unlinked"),
    )


def threads(replies: DataFrame) -> DataFrame:
    """The first message of each thread, for replies given as conv_id, turn, reply_to.

    Every step doubles how far back a reply looks, so a chain of n replies takes log2(n) steps.
    """
    at = replies.groupBy("conv_id", "turn").agg(F.max("reply_to").alias("root"))
    at = stored(at, "reply_roots")
    while True:
        above = at.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("further"))
        step = at.join(above, ["conv_id", "root"], "left")
        step = stored(step.select("conv_id", "turn", "root", "further"), "reply_roots")
        moved = step.where(F.col("further").isNotNull()).limit(1).count()
        at = step.select("conv_id", "turn", F.coalesce("further", "root").alias("root"))
        if not moved:
            return at


def link_quotations(messages: DataFrame) -> DataFrame:
    """Adds `body`, `reply_to`, `thread` and `formatted` to messages of conv_id, turn, role, text."""
    rows = messages.select(
        F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_id"),
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text",
    )
    rows = stored(parsed(rows).drop("text"), "messages_parsed")
    linked = stored(links(rows), "message_links")
    replies = rows.select("_id", "conv_id", "turn").join(linked.where(F.col("reply_to").isNotNull()), "_id")
    roots = threads(replies.select("conv_id", "turn", "reply_to"))
    found = rows.join(linked, "_id", "left").join(roots, ["conv_id", "turn"], "left")
    formatted = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("_own"), F.lit("\n"))
    kept = [F.col("_row")[c].alias(c) for c in messages.columns if c not in ADDED]
    return found.select(
        *kept,
        F.col("_own").alias("body"),
        "reply_to",
        F.coalesce("root", "turn").alias("thread"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.coalesce("unlinked", F.array().cast("array<string>")).alias("unlinked"),
        formatted.alias("formatted"),
    )


def in_reply_order(linked: DataFrame) -> DataFrame:
    """Linked messages as they are to be written: ranges of conversations, in reply order."""
    order = ["conv_id", "thread", "turn"]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)
