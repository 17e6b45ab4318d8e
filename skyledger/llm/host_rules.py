"""Quality rules judged by host: a host where too many documents fail takes the others with it.

Each document is measured within its row. Failures of each rule are counted by host, and the rate
of a host is drawn towards the rate of all hosts by a beta prior fitted to the hosts' rates (method
of moments), so that a host of few documents needs more failures. A host whose drawn rate of any
rule is above the limit is rejected, and the verdict is joined back to its documents.

Counts are combined before the shuffle, so a host with a third of all rows is one row per task. The
rejected hosts are written first; they are broadcast if they are few, else joined by a shuffle in
which adaptive execution splits large hosts.

Defined results: a null text has no word and fails; documents without a host are judged by
themselves alone; repeated rows count as often as they occur; an empty table gives no rows; all
columns of the documents are kept, measures and verdicts replace columns of their names.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.storage import stored
from skyledger.llm.words import WORD, hashed_runs, without, without_space, words
from skyledger.operators.shared import settle

RUN = 5
SYMBOLS = "#*$%&|<>"
MAX_HOST_RATE = 0.5
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20
VERDICTS = ("base_failed", "host_rejected", "kept")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures. Arrays made on the way are columns of their own, so as to be made once,
    beside the whole input row, so that its names meet none of theirs."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n"), lambda line: line.rlike(WORD))
    rows = documents.select(
        F.struct("*").alias("_row"),
        words(F.col(text)).alias("_words"),
        F.char_length(without_space(content)).cast("bigint").alias("word_chars"),
        (F.char_length(content) - F.char_length(without(content, SYMBOLS))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
    )
    rows = rows.select(
        "*",
        hashed_runs("_words", RUN).alias("_runs"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("_words").cast("bigint").alias("n_words"),
    )
    placed = F.sort_array(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = F.size("_runs") > F.size(F.array_distinct("_runs"))
    rows = rows.withColumn("_placed", F.when(twice, placed))

    def beside(step: int, i: Column, run: Column) -> Column:
        return F.coalesce(F.get("_placed", i + step)["h"] == run["h"], F.lit(False))

    again = F.filter("_placed", lambda run, i: beside(-1, i, run) | beside(1, i, run))
    rows = rows.withColumn("_starts", F.sort_array(F.transform(again, lambda run: run["i"])))
    # Runs that overlap share words: each adds what lies before the next one's start.
    own = F.transform(
        "_starts", lambda at, i: F.least(F.coalesce(F.get("_starts", i + 1) - at, F.lit(RUN)), F.lit(RUN))
    )
    repeated = F.aggregate(own, F.lit(0).cast("bigint"), lambda total, n: total + n)
    rows = rows.withColumn("n_repeat_words", F.coalesce(repeated, F.lit(0)).cast("bigint"))
    kept = [F.col("_row")[c].alias(c) for c in documents.columns if c not in MEASURES]
    return rows.select(*kept, *MEASURES)


def rules() -> dict[str, Column]:
    """Whether a measured document fails, by rule. The first two make up the base verdict."""
    n = F.col("n_words")
    return {
        "few_words": n < 10,
        "repetition": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "same_lines": 5 * F.col("n_dup_lines") > n,
    }


def host_rates(judged: DataFrame, host: str, failures: list[str]) -> DataFrame:
    """Per host: documents, and the drawn rate of each rule under `rate_<rule>`."""
    counts = stored(
        judged.where(F.col(host).isNotNull()).groupBy(host).agg(
            F.count("*").alias("n"), *[F.sum(F.col(f).cast("bigint")).alias(f) for f in failures]
        ),
        "host_counts",
    )
    rates = [F.col(f) / F.col("n") for f in failures]
    prior = counts.agg(
        *[F.avg(r).alias(f"mean_{f}") for f, r in zip(failures, rates)],
        *[F.var_pop(r).alias(f"var_{f}") for f, r in zip(failures, rates)],
    ).first()
    drawn = []
    for f in failures:
        mean, var = prior[f"mean_{f}"] or 0.0, prior[f"var_{f}"] or 0.0
        # Strength of the prior in documents; hosts that do not differ are drawn all the way.
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), 1e6) if var > 0 else 1e6
        rate = (F.col(f) + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
        drawn.append(rate.alias(f"rate_{f}"))
    return counts.select(host, "n", *drawn)


def judge(measures: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Adds `base_failed`, `host_rejected` and `kept` to measured rows, which are read twice."""
    failing = rules()
    names = [f"_{name}" for name in failing]
    failed = {f"_{name}": rule for name, rule in failing.items()}
    flags = measures.select(F.col(host).alias("_host"), *[r.alias(n) for n, r in failed.items()])
    rates = host_rates(flags, "_host", names)
    rejected = reduce(or_, (F.col(f"rate_{f}") > max_rate for f in names))
    bad = settle(rates.where(rejected).select("_host", F.lit(True).alias("_rejected")), "bad_hosts")
    small = bad.rows <= BROADCAST_ROWS and bad.size <= BROADCAST_BYTES
    others = [c for c in measures.columns if c not in VERDICTS]
    rows = measures.select(
        F.struct(*others).alias("_row"),
        F.col(host).alias("_host"),
        (failed["_few_words"] | failed["_repetition"]).alias("base_failed"),
    )
    joined = rows.join(F.broadcast(bad.frame) if small else bad.frame, "_host", "left")
    joined = joined.withColumn("host_rejected", F.coalesce("_rejected", F.lit(False)))
    joined = joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    return joined.select("_row.*", *VERDICTS)
