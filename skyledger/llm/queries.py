"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import audit_repair, audit_sql, chosen_path, collocations, host_rules, language, mixing, order_minhash, packing, page_difference, quotations, secret_scan, warc, wavelet
from skyledger.llm.storage import ready, stored

Query = Callable[[SparkSession, str], DataFrame]


def over(table: str) -> Callable[[Callable[[DataFrame], DataFrame]], Query]:
    """Makes a query of a function of one given table."""

    def make(function: Callable[[DataFrame], DataFrame]) -> Query:
        @wraps(function)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ready(spark)
            return function(spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        return query

    return make


@over("documents")
def op1_wavelet_matrix(documents: DataFrame) -> DataFrame:
    manifest = wavelet.write_shards(documents, public_tokenizers.path("byte_bpe_50k.json"), 0)
    read = wavelet.read_shards(manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@over("documents")
def op2_minimum_bin_slack(documents: DataFrame) -> DataFrame:
    packed = packing.pack_documents(documents, public_tokenizers.path("word_bpe_49k.json"), 1)
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "sequence_id", "offset",
    )


def held_out(doc_id: str = "doc_id") -> Column:
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def language_model(documents: DataFrame) -> language.Model:
    """Fitted on labelled documents that are not held out."""
    labelled = documents.where(~held_out() & F.col("lang").isNotNull())
    return language.fit(language.sample(labelled.select("text", "lang")))


@over("documents")
def op3_chosen_path_join(documents: DataFrame) -> DataFrame:
    return chosen_path.similar_groups(documents)


@over("documents")
def op4_word_first_backoff(documents: DataFrame) -> DataFrame:
    model = language_model(documents)
    found = language.predict(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@over("documents")
def op5_multinomial_mix(documents: DataFrame) -> DataFrame:
    return mixing.mix(documents).drop("source")


@over("documents")
def op6_secret_forest(documents: DataFrame) -> DataFrame:
    return secret_scan.scan_documents(documents.select("doc_id", "text"), ["doc_id"])


@over("conversations")
def op8_quotation_linking(messages: DataFrame) -> DataFrame:
    return quotations.in_reply_order(quotations.link_quotations(messages)).drop("text")


@over("documents")
def op9_order_minhash(documents: DataFrame) -> DataFrame:
    return order_minhash.compare_with_edits(documents)


@over("documents")
def op10_host_rules(documents: DataFrame) -> DataFrame:
    measures = host_rules.measured(documents.select("doc_id", "source", "text")).drop("text")
    judged = host_rules.judge(stored(measures, "measures"), "source")
    return judged.drop("source", "host_rejected")


@over("documents")
def op11_phrase_collocations(documents: DataFrame) -> DataFrame:
    return collocations.collocations(documents)


@over("conversations")
def op12_audit_repair(messages: DataFrame) -> DataFrame:
    return audit_repair.repair_damage(messages)


@over("pages")
def op13_page_difference(pages: DataFrame) -> DataFrame:
    return page_difference.main_text(pages)


@over("pages")
def op7_warc_reader(pages: DataFrame) -> DataFrame:
    return warc.read_archives(warc.write_archives(pages)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES: dict[str, Query] = {
    "op1_wavelet_matrix": op1_wavelet_matrix,
    "op2_minimum_bin_slack": op2_minimum_bin_slack,
    "op3_chosen_path_join": op3_chosen_path_join,
    "op4_word_first_backoff": op4_word_first_backoff,
    "op5_multinomial_mix": op5_multinomial_mix,
    "op6_secret_forest": op6_secret_forest,
    "op7_warc_reader": op7_warc_reader,
    "op8_quotation_linking": op8_quotation_linking,
    "op9_order_minhash": op9_order_minhash,
    "op10_host_rules": op10_host_rules,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_audit_repair": op12_audit_repair,
    "op13_page_difference": op13_page_difference,
}

# Where SQL can express the whole answer. Tokenizers, trained models and the engine's own hash
# functions have no SQL form; those queries are tested against brute force.
ORACLES: dict[str, str] = {
    "op12_audit_repair": audit_sql.REPAIR_SQL,
    "op3_chosen_path_join": r"""
        WITH RECURSIVE
        split AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
          FROM documents),
        shingles AS (
          SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, unnest(CASE WHEN len(w) >= 5
              THEN list_transform(range(1, len(w) - 3), lambda i: list_slice(w, i, i + 4))
              WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM split)),
        sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
          SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS common
          FROM shingles a JOIN shingles b ON a.s = b.s GROUP BY 1, 2),
        alike AS (
          SELECT a, b, common = x.n AND common = y.n AS same
          FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
          WHERE common >= 0.8 * (x.n + y.n - common) - 1e-9),
        reached AS (
          SELECT a, b FROM alike
          UNION
          SELECT r.a, s.b FROM reached r JOIN alike s ON r.b = s.a)
        SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id,
          coalesce(l.copies, 1) AS copies, coalesce(l.links, 0) AS links
        FROM documents d
        LEFT JOIN (SELECT a, MIN(b) AS class_id FROM reached GROUP BY a) c ON d.doc_id = c.a
        LEFT JOIN (SELECT a, COUNT(*) - 1 AS links, COUNT(*) FILTER (WHERE same) AS copies
                   FROM alike GROUP BY a) l ON d.doc_id = l.a""",
    "op7_warc_reader": """
        WITH payloads AS (
          SELECT page_id, coalesce(html, '') AS payload,
            MIN(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
          FROM pages),
        bits AS (
          SELECT *, list_aggregate(list_transform(string_split(sha1(payload), ''),
            lambda x: lpad(bin(strpos('0123456789abcdef', x) - 1), 4, '0')), 'string_agg', '') AS b
          FROM payloads)
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
          list_aggregate(list_transform(range(32), lambda i:
            substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
              + 16 * CAST(substring(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substring(b, 5 * i + 2, 1) AS INT)
              + 4 * CAST(substring(b, 5 * i + 3, 1) AS INT) + 2 * CAST(substring(b, 5 * i + 4, 1) AS INT)
              + CAST(substring(b, 5 * i + 5, 1) AS INT) AS BIGINT), 1)), 'string_agg', '')
            AS payload_digest,
          CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> first THEN first END AS refers_to
        FROM bits""",
    "op10_host_rules": r"""
        WITH split AS (
          SELECT doc_id, source, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)),
              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
          FROM documents),
        runs AS (
          SELECT doc_id, i, list_slice(w, i, i + 4) AS run
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
        repeated AS (
          SELECT doc_id, COUNT(DISTINCT place) AS n FROM (
            SELECT doc_id, unnest(range(i, i + 5)) AS place
            FROM (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, run) AS n FROM runs)
            WHERE n > 1)
          GROUP BY doc_id),
        measured AS (
          SELECT s.doc_id, s.source, CAST(len(w) AS BIGINT) AS n_words,
            CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
            CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
            CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
          FROM split s LEFT JOIN repeated r ON s.doc_id = r.doc_id),
        rules AS (
          SELECT doc_id, source, unnest([n_words < 10, 100 * n_repeat_words > 20 * n_words,
              10 * n_symbols > n_words, 5 * n_dup_lines > n_words]) AS failed,
            unnest([1, 2, 3, 4]) AS rule
          FROM measured),
        hosts AS (
          SELECT source, rule, COUNT(*) AS n, COUNT(*) FILTER (WHERE failed) AS k
          FROM rules WHERE source IS NOT NULL GROUP BY source, rule),
        priors AS (
          SELECT rule, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1), 1e6)
              ELSE 1e6 END AS strength
          FROM (SELECT rule, AVG(k / n) AS m, VAR_POP(k / n) AS v FROM hosts GROUP BY rule)),
        bad AS (
          SELECT DISTINCT source FROM hosts JOIN priors USING (rule)
          WHERE (k + m * strength) / (n + strength) > 0.5)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
          n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
          NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
            AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
        FROM measured""",
    "op11_phrase_collocations": r"""
        WITH pieces AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        runs AS (
          SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4, 5], lambda m:
            list_transform(range(1, len(w) - m + 2), lambda i: list_slice(w, i, i + m - 1))))) AS p
          FROM split WHERE len(w) > 0),
        f AS (SELECT lang, p, COUNT(*) AS f FROM runs GROUP BY lang, p),
        totals AS (SELECT lang, SUM(f) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
        candidates AS (SELECT lang, p, f AS a FROM f WHERE len(p) >= 2 AND f >= 100),
        cuts AS (
          SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates),
        scored AS (
          SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, t.n,
            CAST((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
          FROM cuts c JOIN totals t ON c.lang = t.lang
          JOIN f x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, c.k)
          JOIN f y ON y.lang = c.lang AND y.p = list_slice(c.p, c.k + 1, len(c.p))),
        worst AS (
          SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        inside AS (
          SELECT lang, a, unnest(flatten(list_transform(range(2, len(p)), lambda m:
            list_transform(range(1, len(p) - m + 2), lambda i: list_slice(p, i, i + m - 1))))) AS p
          FROM candidates WHERE len(p) >= 3),
        longer AS (SELECT lang, p, MAX(a) AS a FROM inside GROUP BY lang, p),
        ranked AS (
          SELECT w.lang, array_to_string(w.p, ' ') AS phrase, w.a, l, r, n, score
          FROM worst w LEFT JOIN longer o ON w.lang = o.lang AND w.p = o.p
          WHERE o.a IS NULL OR 100 * o.a < 100 * w.a)
        SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
          CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
              FROM ranked)
        WHERE rank <= 2000""",
}
