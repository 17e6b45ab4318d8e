"""Secrets in texts: candidates by shape or by what stands before them, kept or dismissed by a random forest.

A candidate is a run of key characters with a digit or a known prefix in a word of the text, or any
value that a key word is assigned (`password=...`, `token: "..."`, `Bearer ...`): all characters to
the closing quote or the next space, MIN_VALUE or more, with or without a digit. The forest looks at
its length, the changes between classes of characters, how much of it dictionary words cover, the
path it was found under and the words beside it. It is trained on labelled findings.

The dictionary are the most frequent words of all documents. Where no labelled findings are given,
`labelled_findings` makes some from the documents' own words: keys, tokens and passwords in the
forms in which they are handed out (positive), and checksums, identifiers, paths, numbers, dates and
UUIDs (negative). Training takes at most MAX_LABELLED of these, of distinct texts.

Defined results: null and empty texts have no candidates; each occurrence is
a finding of its own, also several in one word, and a run within a longer assigned value beside that
value; repeated rows are scanned as often as they occur; an empty table gives no rows; a null path says nothing. In
`redact`, all columns are kept and `n_chars` follows the text.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.storage import stored
from skyledger.llm.words import words
from skyledger.operators.shared import scratch_path

MAX_LABELLED = 20_000
DICTIONARY_WORDS = 20_000
FORMS = 29  # findings made of one text
FILLERS = 200  # texts of these words are added at most, where the documents have too few
FILLER_WORDS = (
    "river stone window garden market winter paper bridge yellow mountain letter kitchen morning number street forest "
    "summer table silver engine island travel music doctor planet simple bottle corner circle market harbor pocket"
)
TREES, DEPTH, SEED = 24, 7, 6
SECRET_FROM = 0.5
CONTEXT = 40  # characters of its own word that count as standing before a candidate
MASK = "[SECRET]"
SHAPE = r"[A-Za-z0-9_+/-]{12,}={0,2}"
PREFIXED = r"(AKIA|ASIA|AROA|AIDA)[A-Z2-7]{16}|^(gh[pousr]_|github_pat_|glpat-|xox[abeprs]-|sk-|[sr]k_live_|AIza|npm_|hf_)"
MIN_VALUE = 4
MARK = "\ufdd0"  # not a character, so texts do not use it
QUOTE = "[\"'`]"
KEY_WORDS = "pass|pwd|secret|token|api|key|auth|bearer|cred|private|access"
#: A key word with what assigns it a value, up to the value.
ASSIGNS = (
    rf"(?i)(?:(?:{KEY_WORDS})[\w.-]{{0,40}}[\\\"'`\])]{{0,4}}[ \t]*(?:=>|:=|==?|:)[ \t]*(?:(?:bearer|basic|token)[ \t]+)?"
    r"|\b(?:bearer|basic)[ \t]+)(?=\S)"
)
PASSWORD_BEFORE = r"(pass(word|wd|phrase|code)?|pwd)[\\\"'`\])]*\s*(=>|:=|==?|:)\W*$"
PLACEHOLDER = r"(?i)^[$%<{]|[({\[].*[)}\]]|[({\[]$|^(none|null|nil|true|false|undefined|empty|required|optional|string|str|text)$"
EXAMPLE_WORDS = "example|sample|dummy|placeholder|changeme|redacted|xxxx|your"
CHECK_WORDS = "sha|md5|hash|digest|checksum|commit|uuid|guid|id|rev|build|version|file|path|date|ref"
TEST_PATHS = "test|spec|fixture|example|sample|doc|vendor|mock"
FEATURES = [
    "length", "digits", "uppers", "lowers", "marks", "letter_digit", "digit_letter", "lower_upper",
    "upper_lower", "changes", "distinct", "hex_only", "digits_only", "covered", "test_path",
    "key_before", "check_before", "example_near", "assigned", "quoted", "key_inside",
    "odd_marks", "spaces", "password_before", "by_equals", "placeholder", "prefixed",
]


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.length(text)


def _is_run(c: Column) -> Column:
    return c.rlike(r"\d") | c.rlike(PREFIXED)


def _assigned(rows: DataFrame) -> Column:
    """Array of values that key words are assigned in `_text`, with their context."""
    # A mark before each value; the text between two marks begins with a value and ends with the
    # key word of the next one.
    pieces = F.split("_marked", MARK)
    marked = F.transform(words(F.col("_marked")), lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    marked = F.filter(marked, lambda p: F.contains(p["w"], F.lit(MARK)))
    at = F.flatten(F.transform(marked, lambda p: F.array_repeat(p["i"], F.regexp_count(p["w"], F.lit(MARK)))))
    pairs = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda x, k: F.struct(
        F.get(pieces, k).alias("ahead"), x.alias("rest"), F.get(at, k).alias("i")))

    def value(p: Column) -> Column:
        rest = p["rest"]
        escaped = F.regexp_extract(rest, rf"^\\({QUOTE})(.*?)\\\1", 2)
        quoted = F.regexp_extract(rest, rf"^({QUOTE})(.*?)(?<!\\)\1", 2)
        # Without a closing quote up to the space, less what ends a sentence or names the next key.
        bare = F.regexp_extract(rest, rf"^\\?{QUOTE}?([^ \t-\r]*)", 1)
        bare = F.regexp_replace(bare, r"[&;,?][\\\"'`\w.-]{1,60}[=:]$", "")
        bare = F.rtrim(bare, F.lit("\\\"'`,;.)]}>"))
        return F.when(escaped != "", escaped).when(quoted != "", quoted).otherwise(bare)

    def context(p: Column, v: Column) -> Column:
        opening = F.regexp_extract(p["rest"], rf"^\\?{QUOTE}", 0)
        ahead = F.regexp_replace(F.substring(p["ahead"], -3 * CONTEXT, 3 * CONTEXT), r"\s+", " ")
        behind = F.substr(p["rest"], F.length(opening) + F.length(v) + 1, F.lit(2 * CONTEXT))
        return F.struct(
            F.lit("").alias("word"), p["i"].alias("word_at"),
            F.concat(F.substring_index(ahead, " ", -3), opening).alias("before"),
            F.regexp_extract(behind, r"^\S*\s+(\S+)", 1).alias("after"), v.alias("value"),
        )

    found = F.transform(F.transform(pairs, lambda p: F.struct(p.alias("p"), value(p).alias("v"))), lambda x: context(x["p"], x["v"]))
    # Runs are found by their shape; masks of an earlier scan are no values.
    return F.filter(found, lambda x: (F.length(x["value"]) >= MIN_VALUE)
                    & ~(x["value"].rlike(f"^{SHAPE}$") & _is_run(x["value"])) & ~F.startswith(x["value"], F.lit(MASK[:-1])))


def candidates(documents: DataFrame, key: list[str], path: str | None = None) -> DataFrame:
    """A row per candidate: key columns, `word_at`, `candidate`, `before`, `after`, `path`."""
    rows = documents.select(
        *key,
        (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"),
        words(F.col("text")).alias("_words"),
        F.regexp_replace(F.coalesce("text", F.lit("")), ASSIGNS, f"$0{MARK}").alias("_marked"),
    )
    # Only words that can hold one go on, with the words beside them.
    pairs = F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    apt = F.filter(pairs, lambda p: (F.length(p["w"]) >= 12) & p["w"].rlike(SHAPE) & (p["w"].rlike(r"\d") | p["w"].rlike(PREFIXED.replace("^", ""))))
    empty = F.lit("")

    def context(p: Column) -> Column:
        beside = [F.coalesce(F.get("_words", p["i"] + k), empty) for k in (-2, -1, 1)]
        return F.struct(
            p["w"].alias("word"), p["i"].alias("word_at"),
            F.concat_ws(" ", beside[0], beside[1]).alias("before"), beside[2].alias("after"),
            F.lit(None).cast("string").alias("value"),
        )

    runs = F.transform(apt, context)
    both = F.when(F.contains("_marked", F.lit(MARK)), F.concat(runs, _assigned(rows))).otherwise(runs)
    rows = rows.select(*key, "path", F.explode(both).alias("_c"))
    rows = rows.select(*key, "path", "_c.*")
    found = F.regexp_extract_all("word", F.lit(SHAPE), F.lit(0))
    found = F.when(F.col("value").isNull(), F.filter(found, _is_run)).otherwise(F.array("value"))
    rows = rows.withColumn("candidate", F.explode(found))
    # What stands before the candidate in its own word, as in password=...
    inside = F.substr("word", F.lit(1), F.position(F.col("candidate"), F.col("word")) - 1)
    inside = F.substring(inside, -CONTEXT, CONTEXT)
    before = F.lower(F.when(F.col("value").isNull(), F.concat_ws(" ", "before", inside)).otherwise(F.col("before")))
    return rows.select(*key, "path", "word_at", "candidate", before.alias("before"), F.lower("after").alias("after"))


def dictionary(documents: DataFrame) -> DataFrame:
    """The most frequent words of letters of all documents, lower case, at most DICTIONARY_WORDS."""
    word = F.explode(words(F.col("text"))).alias("word")
    counts = documents.select(word).where(F.col("word").rlike(r"^[A-Za-z]{3,}$"))
    counts = counts.groupBy(F.lower("word").alias("word")).count()
    frequent = counts.where(F.col("count") > 1).orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS)
    return stored(frequent.select("word"), "secret_dictionary")


def covered(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Adds the share of a candidate's characters that lie in dictionary words."""
    texts = rows.select("candidate").distinct()
    # camelCase, snake_case and digits part a candidate into runs of letters.
    apart = F.regexp_replace("candidate", r"([a-z])([A-Z])", "$1 $2")
    runs = F.regexp_extract_all(apart, F.lit(r"[A-Za-z]{3,}"), F.lit(0))
    parts = texts.select("candidate", F.explode(runs).alias("word"))
    parts = parts.select("candidate", F.lower("word").alias("word"))
    # The dictionary is at most DICTIONARY_WORDS short rows.
    hits = parts.join(F.broadcast(known), "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("_hit"))
    share = F.coalesce(F.col("_hit") / F.length("candidate"), F.lit(0.0))
    return rows.join(hits, "candidate", "left").withColumn("covered", share).drop("_hit")


def features(rows: DataFrame) -> DataFrame:
    c = F.col("candidate")
    classes = F.regexp_replace(c, "[^A-Za-z0-9]", ".")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(classes, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    last = F.substring_index(F.trim("before"), " ", -1)
    made = {
        "length": F.length(c), "digits": _share(c, "[0-9]"), "uppers": _share(c, "[A-Z]"),
        "lowers": _share(c, "[a-z]"), "marks": _share(c, "[_+/=-]"),
        "letter_digit": _share(c, "[A-Za-z](?=[0-9])"), "digit_letter": _share(c, "[0-9](?=[A-Za-z])"),
        "lower_upper": _share(c, "[a-z](?=[A-Z])"), "upper_lower": _share(c, "[A-Z](?=[a-z])"),
        "changes": (runs - 1) / F.length(c),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
        "hex_only": c.rlike("^[0-9a-f]+$"), "digits_only": c.rlike("^[0-9_+/=-]+$"),
        "test_path": F.coalesce(F.lower("path").rlike(TEST_PATHS), F.lit(False)),
        "key_before": F.col("before").rlike(KEY_WORDS),
        "check_before": F.col("before").rlike(rf"(^|[^a-z])({CHECK_WORDS})([^a-z]|$)"),
        "example_near": F.concat_ws(" ", "before", "after", F.lower(c)).rlike(EXAMPLE_WORDS),
        "assigned": last.rlike(r"[=:]") | F.col("before").rlike(r"[=:]\W*$"),
        "quoted": last.rlike("[\"']$"), "key_inside": c.rlike("(?i)key|token|secret"),
        "odd_marks": _share(c, r"[^A-Za-z0-9_+/=\s-]"), "spaces": _share(c, r"\s"),
        "password_before": F.col("before").rlike(PASSWORD_BEFORE), "by_equals": F.col("before").rlike(r"=\W*$"),
        "placeholder": c.rlike(PLACEHOLDER), "prefixed": c.rlike(PREFIXED),
    }
    return rows.withColumns({k: v.cast("double") for k, v in made.items()})


def labelled_findings(documents: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """`text`, `label`: at most `most` one-line texts with a finding, made of the documents' words.

    Each distinct text counts once, and those of the smallest hashes are taken. Where fewer
    texts have four words of Latin letters, up to FILLERS of FILLER_WORDS are added, so there are
    findings for any table, an empty one too. Digests of the words stand for chance.
    """
    latin = F.filter(words(F.col("text")), lambda x: x.rlike("^[A-Za-z]{2,24}$"))
    some = documents.where(F.col("text").isNotNull()).select(F.slice(latin, 1, 8).alias("w"), F.xxhash64("text").alias("h"))
    some = some.where(F.size("w") >= 4).distinct().withColumn("filler", F.lit(False))
    known = F.array(*[F.lit(x) for x in FILLER_WORDS.split()])
    fillers = documents.sparkSession.range(0, FILLERS, 1, 1).select(
        F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.get(known, F.pmod(F.xxhash64("id", i), F.size(known)).cast("int"))).alias("w"),
        F.xxhash64("id").alias("h"), F.lit(True).alias("filler"),
    )
    # The documents' own texts first; few rows of a few words are left.
    some = some.unionByName(fillers).orderBy("filler", "h").limit(max(1, most // FORMS))
    a, b, c, d = (F.lower(F.get("w", i)) for i in range(4))
    chance = F.sha2(F.concat_ws(" ", F.col("h").cast("string"), "w"), 512)
    mixed = F.base64(F.unhex(chance))
    code = F.substring(F.regexp_replace(F.upper(mixed), "[^A-Z0-9]", ""), 1, 16)
    alnum = F.regexp_replace(mixed, "[^A-Za-z0-9]", "")
    hex_of = lambda n: F.substring(chance, 3, n)
    number = F.regexp_replace(chance, "[^0-9]", "")
    turn = F.pmod("h", F.lit(3))
    name = F.when(turn == 0, "password").when(turn == 1, "secret").otherwise("api_key")
    quote = F.when(turn == 0, '"').otherwise("")
    # Names and signs that go before passwords as people choose them.
    login = F.when(turn == 0, "password").when(turn == 1, "pass").otherwise("pwd")
    sign = F.when(F.pmod("h", F.lit(2)) == 0, "=").otherwise(": ")
    other = F.when(turn == 0, "key").when(turn == 1, "token").otherwise("access")
    mark = F.substring(F.lit("!@#$%&*?"), (F.pmod("h", F.lit(8)) + 1).cast("int"), F.lit(1))
    as_letters = F.translate(code, "0123456789", "QRSTUVWXYZ")
    line = lambda *parts: F.concat(a, F.lit(" "), *[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit(" "), b)
    forms = [
        (1.0, line(c, " AKIA", code)),
        (1.0, line("token = \"", hex_of(40), '"')),
        (1.0, line(name, "=", hex_of(18))),
        (1.0, line(name, ": ", quote, F.substring(alnum, 1, 24), quote)),
        (1.0, line("Authorization: Bearer ", F.substring(alnum, 4, 36))),
        (1.0, line(c, " AKIA", as_letters)),
        (1.0, line("aws_access_key_id", sign, "AKIA", as_letters)),
        (1.0, line(login, sign, quote, c, quote)),
        (1.0, line(login, sign, quote, c, "-", d, "-", b, quote)),
        (1.0, line(login, sign, F.initcap(c), mark, F.substring(number, 1, 2))),
        (1.0, line(login, sign, quote, F.substring(c, 1, 3), mark, F.substring(d, 1, 4), mark, F.substring(number, 1, 4), quote)),
        (1.0, line(login, sign, quote, F.substring(alnum, 1, 8), quote)),
        (1.0, line(name, "=", quote, F.substring(alnum, 8, 10), quote)),
        (1.0, line("passphrase", sign, '"', c, " ", d, " ", a, " ", b, '"')),
        (1.0, line(login, sign, c, F.substring(number, 1, 3))),
        (0.0, line(other, ": ", c, " ", d)),
        (0.0, line(other, "=", c)),
        (0.0, line("the secret: ", c, " ", d)),
        (0.0, line(login, sign, "${", F.upper(c), "}")),
        (0.0, line(login, " = ", c, ".", d, "()")),
        (0.0, line(login, sign, F.when(turn == 0, "null").when(turn == 1, "None").otherwise("true"))),
        (0.0, line(other, sign, "<", c, ">")),
        (0.0, line("sha256 ", hex_of(64))),
        (0.0, line("commit ", hex_of(40))),
        (0.0, line(c, "_", d, "_", F.substring(number, 1, 4))),
        (0.0, line("/", c, "/", d, "/", a, F.substring(number, 1, 3))),
        (0.0, line(F.substring(number, 1, 16))),
        (0.0, line("id ", hex_of(8), "-", F.substring(chance, 12, 4), "-", F.substring(chance, 17, 12))),
        (0.0, line("20", F.substring(number, 1, 2), "-", F.substring(number, 3, 2), "-", F.substring(number, 5, 2), "T", F.substring(number, 7, 6))),
    ]
    assert len(forms) == FORMS
    made = F.array(*[F.struct(text.alias("text"), F.lit(label).alias("label")) for label, text in forms])
    return some.select(F.explode(made).alias("f")).select("f.text", "f.label")


def train(findings: DataFrame, known: DataFrame) -> RandomForestClassificationModel:
    """A forest from one-line texts with a label; `path` is used where it is there."""
    path = "path" if "path" in findings.columns else None
    rows = features(covered(candidates(findings, ["label"], path), known))
    rows = stored(rows.select("label", *FEATURES), "secret_training")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label")
    # A model as read back holds no training data, which its tasks could not take along.
    path = scratch_path(findings.sparkSession, "secret_forest")
    forest.fit(vectors).write().save(path)
    return RandomForestClassificationModel.load(path)


def scan(documents: DataFrame, key: list[str], model: RandomForestClassificationModel, known: DataFrame, path: str | None = None) -> DataFrame:
    """All candidates of the documents with `probability` and `is_secret`."""
    found = stored(candidates(documents, key, path), "secret_candidates")
    rows = features(covered(found, known))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    scored = model.transform(vectors)
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return scored.select(*key, "word_at", "candidate", F.round(probability, 6).alias("probability")).withColumn(
        "is_secret", F.col("probability") >= SECRET_FROM
    )


def scan_documents(documents: DataFrame, key: list[str], findings: DataFrame | None = None, path: str | None = None) -> DataFrame:
    """Train on labelled findings, or on ones made from the documents, and scan all documents."""
    known = dictionary(documents)
    model = train(labelled_findings(documents) if findings is None else findings, known)
    return scan(documents, key, model, known, path)


def _masked(text: Column, c: Column) -> Column:
    """Runs go wherever they stand; a value that may be a word goes where it is not part of one."""
    edges = F.when(c.rlike("^[A-Za-z0-9]"), "(?<![A-Za-z0-9])").otherwise(""), F.when(c.rlike("[A-Za-z0-9]$"), "(?![A-Za-z0-9])").otherwise("")
    literal = F.concat(F.lit("\\Q"), F.replace(c, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    whole = F.regexp_replace(text, F.concat(edges[0], literal, edges[1]), F.lit(MASK))
    return F.when(c.rlike(f"^{SHAPE}$"), F.replace(text, c, F.lit(MASK))).otherwise(whole)


def redact(documents: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """The documents with every secret found in a text replaced by MASK."""
    rows = stored(
        documents.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_id")),
        "secret_documents",
    )
    texts = rows.select("_id", "_row.text")
    secrets = scan_documents(texts, ["_id"], findings).where("is_secret")
    # Longer ones first, so that none is cut by one that it contains.
    by_length = F.struct((-F.length("candidate")).alias("n"), F.col("candidate").alias("c"))
    secrets = secrets.groupBy("_id").agg(F.sort_array(F.collect_set(by_length)).alias("_secrets"))
    masked = F.aggregate("_secrets", F.col("_row.text"), lambda text, s: _masked(text, s["c"]))
    found = rows.join(stored(secrets, "secrets"), "_id", "left")
    found = found.select("_row", F.when(F.col("_secrets").isNull(), F.col("_row.text")).otherwise(masked).alias("_text"))
    renewed = {"text": F.col("_text"), "n_chars": F.char_length("_text")}
    hit = ~F.col("_text").eqNullSafe(F.col("_row.text"))
    columns = []
    for f in documents.schema:
        own = F.col("_row")[f.name]
        new = F.when(hit, renewed[f.name].cast(f.dataType)).otherwise(own) if f.name in renewed else own
        columns.append(new.alias(f.name))
    return found.select(*columns)
