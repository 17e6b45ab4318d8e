"""Documents that hold what operators must not trip over; further columns have clashing names."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, _row string"
WORDS = "river stone quiet garden lamp winter paper cloud silver bridge morning copper field".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(60)) for _ in range(n))


def documents():
    texts = [
        None, "", "   \t\n", "one", "tie", "tie", prose(1, 80), prose(1, 80), prose(2, 400),
        "é ñ ß 東京 ́x", "same line\nsame line\nsame line\n" + prose(3, 30), prose(4, 30_000),
        "\x1c odd   spaces\r\n\r\nhere", "<|endoftext|> 'tis 12's",
    ]
    rows = [
        (i, t, None if i % 5 == 0 else "aa", None if i % 4 == 0 else f"s{i % 3}", None, 1, "x")
        for i, t in enumerate(texts)
    ]
    rows.append(rows[6])  # a repeated row
    rows.append((None, "no id", "aa", "s0", None, 1, "x"))
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
