import re
from collections import Counter

from skyledger.llm import host_rules
from tests.llm.samples import SCHEMA, documents, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside))


def judged(spark, rows):
    return host_rules.judge(host_rules.measured(frame(spark, rows)))


def test_measures_are_those_of_python(spark):
    rows = documents()
    rows += [(50, "a b c d e " * 40, None, "s1", 1, 1, "x"), (51, "# | a\n# | a\n\n\n" * 9, None, "s1", 1, 1, "x")]
    rows += [(52, "p q r s t p q r s t u p q r s", None, None, 1, 1, "x")]
    found = judged(spark, rows)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    assert found.columns == [*names, *host_rules.MEASURES, *host_rules.VERDICTS]
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found.collect())
    assert got == Counter((d, *measures(t)) for d, t, *_ in rows)


def test_a_bad_host_takes_its_documents_with_it(spark):
    rows = []
    for host in range(12):
        for i in range(30):
            bad = host == 3 and i < 26 or host != 3 and i == 0
            text = "too short" if bad else prose(100 * host + i, 60)
            rows.append((len(rows), text, None, f"h{host}", 1, 1, "x"))
    rows.append((999, "too short", None, "new", 1, 1, "x"))  # one failure does not make a bad host
    rows.append((1000, prose(5, 40), None, "new", 1, 1, "x"))
    rows.append((1001, prose(6, 40), None, None, 1, 1, "x"))
    found = {r.doc_id: r for r in judged(spark, rows).collect()}
    for doc_id, text, _, host, *_ in rows:
        row = found[doc_id]
        assert row.base_failed == (text == "too short")
        assert row.host_rejected == (host == "h3")
        assert row.kept == (not row.base_failed and host != "h3")


def test_empty_table(spark):
    assert judged(spark, []).collect() == []
