"""SQL of the conversation repair, for an engine without Spark: the program run from the last row.

Here a state holds the best way to the end as (cost, audit, lines), so candidates of a state differ
in their first letter and the least struct is the answer; the operator runs from the first row.
"""

from __future__ import annotations

NEVER = 1_000_000_000
STATES = ("nothing", "system", "user", "assistant")
THEN = {"nothing": "user", "system": "user", "user": "assistant", "assistant": "user"}


def _checksum(name: str) -> str:
    """CRC-32 of an ASCII text, half a byte at a time."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    halves = f"flatten(list_transform(string_split({name}, ''), lambda c: [ascii(c) & 15, ascii(c) >> 4]))"
    step = f"xor(list_extract({table}, (xor(x, y) & 15) + 1), x >> 4)"
    return f"xor(list_reduce(list_prepend(4294967295, {halves}::BIGINT[]), lambda x, y: {step}), 4294967295)"


def _way(cost: str, audit: str, lines: str) -> str:
    return f"{{'c': {cost}, 'a': {audit}, 'l': {lines}}}"


def _after(way: str, cost: str, letter: str, *lines: str) -> str:
    """A way with edits before it."""
    made = f"list_concat([{', '.join(lines)}], {way}.l)" if lines else f"{way}.l"
    return _way(f"{way}.c + {cost}", f"'{letter}' || {way}.a", made)


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _consumed(state: str) -> str:
    """The best way if the next edit takes the row."""
    then = THEN[state]
    keeps = [(then, then)] + ([("system", "system")] if state == "nothing" else [])
    ways = [_after(f"f.{state}", "3", "D")]
    options = [(f"letter = '{to[0]}'", _after(f"f.{to}", "cut", "K", "line")) for _, to in keeps]
    options.append(("TRUE", _after(f"f.{then}", "2 + cut", "R", f"'{then}:' || text")))
    for holds, way in options:
        ways.append(f"CASE WHEN NOT must AND {holds} THEN {way} ELSE {_way(str(NEVER), repr(''), '[]::VARCHAR[]')} END")
    return _least(*ways)


def _inserted(state: str, at: str) -> str:
    """The best way if rows may be inserted first."""
    first, second = THEN[state], THEN[THEN[state]]
    ways = [f"{at}.{state}", _after(f"{at}.{first}", "2", "I", f"'{first}:'")]
    if state in ("nothing", "system"):
        ways.append(_after(f"{at}.{second}", "4", "II", f"'{first}:'", f"'{second}:'"))
    return _least(*ways)


_END = {
    s: _way("0" if s in ("nothing", "assistant") else str(NEVER), "''", "[]::VARCHAR[]") for s in STATES
}
_CONSUMED = ", ".join(f"{_consumed(s)} AS {s}" for s in STATES)
_INSERTED = ", ".join(f"{_inserted(s, 'g')} AS {s}" for s in STATES)
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPAIR_SQL = f"""
        WITH RECURSIVE
        named AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
          FROM conversations),
        kinds AS (SELECT *, {_checksum("name")} % 20 AS kind FROM named),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
            unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
          FROM kinds),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i
          FROM damaged),
        judged AS (
          SELECT *, substring(role, 1, 1) AS letter, role || ':' || text AS line,
            CASE WHEN rtrim(text, {_SPACE}) = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(rtrim(text, {_SPACE}), 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
          FROM placed),
        costed AS (
          SELECT *, fault IN ('blank', 'duplicate') AS must, CAST(fault = 'truncated' AS INT) AS cut,
            lag(letter) OVER (PARTITION BY conv_id ORDER BY i) AS before
          FROM judged),
        ends AS (
          SELECT conv_id, COUNT(i) AS n FROM (SELECT DISTINCT conv_id FROM conversations) a
          LEFT JOIN (SELECT conv_id AS c, i FROM placed) b ON a.conv_id IS NOT DISTINCT FROM b.c
          GROUP BY conv_id),
        ways AS (
          SELECT conv_id, n + 1 AS i, {", ".join(f"{_inserted(s, 'g')} AS {s}" for s in STATES)}
          FROM ends, (SELECT {", ".join(f"{w} AS {s}" for s, w in _END.items())}) g
          UNION ALL
          SELECT conv_id, i, {_INSERTED}
          FROM (SELECT f.conv_id, r.i, {_CONSUMED}
                FROM ways f JOIN costed r ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = f.i - 1) g),
        counts AS (
          SELECT conv_id, coalesce(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
            COUNT(*) FILTER (WHERE fault = 'blank') AS blank, COUNT(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
            COUNT(*) FILTER (WHERE fault = 'truncated') AS truncated,
            COUNT(*) FILTER (WHERE before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal
          FROM costed GROUP BY conv_id)
        SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
          coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
          CAST(w.nothing.c AS BIGINT) AS cost, w.nothing.a AS audit,
          sha256(array_to_string(w.nothing.l, chr(10))) AS repaired_sha256
        FROM ways w LEFT JOIN counts c ON w.conv_id IS NOT DISTINCT FROM c.conv_id WHERE w.i = 1"""
