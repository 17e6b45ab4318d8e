import os
from functools import reduce

import pytest

from skyledger.operators.merging import open_history, snapshot
from skyledger.schemas import DOUBLE, LONG, TEXT, schema
from skyledger.sources.history import HistoryTable
from tests.conftest import rows

SCHEMA = schema(id=LONG, city=TEXT, status=TEXT, amount=DOUBLE)
LOOKS = [
    [(1, "a", "new", 1.0), (2, "b", "new", None), (3, "c", "new", 3.0)],
    [(1, "a", "done", 1.0), (2, "B", "new", 2.0), (4, "d", "new", 4.0)],
    [(1, "a", "new", 1.0), (1, "a", "new", 0.5), (2, "B", "new", None), (3, "c", "new", 3.0)],
    [(4, "d", None, 4.0), (5, "e", "", 0.0)],
]


def files(folder):
    return {
        os.path.join(f, n): os.stat(os.path.join(f, n)).st_mtime_ns
        for f, _, names in os.walk(folder) for n in names if n.endswith(".parquet")
    }


def test_equals_the_plain_history_and_leaves_closed_versions_alone(spark, tmp_path):
    table = HistoryTable(str(tmp_path / "h"), SCHEMA, "id", ("status", "amount"), 7)
    frames = [spark.createDataFrame(look, SCHEMA) for look in LOOKS]
    plain, seen, closed = None, [], {}
    for version, frame in enumerate(frames, 1):
        plain = open_history(frame, 1) if plain is None else snapshot(plain, frame, "id", ["status", "amount"], version)
        table.look(frame, version)
        assert rows(table.read(spark)) == rows(plain)
        now = files(table.closed_folder)
        assert {f: now[f] for f in closed} == closed
        closed = now
        seen.append(rows(table.as_of(spark, version).drop("valid_to")))
    for version, then in enumerate(seen, 1):
        assert rows(table.as_of(spark, version).drop("valid_to")) == then
        kept = plain.where(f"valid_from <= {version} and (valid_to is null or valid_to > {version})")
        assert rows(kept.drop("valid_to")) == then
    assert rows(table.as_of(spark, 0)) == []
    later = table.as_of(spark, 3)._jdf.queryExecution().executedPlan().toString()
    assert "valid_to" in later.split("PartitionFilters")[-1]


def test_a_look_writes_what_changed(spark, tmp_path):
    table = HistoryTable(str(tmp_path / "h"), SCHEMA, "id", ("status",), 40)
    many = [(i, "a", "new", 1.0) for i in range(600)]
    assert table.look(spark.createDataFrame(many, SCHEMA), 1) == {"opened": 600, "closed": 0}
    before = files(table.open.folder)
    assert table.look(spark.createDataFrame(many, SCHEMA), 2) == {"opened": 0, "closed": 0}
    assert files(table.open.folder) == before
    many[5] = (5, "a", "done", 1.0)
    assert table.look(spark.createDataFrame(many, SCHEMA), 3) == {"opened": 1, "closed": 1}
    assert len(set(before.items()) - set(files(table.open.folder).items())) == 1


def test_a_repeated_look_changes_nothing(spark, tmp_path):
    table = HistoryTable(str(tmp_path / "h"), SCHEMA, "id", ("status", "amount"), 3)
    for version in (1, 2, 2):
        table.look(spark.createDataFrame(LOOKS[version - 1], SCHEMA), version)
    expected = reduce(
        lambda h, v: snapshot(h, spark.createDataFrame(LOOKS[v - 1], SCHEMA), "id", ["status", "amount"], v),
        [2], open_history(spark.createDataFrame(LOOKS[0], SCHEMA), 1),
    )
    assert rows(table.read(spark)) == rows(expected)
    with pytest.raises(Exception, match="the key id is null"):
        table.look(spark.createDataFrame([(None, "a", "b", 1.0)], SCHEMA), 3)
