"""Every registered query against its SQL in an independent engine."""

import pytest

import __spark_entry__ as registered
from tests.compare import difference

QUERIES, ORACLES = registered.QUERIES, registered.ORACLES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_gives_city_rows(spark):
    first = registered.entry(spark)
    assert first.columns == registered.entry(spark).columns
    assert first.count() == 25


# Neither per-row Python nor a join that pairs everything with everything.
UNWANTED = ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert difference(frame, con, ORACLES[name]) == ""
