import pytest
from pyspark.sql import functions as F

from skyledger.operators.profile import column_profile
from skyledger.operators.quality import (
    DataCheckError,
    accepted_values,
    custom,
    not_null,
    quality_report,
    require_fields,
    require_key,
    require_rows,
    settle_checked,
    unique,
)
from skyledger.plans.suite import suite
from tests.conftest import rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1, "delivered", -1.0), (1, "lost", 2.0), (None, None, None), (2, "delivered", 3.0)],
        "id int, status string, amount double",
    )


def test_seeded_violations_are_found(table):
    checks = [
        *not_null("t", "id", "amount"),
        *unique("t", "id"),
        *accepted_values("t", "status", ["delivered", "cancelled"]),
        *custom("t", "negative", "amount", (F.col("amount") < 0) & (F.col("status") == "delivered")),
        *custom("t", "huge", "amount", F.col("amount") > 100),
    ]
    found = {(r.check_name, r.column_name): (r.violations, r.passed)
             for r in quality_report({"t": table}, checks).collect()}
    assert found == {
        ("not_null", "id"): (1, False), ("not_null", "amount"): (1, False),
        ("unique", "id"): (1, False), ("accepted_values", "status"): (1, False),
        ("negative", "amount"): (1, False), ("huge", "amount"): (0, True),
    }


def test_checks_ride_on_the_write(spark, table):
    """The same report, and the stored table is read for keys alone."""
    checks = [*not_null("t", "id", "amount"), *unique("t", "id"), *accepted_values("t", "status", ["delivered"])]
    checked = settle_checked(checks, t=table, u=table.where("false"))
    report = quality_report(checked, checks)
    assert rows(report) == rows(quality_report({"t": table}, checks))
    assert report.where("table_name = 'u'").count() == 0
    scans = [x for x in report._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert scans and all("ReadSchema: struct<id:" in x and "amount" not in x for x in scans)
    empty = settle_checked(checks, t=table.where("false"))
    assert {r.violations for r in quality_report(empty, checks).collect()} == {0}


def test_an_empty_table_breaks_nothing(table):
    checks = [*not_null("t", "id"), *unique("t", "id")]
    report = quality_report({"t": table.where("false")}, checks)
    assert [r.violations for r in report.collect()] == [0, 0]


def test_the_suite_holds_all_checks(spark):
    kinds = [c.name for c in suite()]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (15, 6, 2)
    assert len(kinds) == 25


def test_gates(spark, table):
    good = table.where("id is not null")
    assert require_rows(good) is good
    with pytest.raises(DataCheckError, match="orders is empty"):
        require_rows(table.where("false"), "orders")
    assert require_fields(good, ["id", "amount"], "id") is good
    missing = spark.createDataFrame([(7, None), (3, 1)], "id int, amount int")
    with pytest.raises(DataCheckError, match="record 7 is missing field: amount"):
        require_fields(missing, ["id", "amount"], "id")
    with pytest.raises(DataCheckError, match="record None is missing field: id"):
        require_fields(table, ["id"], "id")
    with pytest.raises(DataCheckError, match="missing field: nowhere"):
        require_fields(good, ["nowhere"], "id")
    with pytest.raises(DataCheckError, match="occurs 2 times"):
        require_key(good, "id")
    with pytest.raises(DataCheckError, match="key .None,. occurs 1 times"):
        require_key(table.where("id is null or id = 2"), "id")
    unique_rows = good.where("id = 2")
    assert require_key(unique_rows, "id") is unique_rows


def test_profile(spark):
    data = spark.createDataFrame(
        [(1, "b"), (2, "a"), (3, "a"), (4, "b"), (5, None)], "id int, city string"
    )
    # b and a tie; b was seen first.
    assert rows(column_profile(data, "city", "id")) == [("city", 5, 2, "b", 1)]
    assert rows(column_profile(data.where("false"), "city", "id")) == [("city", 0, 0, None, 0)]
    nulls = spark.createDataFrame([(i, None) for i in range(4)], "id int, city string")
    assert rows(column_profile(nulls, "city", "id")) == [("city", 4, 0, None, 4)]
