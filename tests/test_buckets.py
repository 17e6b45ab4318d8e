import math
import os

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.plans import incremental
from skyledger.sources.buckets import BucketedTable, OtherBucketsError
from tests.conftest import rows

SCHEMA = schemas.schema(id=schemas.LONG, city=schemas.TEXT, amount=schemas.DOUBLE)


def files_of(table):
    found = {}
    for folder, _, names in os.walk(table.folder):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found.setdefault(os.path.basename(folder), {})[name] = os.stat(path).st_mtime_ns
    return found


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "orders"), SCHEMA, "id", 50)
    spark_rows = spark.range(2000).select("id", F.lit("a").alias("city"), F.col("id").cast("double").alias("amount"))
    assert table.upsert(spark_rows) == 2000
    before = files_of(table)
    assert len(before) == 50
    batch = spark.createDataFrame([(7, "b", 1.0), (7, "c", 2.0), (5000, "d", None), (11, None, 3.0)], SCHEMA)
    assert table.upsert(batch, F.col("amount")) == 3
    after = files_of(table)
    touched = {f"bucket={r[0]}" for r in batch.select(table.bucket()).distinct().collect()}
    assert {b for b in after if after[b] != before.get(b)} == touched and len(touched) <= 3
    found = {r["id"]: (r["city"], r["amount"]) for r in table.read(spark).collect()}
    assert len(found) == table.read(spark).count() == 2001
    assert found[7] == ("c", 2.0) and found[11] == (None, 3.0) and found[5000] == ("d", None) and found[8] == ("a", 8.0)


def test_only_touched_buckets_are_read(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), SCHEMA, "id", 20)
    table.upsert(spark.range(500).select("id", F.lit("a").alias("city"), F.lit(1.0).alias("amount")))
    part = table.of_keys(spark.createDataFrame([(3,)], "id bigint"))
    assert len(part.inputFiles()) and part.select("bucket").distinct().count() == 1
    assert "PartitionFilters: [" in part._jdf.queryExecution().executedPlan().toString()


def test_odd_batches(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), SCHEMA, "id", 4)
    assert not table.there(spark) and table.read(spark).count() == 0
    assert table.upsert(spark.createDataFrame([], SCHEMA)) == 0
    with pytest.raises(Exception, match="the key id is null"):
        table.upsert(spark.createDataFrame([(None, "x", 1.0)], SCHEMA))
    extra = spark.createDataFrame([(1, "x", 1.0, 5, 9)], "id bigint, city string, amount double, bucket int, n int")
    assert table.upsert(extra, F.col("n")) == 1 and table.upsert(extra, F.col("n")) == 1
    assert rows(table.read(spark)) == [(1, "x", 1.0)]
    with pytest.raises(OtherBucketsError):
        BucketedTable(table.path, SCHEMA, "id", 8).read(spark)


def test_states_of_loads_equal_a_rebuild(spark, tmp_path):
    schema = "city string, status string, amount double, avg_temp double, revenue_per_degree double"
    first = [("a", "delivered", 0.1, 20.0, 1.5), ("a", "open", 0.2, None, None), ("b", "open", 5.0, 3.0, 0.1)]
    second = [("a", "delivered", 0.3, 20.0, 2.5), ("c", "open", None, None, None), (None, "open", 1.0, 1.0, 1.0)]
    table = incremental.city_table(str(tmp_path / "states"), spark)
    incremental.apply_load(table, spark.createDataFrame(first, schema))
    # The row of b moves to c, and the second of a is stated anew.
    incremental.apply_load(
        table, spark.createDataFrame([*second, ("a", "open", 0.7, None, None)], schema),
        spark.createDataFrame(first[1:], schema),
    )
    assert rows(incremental.city_mart(table.read(spark))) == [
        ("a", 3, math.fsum([0.1, 0.3, 0.7]), 0.37, 2, 20.0, 2.0), ("c", 1, None, None, 0, None, None)
    ]
