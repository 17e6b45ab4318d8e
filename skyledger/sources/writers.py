"""File sinks, and tables that are replaced as a whole.

A table is a folder with one sub-folder per version and a log of finished versions. A new version
is written beside the old one and counts only once its log row is there, so a failed or repeated
write never damages what readers see. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.operators.merging import last_per_key, put
from skyledger.operators.quality import DataCheckError, require_key
from skyledger.operators.shared import exists, remove, settle
from skyledger.sources.files import CSV_TEXT

KEEP_VERSIONS = 2
LOG = "version bigint, folder string"
# Spark trims cells on writing unless told otherwise.
KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


class TableNotFoundError(Exception):
    """No table has been created under the path."""


def write_json(df: DataFrame, path: str) -> None:
    """JSON Lines with explicit nulls; the whole folder is replaced."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, **CSV_TEXT, **KEEP_SPACES)


def write_split(df: DataFrame, flag: str, path: str) -> dict[str, int]:
    """Valid and failed rows into sub-folders in one write; returns the row counts.

    The folders are named by `rows`; the flag stays a column of the files, so it is read as it was.
    """
    written = Observation()
    counted = df.observe(
        written,
        F.coalesce(F.count_if(flag), F.lit(0)).alias("valid"),
        F.coalesce(F.count_if(~F.col(flag)), F.lit(0)).alias("failed"),
    )
    named = counted.withColumn("rows", F.when(F.col(flag), "valid").otherwise("failed"))
    named.write.mode("overwrite").partitionBy("rows").json(path, ignoreNullFields=False)
    valid, failed = written.get["valid"], written.get["failed"]
    return {"total": valid + failed, "valid": valid, "failed": failed}


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def create_table(spark: SparkSession, path: str) -> None:
    """Start an empty version log unless the table is there already."""
    spark.createDataFrame([], LOG).write.mode("ignore").parquet(f"{path}/versions")


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Finished versions that the log still names, oldest first; none for an absent table."""
    if not exists(spark, f"{path}/versions"):
        return []
    log = spark.read.schema(LOG).parquet(f"{path}/versions")
    return sorted((r["version"], r["folder"]) for r in log.collect())


def read_table(
    spark: SparkSession, path: str, schema: StructType, absent_as_empty: bool = False
) -> DataFrame:
    """Last finished version. Reading writes nothing; an absent table is an error.

    Where a table may not be there yet, `absent_as_empty` gives an empty frame. A table that was
    created and never written is empty.
    """
    versions = _versions(spark, path)
    if not versions:
        if not absent_as_empty and not exists(spark, f"{path}/versions"):
            raise TableNotFoundError(path)
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{versions[-1][1]}")


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    key: tuple[str, ...] = (),
    keep_versions: int = KEEP_VERSIONS,
) -> int:
    """Write a full new version, checking its key before it counts, and return its rows.

    The newest `keep_versions` stay, so that a reader of the one before is not disturbed; the
    folders of older ones, and of a write that failed its check, are removed.
    """
    spark = df.sparkSession
    create_table(spark, path)
    versions = _versions(spark, path)
    version = versions[-1][0] + 1 if versions else 1
    folder = f"v{version:06d}-{uuid.uuid4().hex}"
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by).parquet(
        f"{path}/{folder}"
    )
    if key:
        try:
            require_key(spark.read.schema(df.schema).parquet(f"{path}/{folder}"), *key)
        except DataCheckError:
            remove(spark, f"{path}/{folder}")
            raise
    # The log row is what makes the version current.
    log = spark.createDataFrame([(version, folder)], LOG).coalesce(1)
    log.write.mode("append").parquet(f"{path}/versions")
    for _, old in [*versions, (version, folder)][:-keep_versions]:
        remove(spark, f"{path}/{old}")
    return counted.get["rows"]


def upsert_table(
    batch: DataFrame, path: str, schema: StructType, key: str, order: Column | None = None
) -> int:
    """Insert or replace by key; returns the number of rows the batch put in place."""
    incoming = settle(last_per_key(batch, key, order), "batch")
    existing = read_table(batch.sparkSession, path, schema, absent_as_empty=True)
    replace_table(put(existing, incoming, key), path, key=(key,))
    return incoming.rows
