"""Intermediate tables in the shared folder of the cluster.

A result that several steps need is written once and read back. That cuts the lineage, survives
lost executors, and gives an exact row count on which the next step can base its join strategy.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

T = TypeVar("T")


@dataclass(frozen=True)
class Settled:
    """A table on shared storage, with the rows and (roughly) the bytes written to it."""

    frame: DataFrame
    rows: int
    size: int


def shared_folder(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; local sessions without one get their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skyledger-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, grouped by application so that finished runs can be dropped as a whole."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/skyledger/{app}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever storage its path names."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application, once nothing reads them any more."""
    app = spark.sparkContext.applicationId
    remove(spark, f"{shared_folder(spark)}/skyledger/{app}")


def settle(df: DataFrame, label: str = "table") -> Settled:
    """Write a frame to the shared folder. Rows and bytes are counted while it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    written = Observation()
    df.observe(
        written,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("size"),
    ).write.parquet(path)
    frame = spark.read.schema(df.schema).parquet(path)
    return Settled(frame, written.get["rows"], written.get["size"])


def together(spark: SparkSession, *actions: Callable[[], T]) -> list[T]:
    """Run actions that do not depend on each other at the same time; results in their order."""
    run = inheritable_thread_target(spark)(lambda action: action())
    with ThreadPoolExecutor(len(actions)) as pool:
        return list(pool.map(run, actions))


def _row_bytes(df: DataFrame) -> Column:
    """Length of the texts of a row, of nested columns as JSON, and eight bytes for any other."""
    fixed = 0
    sizes = []
    for field in df.schema:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (StringType, BinaryType)):
            sizes.append(F.octet_length(column))
        elif isinstance(kind, (ArrayType, MapType, StructType, VariantType)):
            sizes.append(F.octet_length(F.to_json(F.struct(column))))
        else:
            fixed += 8
    start = F.lit(fixed).cast("bigint")
    return reduce(add, (F.coalesce(size, F.lit(0)) for size in sizes), start)
