"""Landed weather payloads to a table of readings, file by file, each exactly once.

This stands in for a task that waits for a file and then loads it: every run takes the files that
arrived since the last one and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger import schemas
from skyledger.sources.payloads import flatten_payloads, is_broken


def landed_readings(spark: SparkSession, payload_path: str) -> DataFrame:
    stream = spark.readStream.schema(schemas.PAYLOAD).json(payload_path, mode="FAILFAST")
    return flatten_payloads(stream)


def failed_payloads(spark: SparkSession, payload_path: str) -> DataFrame:
    """City and file of each landed payload that has no readings to give."""
    stream = spark.readStream.schema(schemas.PAYLOAD).json(payload_path, mode="FAILFAST")
    return stream.where(is_broken()).select("city", F.col("_metadata.file_name").alias("file"))


def _append(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def load_landed(
    spark: SparkSession, payload_path: str, out: str, checkpoint: str
) -> StreamingQuery:
    return _append(landed_readings(spark, payload_path), out, checkpoint)


def report_failed(
    spark: SparkSession, payload_path: str, out: str, checkpoint: str
) -> StreamingQuery:
    """Beside load_landed, with a checkpoint of its own: what it could not read."""
    return _append(failed_payloads(spark, payload_path), out, checkpoint)
