"""Tables in hash buckets of their key, so that an upsert rewrites the buckets it touches alone.

A row lies in the folder of its bucket, a hash of its key modulo the number of buckets. A batch
reads the buckets its keys fall into and writes them again by dynamic partition overwrite: the
files of other buckets stay as they are. Spark writes the new files aside and puts them in place
when the job is done, bucket by bucket; one writer at a time is assumed, and an upsert that was cut
off is repeated as a whole, which gives the same rows.

The number of buckets belongs to the table. Choose it so that a bucket is about as large as a task
should read; a batch of a few keys then costs a few buckets, whatever the size of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.operators.merging import last_per_key, put
from skyledger.operators.shared import exists, settle

BUCKETS = 16
BUCKET = "bucket"


class OtherBucketsError(Exception):
    """The table was written with another number of buckets."""


@dataclass(frozen=True)
class BucketedTable:
    path: str
    schema: StructType
    key: str
    buckets: int = BUCKETS

    @property
    def folder(self) -> str:
        return f"{self.path}/of_{self.buckets}"

    def there(self, spark: SparkSession) -> bool:
        if exists(spark, self.folder):
            return True
        if exists(spark, self.path):
            raise OtherBucketsError(f"{self.path} has not {self.buckets} buckets")
        return False

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _rows(self, spark: SparkSession) -> DataFrame:
        """All rows with their bucket; none of a table that was never written."""
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        if not self.there(spark):
            return spark.createDataFrame([], f"{names}, {BUCKET} int")
        return spark.read.schema(f"{names}, {BUCKET} int").parquet(self.folder)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark).drop(BUCKET)

    def of_keys(self, keys: DataFrame) -> DataFrame:
        """Rows of the buckets that some keys fall into; others are not opened."""
        touched = [r[0] for r in keys.select(self.bucket()).distinct().collect()]
        return self._rows(keys.sparkSession).where(F.col(BUCKET).isin(touched))

    def upsert(self, batch: DataFrame, order: Column | None = None) -> int:
        """Insert or replace by key; returns the number of rows the batch put in place.

        A null key is refused. Of rows that share a key the last by `order` counts.
        """
        spark = batch.sparkSession
        columns = self.schema.fieldNames()
        incoming = last_per_key(batch.select(*columns, *_more(batch, columns)), self.key, order)
        incoming = settle(incoming.select(*columns).withColumn(BUCKET, self.bucket()), "batch")
        if incoming.rows == 0 and self.there(spark):
            return 0
        merged = put(self.of_keys(incoming.frame.select(self.key)), incoming, self.key)
        merged.repartition(BUCKET).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(BUCKET).parquet(self.folder)
        return incoming.rows


def _more(batch: DataFrame, columns: list[str]) -> list[str]:
    """Columns of a batch that only its order needs."""
    return [c for c in batch.columns if c not in columns]
