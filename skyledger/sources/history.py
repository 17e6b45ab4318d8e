"""Type-2 history as a table: a look at the source writes what changed and nothing else.

Open versions lie in hash buckets of the key, each with a digest of the checked columns. A look at
the source compares digests, writes the versions it closes into a folder of their own, and puts new
versions in place in the buckets they touch. Closed versions are never read or written again by
later looks; folders are named by the version that closed them, so a reader of an earlier version
opens only folders that were closed after it.

A look that was cut off is repeated as a whole: closed versions that were written before are taken
as they are, and open ones that were put in place before compare as unchanged. One writer at a time
is assumed, and versions rise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from skyledger.operators.lookups import BROADCAST_BYTES, BROADCAST_ROWS
from skyledger.operators.merging import last_per_key
from skyledger.operators.shared import Settled, exists, settle
from skyledger.sources.buckets import BUCKETS, BucketedTable

DIGEST, FROM, TO = "_digest", "valid_from", "valid_to"


@dataclass(frozen=True)
class HistoryTable:
    path: str
    schema: StructType
    key: str
    checked: tuple[str, ...]
    buckets: int = BUCKETS

    @cached_property
    def open(self) -> BucketedTable:
        fields = [*self.schema.fields, StructField(FROM, LongType()), StructField(DIGEST, StringType())]
        return BucketedTable(f"{self.path}/open", StructType(fields), self.key, self.buckets)

    @property
    def closed_folder(self) -> str:
        return f"{self.path}/closed"

    def digest(self) -> Column:
        """A digest of the checked columns; null differs from any text."""
        cells = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(self.checked)))
        return F.sha2(F.to_json(cells, {"ignoreNullFields": "false"}), 256)

    def look(self, source: DataFrame, version: int) -> dict[str, int]:
        """One more look at the source: how many versions it opened and closed.

        A key whose checked columns changed has its open version closed and a new one opened, a new
        key opens a version, a key that left the source keeps its open version. Of rows that share
        a key the greatest counts; a null key is refused.
        """
        spark = source.sparkSession
        names = self.schema.fieldNames()
        arriving = last_per_key(source.select(*names), self.key).withColumn(DIGEST, self.digest())
        known = self.open.read(spark).select(F.col(self.key), F.col(DIGEST).alias("_old"))
        # Only keys and digests of the open versions are read here.
        beside = arriving.join(known, self.key, "left")
        changed = settle(
            beside.where(~F.col(DIGEST).eqNullSafe(F.col("_old"))).withColumn(FROM, F.lit(version).cast("bigint")),
            "changed_versions",
        )
        folder = f"{self.closed_folder}/{TO}={version}"
        if not exists(spark, folder):
            self._close(changed, folder)
        closed = spark.read.schema(self._closed_schema()).parquet(folder).count()
        opened = changed.frame.drop("_old")
        self.open.upsert(opened)
        return {"opened": changed.rows, "closed": closed}

    def _close(self, changed: Settled, folder: str) -> None:
        keys = changed.frame.where(F.col("_old").isNotNull()).select(F.col(self.key).alias("_key"))
        if changed.rows <= BROADCAST_ROWS and changed.size <= BROADCAST_BYTES:
            keys = F.broadcast(keys)
        open_rows = self.open.of_keys(changed.frame.select(self.key))
        ended = open_rows.join(keys, open_rows[self.key] == keys["_key"], "left_semi")
        ended.select(*self.schema.fieldNames(), FROM).write.parquet(folder)

    def _closed_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(FROM, LongType())])

    def _closed(self, spark: SparkSession) -> DataFrame:
        schema = StructType([*self._closed_schema().fields, StructField(TO, LongType())])
        if not exists(spark, self.closed_folder):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.closed_folder)

    def read(self, spark: SparkSession) -> DataFrame:
        """All versions with `valid_from` and `valid_to`, which is null for open ones."""
        return self._open(spark).unionByName(self._closed(spark))

    def _open(self, spark: SparkSession) -> DataFrame:
        return self.open.read(spark).drop(DIGEST).withColumn(TO, F.lit(None).cast("bigint"))

    def as_of(self, spark: SparkSession, version: int) -> DataFrame:
        """The rows as a look of that version left them; folders closed by then are not opened."""
        closed = self._closed(spark).where(F.col(TO) > version)
        return self._open(spark).unionByName(closed).where(F.col(FROM) <= version)
