"""Tables and files that one step writes to the shared folder and a later step reads."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from skyledger.operators.shared import scratch_path, shared_folder

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_folders(spark: SparkSession) -> set[str]:
    """Folders of intermediate tables and files that this application has written so far."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/skyledger/{spark.sparkContext.applicationId}")
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().toString() for s in files.listStatus(top)} if files.exists(top) else set()


def spread(files: DataFrame, n: int) -> DataFrame:
    """Rows that name files, one task for each up to a bound; small rows would share a task."""
    return files.repartition(max(1, min(n, 100_000)))


def with_columns_of(df: DataFrame, schema: StructType) -> StructType:
    """The schema of a frame followed by further fields."""
    return StructType([*df.schema.fields, *schema.fields])


BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def ready(spark: SparkSession) -> None:
    """What Python stages need of a session.

    Workers on this machine can import the package (a cluster gets it by --py-files), and batches
    of texts are small: both the JVM and the worker hold a batch or two beside their own memory.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(
            [PACKAGE_ROOT, *filter(None, paths)]
        )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def gathered(batches: Iterator[pa.RecordBatch], n_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches put together up to a number of bytes; a batch is never split."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= n_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def release_memory() -> None:
    """Give freed buffers back to the machine; a worker lives on through all tasks of a stage.

    Arrow and the C library (numpy's arrays, Python's large objects) each keep what was freed.
    """
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI or an absolute path."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class WholeFile:
    """Output stream that appears under its name only when it was written to the end.

    Every attempt of a task writes under a name of its own, so a lost or repeated attempt leaves
    the file of another one alone; the last to finish gives it its name.
    """

    def __init__(self, uri: str):
        self.files, self.path = file_system(uri)
        self.partial = f"{self.path}.{uuid.uuid4().hex}.partial"

    def __enter__(self):
        self.files.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.files.open_output_stream(self.partial, compression=None)
        return self.out

    def __exit__(self, failed, *_):
        self.out.close()
        if failed:
            self.files.delete_file(self.partial)
        else:
            self.files.move(self.partial, self.path)
