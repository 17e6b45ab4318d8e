"""CSV and JSON readers with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skyledger.functions.text import blank_to_null
from skyledger.sources.arrays import array_records

# A quote inside a quoted cell is written twice, as most CSV tools do.
CSV_TEXT = {"quote": '"', "escape": '"'}


# Cells that dataframe readers take as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _header_groups(
    spark: SparkSession, path: str, mixed_headers: bool
) -> list[tuple[list[str], str | list[str]]]:
    """Column names as the files' headers give them, each with the path or files to read so.

    The header of one file is taken for all, and a file with another one fails the read. With
    `mixed_headers` the files are scanned once for their first lines and grouped by them.
    """
    if not mixed_headers:
        return [(spark.read.csv(path, header=True, **CSV_TEXT).columns, path)]
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = first.groupBy("header").agg(F.collect_list("file").alias("files")).collect()
    return [
        (spark.read.csv(r["files"][0], header=True, **CSV_TEXT).columns, r["files"]) for r in groups
    ]


def _by_header(
    spark: SparkSession,
    path: str,
    declared: StructType,
    optional: Sequence[str],
    mixed_headers: bool,
    **options: object,
) -> DataFrame:
    """Declared columns by name and in their order, then all others as text.

    A declared column that no header has is null if it is optional, and an error otherwise.
    """
    types = {f.name: f.dataType for f in declared}
    parts = []
    for names, files in _header_groups(spark, path, mixed_headers):
        absent = [c for c in types if c not in names]
        refused = [c for c in absent if c not in optional]
        if refused:
            raise MissingColumnsError(f"{path} has no column {', '.join(refused)}")
        schema = StructType([StructField(c, types.get(c, StringType())) for c in names])
        # Files are held to the header that the names were taken from.
        read = spark.read.schema(schema).csv(files, header=True, enforceSchema=False, **options, **CSV_TEXT)
        nulls = {c: F.lit(None).cast(types[c]) for c in absent}
        others = [c for c in names if c not in types]
        parts.append(read.withColumns(nulls).select(*types, *others))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class MissingColumnsError(Exception):
    """A file lacks a column that it has to have."""


def read_csv_text(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    missing: Sequence[str] = (),
    line_breaks: bool = False,
    optional: Sequence[str] = (),
    mixed_headers: bool = False,
) -> DataFrame:
    """Every cell as text, found by the name in the header; columns beside those named follow.

    Blank cells and `missing` texts become null, others keep their spaces. Cells with line breaks
    need `line_breaks`, at the price of files that cannot be split.
    """
    declared = StructType([StructField(c, StringType()) for c in columns])
    raw = _by_header(spark, path, declared, optional, mixed_headers, multiLine=line_breaks)
    cells = {c: F.when(~F.col(c).isin(*missing), F.col(c)) if missing else c for c in raw.columns}
    return raw.select(*(blank_to_null(cell).alias(c) for c, cell in cells.items()))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    optional: Sequence[str] = (),
    mixed_headers: bool = False,
) -> DataFrame:
    """Typed columns, found by name, and others as text; a malformed cell fails the read."""
    return _by_header(spark, path, schema, optional, mixed_headers, mode="FAILFAST")


def read_json(
    spark: SparkSession, path: str, schema: StructType, lines: bool = True
) -> DataFrame:
    """JSON Lines by default. `lines=False` reads one array per file, which cannot be split."""
    return spark.read.schema(schema).json(path, multiLine=not lines, mode="FAILFAST")


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: StructType,
    required: Sequence[str] = (),
    lines: bool = False,
) -> DataFrame:
    """Strict read that also tells absent keys from null values.

    The column `missing_keys` lists required keys a record does not have, and `other_keys` maps
    keys that are not in the schema to their values as text. With `lines=False`
    each file must hold a JSON array of objects, which any number of tasks read; another root, or text
    that is not JSON, fails the read.
    """
    if lines:
        records = spark.read.text(path).where(F.trim("value") != "").select(
            F.col("value").alias("record")
        )
    else:
        records = array_records(spark, path)
    options = {"mode": "FAILFAST"}
    keys = F.json_object_keys("record")
    wanted = F.array(*(F.lit(k) for k in required)).cast("array<string>")
    declared = F.array(*(F.lit(k) for k in schema.fieldNames()))
    # A value as JSON text, whatever it is.
    values = F.from_json("record", "map<string,string>", options)
    return records.select(
        F.from_json("record", schema, options).alias("fields"),
        F.array_except(wanted, keys).alias("missing_keys"),
        F.map_filter(values, lambda k, _: ~F.array_contains(declared, k)).alias("other_keys"),
    ).select("fields.*", "missing_keys", "other_keys")
