import base64
import hashlib
import io
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyledger.llm import warc

SCHEMA = "page_id bigint, url string, html string, record_type string, refers_to string"
PAGES = [
    (5, "http://a/", "<p>same</p>", "x", "y"), (2, "http://b/\r\nX: y", "<p>same</p>", "x", None),
    (9, None, "<p>same</p>", None, None), (3, "http://c/", None, None, None),
    (4, "http://d/", "", None, None), (7, "http://e/", "é\r\n\r\nWARC/1.1\r\n" * 30_000, None, None),
    (2, "http://b/\r\nX: y", "<p>same</p>", "x", None), (None, "http://f/", "<p>same</p>", None, None),
    (8, "http://g/", "only", None, None),
]


@pytest.mark.parametrize("file_bytes", [1, warc.FILE_BYTES])
def test_archives_give_the_pages_back(spark, file_bytes):
    files = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), file_bytes)
    found = warc.read_archives(files).collect()
    first = {}
    for page_id, _, html, *_ in PAGES:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    wanted = Counter()
    for page_id, url, html, *_ in PAGES:
        raw = (html or "").encode()
        own = first[html or ""] == page_id
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        wanted[page_id, "response" if own else "revisit", None if own else first[html or ""],
               len(raw), digest, raw if own else None] += 1
    got = Counter(
        (r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
         None if r.payload is None else bytes(r.payload)) for r in found
    )
    assert got == wanted
    assert {r.url for r in found if r.page_id == 2} == {"http://b/%0D%0AX: y"}


def test_empty_table(spark):
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], SCHEMA))).collect() == []


def test_broken_archives_are_refused():
    good = warc.page_record(1, "http://a/", "text " * 50_000, None)
    assert len(list(warc.read_records(io.BytesIO(good * 3)))) == 3
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(io.BytesIO(good[:-9])))
    raw = zlib.decompress(good, 31)
    for broken in (raw.replace(b"text text", b"test text", 1), raw.replace(b"Content-Length: 2", b"Content-Length: 1")):
        with pytest.raises(ValueError):
            warc.parse(broken)


def test_rows_of_one_frequent_payload_are_split(spark):
    """A third of the pages has one payload; the join is one that adaptive execution splits."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        html = F.when(F.col("id") % 3 == 0, "copy").otherwise(F.sha2(F.col("id").cast("string"), 512))
        pages = spark.range(6000, numPartitions=12).select(
            F.col("id").alias("page_id"), F.sha2(F.concat(F.lit("u"), "id"), 512).alias("url"), html.alias("html")
        )
        found = warc.with_responses(pages)
        assert len(found.collect()) == 6000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
