import json

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators.cleaning import (
    label_valid, process_orders, rejected_orders, resolve_cities, unknown_cities,
)
from skyledger.operators.quality import DataCheckError
from skyledger.plans import jobs
from skyledger.sources import files, messy, payloads
from skyledger.sources.registry import source, table_path
from skyledger.sources.writers import (
    TableNotFoundError, publish_view, read_table, replace_table, upsert_table, write_csv, write_json,
)
from skyledger.streaming.landing import load_landed
from tests.conftest import rows

# Columns in an order of the file's own, with one that no job knows.
ORDERS_CSV = """amount,id,note,status,city
19.25,11,first,open,Oslo
200.00,12,,closed,Lisbon
,13,x,open,Oslo
7.50,14,x,open,Quito
8.00,15,x,held,
9,16,"a ""b"", c",open,   
"""
READINGS = [("Oslo ", "2025-03-01T00:00", 4.0), ("oslo", "2025-03-01T01:00", 5.0),
            ("lisbon", "2025-03-01T00:00", None), ("Quito", "bad", 12.5)]


@pytest.fixture
def orders_csv(tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(ORDERS_CSV)
    return str(path)


def test_csv_text_and_typed(spark, orders_csv):
    columns = schemas.ORDERS_RAW.fieldNames()
    text = files.read_csv_text(spark, orders_csv, columns)
    assert text.columns == [*columns, "note"]
    assert rows(text, "id")[4:] == [
        ("15", None, "8.00", "held", "x"), ("16", None, "9", "open", 'a "b", c')
    ]
    with pytest.raises(files.MissingColumnsError, match="courier"):
        files.read_csv_text(spark, orders_csv, [*columns, "courier"])
    lax = files.read_csv_text(spark, orders_csv, [*columns, "courier"], optional=["courier"])
    assert {r.courier for r in lax.collect()} == {None}
    typed = files.read_csv(spark, orders_csv, schemas.schema(
        id=schemas.LONG, city=schemas.TEXT, amount=schemas.DOUBLE, status=schemas.TEXT
    ))
    assert rows(typed.select("id", "amount"), "id")[:3] == [(11, 19.25), (12, 200.0), (13, None)]


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,city\n1,Oslo\n")
    (tmp_path / "b.csv").write_text("city,extra,id\nQuito,e,2\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv_text(spark, str(tmp_path), ["id", "city"]).collect()
    read = files.read_csv_text(spark, str(tmp_path), ["id", "city"], mixed_headers=True)
    assert rows(read.select("id", "city", "extra"), "id") == [("1", "Oslo", None), ("2", "Quito", "e")]


def test_csv_keeps_spaces_and_quotes(spark, tmp_path):
    data = spark.createDataFrame([("1", '  a "b", c '), ("2", None)], "id string, v string")
    write_csv(data, str(tmp_path / "t"))
    assert rows(files.read_csv_text(spark, str(tmp_path / "t"), ["id", "v"])) == rows(data)


def test_json_keeps_nulls(spark, tmp_path):
    data = spark.createDataFrame([("1", None)], "id string, v string").coalesce(1)
    write_json(data, str(tmp_path / "a" / "t"))
    part = next((tmp_path / "a" / "t").glob("*.json"))
    assert json.loads(part.read_text()) == {"id": "1", "v": None}


def test_strict_json(spark, tmp_path):
    path = tmp_path / "orders.json"
    records = [
        {"id": 1, "city": " Kuwait City ", "amount": "1,200.50 KD", "status": "new", "note": "x"},
        {"id": 2, "city": "Cairo", "amount": -5, "status": "new"},
        {"id": 3, "city": "Cairo", "amount": 0, "status": "new"},
        {"id": 4, "amount": 3},
        {"id": 5, "city": None, "amount": 3, "status": None},
        {"id": 6, "city": "Dubai", "amount": "N/A", "status": "new"},
    ]
    path.write_text(json.dumps(records, indent=1))
    read = files.read_json_records(spark, str(path), schemas.ORDERS_JSON, ["id", "city", "amount", "status"])
    good = process_orders(read, missing_keys="missing_keys")
    kept = good.select("id", "city", "amount", "status", F.col("other_keys")["note"])
    assert rows(kept, "id") == [
        ("1", "kuwait_city", 1200.5, "new", "x"), ("2", "cairo", -5.0, "new", None)
    ]
    bad = rejected_orders(read, missing_keys="missing_keys").select("id", "reason")
    assert rows(bad) == [
        ("3", "No usable amount"), ("4", "Missing required keys: city, status"), ("5", "No city"),
        ("6", "No usable amount"),
    ]
    out = str(tmp_path / "judged")
    counts = jobs.process_orders_file(spark, str(path), out)
    assert counts == {"total": 6, "valid": 2, "failed": 4}
    assert spark.read.json(out).where("is_valid").count() == 2


@pytest.mark.parametrize("text", ['{"id": 1}', "[{]", "not json"])
def test_json_that_is_not_an_array_fails(spark, tmp_path, text):
    path = tmp_path / "orders.json"
    path.write_text(text)
    with pytest.raises(Exception):
        files.read_json_records(spark, str(path), schemas.ORDERS_JSON, ["id"]).collect()


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_json_records(spark, str(tmp_path / "none"), schemas.ORDERS_JSON)


def test_a_column_missing_everywhere_rejects_every_row(spark):
    data = spark.createDataFrame([(1, "a")], "id int, city string")
    assert process_orders(data).count() == 0
    assert rows(rejected_orders(data).select("reason")) == [
        ("Missing required keys: amount, status",)
    ]
    assert rows(label_valid(data).select("is_valid")) == [(False,)]


def test_split(spark, orders_csv, tmp_path):
    out = str(tmp_path / "split")
    assert jobs.split_orders_file(spark, orders_csv, out) == {"total": 6, "valid": 3, "failed": 3}
    failed = spark.read.json(f"{out}/rows=failed")
    assert sorted(r.id for r in failed.collect()) == ["13", "15", "16"]


def test_payloads(spark, tmp_path):
    lines = [
        {"city": "Cairo", "hourly": {"time": ["t1", "t2", "t3"], "temperature_2m": [1.0, None]}},
        {"city": "Dubai", "hourly": {"time": ["t1"], "temperature_2m": [5.0, 6.0]}},
        {"city": "Empty", "hourly": {"time": [], "temperature_2m": []}},
    ]
    path = tmp_path / "landed"
    path.mkdir()
    (path / "a.json").write_text("\n".join(json.dumps(x) for x in lines[:1]))
    (path / "b.json").write_text("\n".join(json.dumps(x) for x in lines[1:]))
    expected = [("Cairo", "t1", 1.0), ("Cairo", "t2", None), ("Dubai", "t1", 5.0)]
    read = payloads.flatten_payloads(payloads.read_payloads(spark, str(path)))
    assert rows(read) == expected

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    load_landed(spark, str(path), out, checkpoint).awaitTermination()
    stored = spark.read.schema(schemas.READINGS).parquet(out)
    assert rows(stored) == expected
    (path / "c.json").write_text(json.dumps(lines[1]))
    load_landed(spark, str(path), out, checkpoint).awaitTermination()
    assert spark.read.schema(schemas.READINGS).parquet(out).count() == 4

    registry = spark.createDataFrame([("cairo", 30.06, 31.24), ("dubai", 25.2, 55.27)],
                                     schemas.CITY_REGISTRY)
    wanted = spark.createDataFrame([(1, "CAIRO"), (2, "Paris"), (3, "cairo")], "n int, city string")
    assert rows(resolve_cities(wanted, registry).select("n", "name", "lat"), "n") == [
        (1, "cairo", 30.06), (3, "cairo", 30.06)
    ]
    assert rows(unknown_cities(wanted, registry)) == [(2, "Paris")]
    report = str(tmp_path / "report")
    (path / "d.json").write_text(json.dumps({"city": "Dubai", "error": True}))
    wanted = wanted.unionByName(spark.createDataFrame([(4, "dubai")], wanted.schema))
    said = jobs.weather_report(spark, wanted, registry, str(path), report)
    assert rows(said.unknown) == [(2, "Paris")] and rows(said.failed) == [("dubai",)]
    assert rows(spark.read.csv(report, header=True), "city") == [
        ("cairo", "1.0", "1.0", "1.0", "1"), ("dubai", "5.0", "5.0", "5.0", "2")
    ]


def test_broken_payloads_are_reported_and_the_rest_is_read(spark, tmp_path):
    for city, text in {
        "Cairo": '{"hourly": {"time": ["t1"], "temperature_2m": [1.5]}}',
        "Dubai": '{"error": true}',
        "Riyadh": '{"hourly": {"time": ["t1"]}}',
    }.items():
        (tmp_path / f"city={city}").mkdir()
        (tmp_path / f"city={city}" / "a.json").write_text(text)
    read = payloads.read_payloads(spark, str(tmp_path))
    assert rows(payloads.flatten_payloads(read)) == [("Cairo", "t1", 1.5)]
    assert rows(payloads.failed_cities(read)) == [("Dubai",), ("Riyadh",)]


def test_analysis_of_files(spark, orders_csv, tmp_path):
    readings = tmp_path / "weather.json"
    readings.write_text(json.dumps(
        [dict(zip(("city", "time", "temperature_c"), r)) for r in READINGS]
    ))
    out = str(tmp_path / "enriched")
    jobs.analyse_files(spark, orders_csv, str(readings), out, lines=False)
    found = rows(spark.read.csv(out, header=True).select("id", "city", "avg_temp", "record_count"))
    assert found == [("11", "oslo", "4.5", "2"), ("12", "lisbon", None, "0"),
                     ("14", "quito", "12.5", "1")]
    assert {r.note for r in spark.read.csv(out, header=True).collect()} == {"first", None, "x"}


def test_readings_file_to_csv(spark, tmp_path):
    readings = tmp_path / "weather.json"
    readings.write_text("\n".join(
        json.dumps(dict(zip(("city", "time", "temperature_c"), r))) for r in READINGS
    ))
    out = str(tmp_path / "summary")
    jobs.summarise_readings(spark, str(readings), out)
    assert [tuple(r) for r in spark.read.csv(out, header=True).orderBy("city").collect()] == [
        ("lisbon", None, None, None, "0"), ("oslo", "4.5", "5.0", "4.0", "2"),
        ("quito", "12.5", "12.5", "12.5", "1"),
    ]
    empty = tmp_path / "empty.json"
    empty.write_text("")
    with pytest.raises(DataCheckError):
        jobs.summarise_readings(spark, str(empty), out)


def test_versioned_table(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = schemas.ORDERS
    with pytest.raises(TableNotFoundError):
        read_table(spark, path, schema)
    assert read_table(spark, path, schema, absent_as_empty=True).count() == 0
    assert not (tmp_path / "t").exists()
    first = spark.createDataFrame([(1, "a", 1.0, "x", False), (2, "b", 2.0, "x", False)], schema)
    assert replace_table(first, path, key=("id",)) == 2
    batch = spark.createDataFrame([(2, "c", 3.0, "y", True), (3, "d", 4.0, "y", True)], schema)
    assert upsert_table(batch, path, schema, "id") == 2
    assert upsert_table(batch, path, schema, "id") == 2
    assert rows(read_table(spark, path, schema).select("id", "city")) == [(1, "a"), (2, "c"), (3, "d")]
    doubled = batch.unionByName(batch)
    with pytest.raises(DataCheckError):
        replace_table(doubled, path, key=("id",))
    # The rejected version was never logged, so readers still see the last good one.
    assert read_table(spark, path, schema).count() == 3
    # Only the two newest of three versions are there, and nothing of the rejected one.
    assert sorted(x.name[:7] for x in (tmp_path / "t").glob("v0*")) == ["v000002", "v000003"]


def test_warehouse_job(spark, orders_csv, tmp_path):
    root = str(tmp_path / "warehouse")
    orders = files.read_csv_text(spark, orders_csv, schemas.ORDERS_RAW.fieldNames())
    readings = spark.createDataFrame(READINGS, schemas.READINGS)
    assert jobs.load_orders(orders, root) == 3
    assert jobs.load_weather(readings, root) == 3
    assert jobs.load_orders(orders, root) == 3
    found = [tuple(r) for r in jobs.warehouse_enriched(spark, root).select(
        "id", "city", "avg_temp", "record_count").collect()]
    # Here every reading counts, also the one without a temperature.
    assert found == [(11, "oslo", 4.5, 2), (12, "lisbon", None, 1), (14, "quito", 12.5, 1)]
    with pytest.raises(TableNotFoundError):
        source(spark, root, "warehouse", "weather_raw")


def test_batches(spark, sf_dir, tmp_path):
    root = str(tmp_path / "batch")
    written = jobs.weather_batch(
        messy.view(spark, sf_dir, messy.WEATHER),
        messy.view(spark, sf_dir, messy.DELIVERIES),
        messy.view(spark, sf_dir, messy.RAW_ORDERS),
        root,
    ).rows
    assert written["weather_raw"] == 1000 and written["mart_city_summary"] == 25
    with pytest.raises(DataCheckError):
        jobs.weather_batch(spark.createDataFrame([], schemas.READINGS), None, None, root)

    orders = messy.view(spark, sf_dir, messy.RESTAURANT_ORDERS)
    with pytest.raises(DataCheckError, match="missing field: amount"):
        jobs.restaurant_batch(orders, root)
    whole = orders.where(F.col("amount").isNotNull())
    written = jobs.restaurant_batch(whole, root).rows
    assert written["restaurant_orders_raw"] == whole.count()
    stored = source(spark, root, "warehouse", "restaurant_orders_raw")
    assert publish_view(stored, "stored_orders") is stored
    assert spark.table("stored_orders").count() == whole.count()
    spark.catalog.dropTempView("stored_orders")


def test_star_and_entities_are_stored(spark, sf_dir, tmp_path):
    root = str(tmp_path / "star")
    tidy = messy.view(spark, sf_dir, messy.DELIVERIES_TIDY)
    built = jobs.load_star(tidy, root)
    assert built.facts.count() == source(spark, root, "warehouse", "fact_orders").count()
    assert source(spark, root, "warehouse", "dim_city").schema == schemas.DIM_CITY

    first = rows(source(spark, root, "warehouse", "dim_city"), "city_key")
    more = tidy.unionByName(tidy.limit(1).withColumns({"id": F.lit(-1), "city": F.lit("aaa")}))
    jobs.load_star(more, root)
    again = rows(source(spark, root, "warehouse", "dim_city"), "city_key")
    assert again == [*first, (len(first) + 1, "aaa")]
    before = source(spark, root, "warehouse", "fact_orders").count()
    new = tidy.limit(1).withColumns({"id": F.lit(-2), "order_date": F.lit("2011-05-05")})
    jobs.load_star(new.withColumn("amount", F.lit("3.25")), root)
    facts = source(spark, root, "warehouse", "fact_orders")
    assert facts.count() == before + 1
    days = source(spark, root, "warehouse", "dim_date")
    assert facts.join(days, "date_key", "left_anti").where("date_key is not null").count() == 0
    counts = jobs.load_entities(messy.view(spark, sf_dir, messy.WIDE_ORDERS), root)
    assert counts["dim_cities"] == 25
    (tmp_path / "seeds").mkdir()
    (tmp_path / "seeds" / "raw_orders.csv").write_text(
        ",".join(schemas.RAW_ORDERS.fieldNames()) + "\n1,a,b,c,1,0,delivered,2026-01-01T10:00\n"
    )
    seeds = source(spark, str(tmp_path / "seeds"), "seeds", "raw_orders")
    assert rows(seeds.select("order_total", "ordered_at")) == [("1", "2026-01-01T10:00")]
    assert table_path("a/", "b") == "a/b"
