import json
import random

import pytest

from skyledger.sources.arrays import array_records
from skyledger.sources.files import read_json_records
from skyledger.schemas import TEXT, schema


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def some_records(seed, n):
    rnd = random.Random(seed)
    signs = ['"', "\\", "{", "}", "[", "]", ",", "\n", "é", "a", " ", "\\\\", '\\"', " "]
    text = lambda: "".join(rnd.choice(signs) for _ in range(rnd.randrange(12)))
    return [
        {"id": i, text(): text(), "deep": [{"x": text()}, [], {}] if rnd.random() < 0.3 else None} for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 2])
def test_an_array_split_over_tasks_gives_its_records(spark, tmp_path, small_splits, indent):
    every = []
    for i, n in enumerate((0, 1, 150)):
        records = some_records(i, n)
        every += records
        text = json.dumps(records, indent=indent, ensure_ascii=bool(i % 2))
        (tmp_path / f"{i}.json").write_text(f" \n{text}\n", encoding="utf-8")
    read = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert read.rdd.getNumPartitions() > 10
    found = [json.loads(r[0]) for r in array_records(spark, str(tmp_path)).collect()]
    order = lambda records: sorted(json.dumps(r, sort_keys=True) for r in records)
    assert order(found) == order(every)


def test_records_equal_those_of_lines(spark, tmp_path, small_splits):
    records = [{"id": str(i), "city": f"c}}{i}\"", "more": "x" * (i % 50)} for i in range(200)]
    (tmp_path / "array.json").write_text(json.dumps(records))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, records)))
    declared = schema(id=TEXT, city=TEXT)
    array, lines = (
        read_json_records(spark, str(tmp_path / f"{kind}.json"), declared, ["id", "status"], lines=kind == "lines")
        for kind in ("array", "lines")
    )
    assert sorted(map(str, array.collect())) == sorted(map(str, lines.collect())) and array.count() == 200


@pytest.mark.parametrize("text", ['{"id": 1}', "[{]", "not json", "[{}", '[{"a": 1} {"a": 2}]', "[1, 2]", '[{}, 1, {}]', "[{}]]", '[{"a": "x}]', ""])
def test_broken_arrays_fail(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text + " ")
    with pytest.raises(Exception, match="JSON|json|record"):
        read_json_records(spark, str(tmp_path / "a.json"), schema(id=TEXT)).collect()
