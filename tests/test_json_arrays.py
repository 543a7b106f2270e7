"""Arrays of JSON documents that many tasks read, against Spark's reader, which takes one."""

import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.session import scoped_session
from millrace.sources.files import read_json_documents
from millrace.sources.json_arrays import read_json_array, record_texts

SCHEMA = "id BIGINT, text STRING, tags ARRAY<STRUCT<a: STRING, b: ARRAY<INT>>>, deep STRUCT<x: STRUCT<y: STRING>>"
PARTS = ["{", "}", '"', "\\", "[", "]", ",", ":", "\n", "a", "é", "中", "}}", '\\"', "{}", "\t"]


def documents(n, seed):
    rng = random.Random(seed)

    def text():
        return "".join(rng.choices(PARTS, k=rng.randrange(12)))

    return [
        {"id": i, "text": text(), "tags": [{"a": text(), "b": [1, 2]} for _ in range(rng.randrange(3))], "deep": {"x": {"y": text()}}}
        for i in range(n)
    ]


@pytest.fixture(params=[150, 1000])
def small_ranges(spark, request):
    return scoped_session(spark, {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"})


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_is_read_by_many_tasks(small_ranges, tmp_path, rows, indent):
    path = tmp_path / "array.json"
    path.write_text(json.dumps(documents(30, 1), indent=indent, ensure_ascii=False), encoding="utf-8")
    found = read_json_array(small_ranges, str(path), SCHEMA)
    assert rows(found) == rows(read_json_documents(small_ranges, str(path), SCHEMA))
    assert small_ranges.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 1


def test_several_files_and_single_documents(small_ranges, tmp_path, rows):
    files = {"a": documents(12, 2), "b": documents(1, 3)[0], "c": [], "d": documents(5, 4)}
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=1), encoding="utf-8")
    (tmp_path / "e.json").write_text(json.dumps(documents(1, 5)[0]) + "\n", encoding="utf-8")
    (tmp_path / "f.json").write_text("", encoding="utf-8")
    found = rows(read_json_array(small_ranges, str(tmp_path), SCHEMA))
    expected = [*files["a"], files["b"], *files["d"], documents(1, 5)[0]]
    assert sorted(row[0] for row in found) == sorted(d["id"] for d in expected)
    assert sorted(row[1] for row in found) == sorted(d["text"] for d in expected)


def test_a_record_longer_than_a_range(small_ranges, tmp_path):
    long = {"id": 1, "text": "{[\\\"}" * 3000, "tags": [], "deep": None}
    (tmp_path / "long.json").write_text(json.dumps([{"id": 0}, long, {"id": 2}]), encoding="utf-8")
    found = {row["id"]: row["text"] for row in read_json_array(small_ranges, str(tmp_path), SCHEMA).collect()}
    assert found == {0: None, 1: long["text"], 2: None}


def test_a_broken_record_does_not_take_others_along(spark, tmp_path):
    (tmp_path / "broken.json").write_text('[{"id": 1}, {"id": "x"}, {"id": 3, "deep": 5}, 7, {"id": 4}]')
    assert sorted(row["id"] or 0 for row in read_json_array(spark, str(tmp_path), SCHEMA).collect()) == [0, 1, 3, 4]


def test_records_of_the_given_table_in_one_file(spark, tables, tmp_path, rows):
    small = scoped_session(spark, {"spark.sql.files.maxPartitionBytes": "20000"})
    lines = tables.orders.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    text = F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("\n]"))
    lines.agg(text.alias("value")).write.text(str(tmp_path / "one"))
    assert record_texts(small, str(tmp_path / "one")).count() == tables.orders.count()
    assert rows(read_json_array(small, str(tmp_path / "one"), tables.orders.schema)) == rows(tables.orders)
