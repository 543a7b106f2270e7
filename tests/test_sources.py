import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.operators.quality import malformed_records, valid_records
from millrace.operators.reuse import persisted
from millrace.plans.nested import flatten_employees, previous_addresses, write_json_arrays
from millrace.plans.quarantine import city_counts, quarantine, with_city
from millrace.sources.files import read_csv, read_json_documents, read_json_lines, read_lines
from file_schemas import TAXI_BASES, TAXI_ZONES
from millrace.sources.schemas import CHECKED_PEOPLE, PEOPLE
from millrace.sources.schemas import EMPLOYEES as EMPLOYEES_DDL

@pytest.fixture
def zones(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        "LocationID,Borough,Zone,service_zone\n"
        "1,North,Old Harbour,Boats\n"
        "2,South,Hill,Cars\n"
        "x,South,Valley,\n"
        '4,West,"Lake, upper",Cars\n'
    )
    return str(path)


def test_schema_binds_by_position_and_bad_fields_become_null(spark, zones):
    df = read_csv(spark, zones, TAXI_ZONES)
    assert df.columns == ["LocationID", "Borough", "Zone", "ServiceZone"]
    found = {row.Zone: (row.LocationID, row.ServiceZone) for row in df.collect()}
    assert found == {
        "Old Harbour": (1, "Boats"), "Hill": (2, "Cars"), "Valley": (None, None), "Lake, upper": (4, "Cars")
    }


def test_without_header_names_are_positions_and_the_header_forces_text(spark, zones):
    df = read_csv(spark, zones, header=False)
    assert df.columns == ["_c0", "_c1", "_c2", "_c3"]
    assert all(isinstance(field.dataType, StringType) for field in df.schema)
    assert df.count() == 5
    assert df.toDF("a", "b", "c", "d").columns == ["a", "b", "c", "d"]
    with pytest.raises(Exception):
        df.toDF("a", "b")


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text("n,x,name\n1,2.5,a\n2,3.5,b\n")
    assert read_csv(spark, str(path)).dtypes == [("n", "int"), ("x", "double"), ("name", "string")]


def test_lines(spark, zones):
    lines = read_lines(spark, zones)
    assert lines.columns == ["value"]
    assert lines.count() == 5
    assert lines.first().value == "LocationID,Borough,Zone,service_zone"


EMPLOYEES = [
    {
        "EmployeeID": 1,
        "Name": {"First": "Ada", "Last": "Moss"},
        "ContactInfo": {
            "Email": "ada@example.org",
            "Phone": "1",
            "Address": {"Street": "A", "City": "Arles", "State": "X", "ZipCode": "01",
                        "PreviousAddresses": ["P", "Q"]},
        },
        "Department": "D1",
        "Salary": 1200,
        "Unknown": True,
    },
    {"EmployeeID": 2, "Name": {"First": "Ben"}, "Department": "D2", "Salary": 10.5},
    {
        "EmployeeID": 3,
        "Name": {"First": "Cy", "Last": "Nye"},
        "ContactInfo": {"Address": {"City": "Bonn", "PreviousAddresses": []}},
    },
]


@pytest.fixture
def employees(spark, tmp_path):
    path = tmp_path / "employees.json"
    path.write_text(json.dumps(EMPLOYEES, indent=2))
    return read_json_documents(spark, str(path), EMPLOYEES_DDL)


def test_nested_documents(employees):
    flat = {row.employee_id: row for row in flatten_employees(employees).collect()}
    assert flat[1].city == "Arles" and flat[1].salary == 1200.0
    assert flat[2].last_name is None and flat[2].city is None and flat[2].salary == 10.5
    assert flat[3].city == "Bonn" and flat[3].department is None
    assert employees.schema["Salary"].dataType.simpleString() == "double"


def test_exploding_skips_empty_and_missing_arrays(employees, rows):
    assert rows(previous_addresses(employees)) == [(1, "Ada", "P"), (1, "Ada", "Q")]


def test_sql_and_dataframe_access_agree(spark, employees, rows):
    by_sql = spark.sql(
        "SELECT EmployeeID, Name.First, explode(ContactInfo.Address.PreviousAddresses) FROM {e}", e=employees
    )
    assert rows(by_sql) == rows(previous_addresses(employees))


def test_names_with_spaces(spark, tmp_path):
    path = tmp_path / "bases.json"
    base = {"License Number": "B1", "Entity Name": "Quick", "Type of Base": "Livery", "Telephone Number": 5551234567,
            "Address": {"Street": "Elm", "City": "Troy"}, "GeoLocation": {"Latitude": "1.5"}}
    path.write_text(json.dumps([base], indent=1))
    bases = read_json_documents(spark, str(path), TAXI_BASES)
    by_frame = bases.select("`Entity Name`", F.col("`Type of Base`"), "Address.City", "GeoLocation.Latitude").first()
    by_sql = spark.sql(
        "SELECT `Entity Name`, `Type of Base`, Address.City AS City, GeoLocation.Latitude AS Latitude FROM {b}", b=bases
    ).first()
    assert tuple(by_frame) == tuple(by_sql) == ("Quick", "Livery", "Troy", "1.5")
    assert bases.first()["Telephone Number"] == 5551234567


def test_multiline_option_is_required(spark, tmp_path):
    path = tmp_path / "pretty.json"
    path.write_text(json.dumps(EMPLOYEES, indent=2))
    assert spark.read.schema(EMPLOYEES_DDL).json(str(path)).filter("EmployeeID IS NOT NULL").count() == 0


def test_json_arrays_have_a_bounded_size(spark, tmp_path, rows):
    data = spark.range(0, 25, numPartitions=2).select("id", F.struct(F.col("id").alias("x")).alias("s"))
    write_json_arrays(data, str(tmp_path / "arrays"), size=200)
    files = list((tmp_path / "arrays").glob("part-*"))
    assert len(files) >= 5
    assert all(len(json.loads(file.read_text())) <= 5 for file in files)
    back = read_json_documents(spark, str(tmp_path / "arrays"), "id BIGINT, s STRUCT<x: BIGINT>")
    assert rows(back) == rows(data)


BROKEN = [
    '{"id":1,"name":"A","details":{"age":3,"address":{"street":"S","city":"Rome"}}}',
    '{"id":"not_an_int","name":"B"}',
    "{broken",
    '{"id":9,"name":null,"details":"wrong"}',
    "",
    '{"name":"noid"}',
]


@pytest.fixture
def broken(tmp_path):
    path = tmp_path / "records.json"
    path.write_text("\n".join(BROKEN) + "\n")
    return str(path)


def test_permissive_keeps_every_record(spark, broken):
    found = [(r.id, r.name, r.details is not None, r._corrupt_record)
             for r in read_json_lines(spark, broken, CHECKED_PEOPLE).collect()]
    assert found == [
        (1, "A", True, None),
        (None, "B", False, BROKEN[1]),
        (None, None, False, BROKEN[2]),
        (9, None, False, BROKEN[3]),
        (None, "noid", False, None),
    ]


def test_dropmalformed_and_failfast(spark, broken):
    kept = read_json_lines(spark, broken, PEOPLE, mode="DROPMALFORMED").collect()
    assert [(r.id, r.name) for r in kept] == [(1, "A"), (None, "noid")]
    with pytest.raises(Exception, match="MALFORMED"):
        read_json_lines(spark, broken, PEOPLE, mode="FAILFAST").collect()


def test_the_same_records_are_broken_whatever_is_selected(spark, broken):
    records = read_json_lines(spark, broken, CHECKED_PEOPLE)
    assert malformed_records(records).count() == 3
    assert valid_records(records).columns == ["id", "name", "details"]
    for columns in (["name"], ["id"], ["details.address.city"]):
        assert valid_records(records).select(*columns).count() == 2
        assert len(valid_records(records).select(*columns).collect()) == 2
    dropped = read_json_lines(spark, broken, PEOPLE, mode="DROPMALFORMED")
    assert len(dropped.select("name").collect()) == 2


def test_lines_are_parsed_once(spark, broken, plan):
    valid = valid_records(read_json_lines(spark, broken, CHECKED_PEOPLE)).select("id", "details.age")
    assert plan(valid).count("from_json(StructField") == 1


def test_reading_agrees_with_the_kept_result_of_the_spark_reader(spark, broken, rows):
    kept = spark.read.schema(CHECKED_PEOPLE).json(broken, columnNameOfCorruptRecord="_corrupt_record")
    with persisted(kept):
        assert rows(read_json_lines(spark, broken, CHECKED_PEOPLE)) == rows(kept)


def test_unknown_mode(spark, broken):
    with pytest.raises(ValueError):
        read_json_lines(spark, broken, PEOPLE, mode="LENIENT")


def test_quarantine(spark, broken, tmp_path, rows, plan):
    clean, log, report = (str(tmp_path / name) for name in ("clean", "log", "report"))
    records = read_json_lines(spark, broken, CHECKED_PEOPLE)
    quarantine(read_json_lines(spark, broken, CHECKED_PEOPLE, placed=True), clean, log, report)
    delivered = spark.read.parquet(clean)
    assert delivered.columns == ["id", "name", "age", "city"]
    assert rows(delivered.select("id", "name")) == rows(valid_records(records).select("id", "name"))
    assert sorted(r.value for r in spark.read.text(log).collect()) == sorted([BROKEN[1], BROKEN[2], BROKEN[3]])
    assert rows(spark.read.parquet(report)) == rows(city_counts(with_city(valid_records(records))))
    assert "InMemoryTableScan" not in plan(with_city(records).select("city", "_corrupt_record"))


def test_every_broken_line_is_logged_as_often_as_it_occurs(spark, tmp_path):
    array = '[{"id":4,"name":"d"},{"id":"bad"},{"id":5}]'
    lines = ["{broken", '{"id":1}', "{broken", array, "{broken", array, '[{"id":2},{"id":3}]', "[1,2]"]
    (tmp_path / "lines.txt").write_text("\n".join(lines))
    log = str(tmp_path / "log")
    records = read_json_lines(spark, str(tmp_path / "lines.txt"), CHECKED_PEOPLE, placed=True)
    assert sorted(r._place_in_line for r in records.collect()) == [0] * 8 + [1, 1, 1, 2, 2]
    quarantine(records, str(tmp_path / "clean"), log, str(tmp_path / "report"))
    assert sorted(r.value for r in spark.read.text(log).collect()) == sorted(["{broken"] * 3 + [array] * 2 + ["[1,2]"])
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "clean")).collect()) == [1, 2, 3]


ARRAYS = [
    '[{"id":2,"name":"b"},{"id":3,"name":"c"}]', ' [ {"id":8} ] ', "[]", '[{"id":10},{}]', '{"id":1}', "",
    '[{"id":4,"name":"d"},{"id":"bad","name":"e"}]', "[1,2]", '[{"id":5},{broken]', '[{"id":7},null]', '[{"id":6,"name":"f"}', "null",
]


def test_array_lines_give_the_rows_of_the_spark_reader(spark, tmp_path, rows):
    schema = "id INT, name STRING, _corrupt_record STRING"
    (tmp_path / "lines.txt").write_text("\n".join(ARRAYS))
    for mode in ("PERMISSIVE", "DROPMALFORMED"):
        with persisted(spark.read.schema(schema).json(str(tmp_path), mode=mode)) as kept:
            assert rows(read_json_lines(spark, str(tmp_path), schema, mode)) == rows(kept)
    with pytest.raises(Exception, match="MALFORMED"):
        read_json_lines(spark, str(tmp_path), "id INT", "FAILFAST").collect()
    (tmp_path / "lines.txt").write_text("\n".join(ARRAYS[:6]))
    assert rows(read_json_lines(spark, str(tmp_path), "id INT", "FAILFAST")) == rows(spark.read.schema("id INT").json(str(tmp_path)))
