"""Nested JSON documents: reading, struct access and arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources.json_arrays import read_json_array
from millrace.sources.schemas import EMPLOYEES
from millrace.sources.tables import Tables


def flatten_employees(employees: DataFrame) -> DataFrame:
    """One flat row per employee."""
    return employees.select(
        F.col("EmployeeID").alias("employee_id"),
        F.col("Name.First").alias("first_name"),
        F.col("Name.Last").alias("last_name"),
        F.col("ContactInfo.Email").alias("email"),
        F.col("ContactInfo.Address.City").alias("city"),
        F.col("ContactInfo.Address.State").alias("state"),
        F.col("Department").alias("department"),
        F.col("Salary").alias("salary"),
    )


def previous_addresses(employees: DataFrame, *columns: Column) -> DataFrame:
    """One row per earlier address; employees without one have no row."""
    return employees.select(
        F.col("EmployeeID").alias("employee_id"),
        F.col("Name.First").alias("first_name"),
        *columns,
        F.explode("ContactInfo.Address.PreviousAddresses").alias("previous_address"),
    )


#: Bytes of a document file, about; one task writes it.
DOCUMENT_BYTES = 8 * 1024 * 1024


def json_arrays(rows: DataFrame, size: int = DOCUMENT_BYTES) -> DataFrame:
    """Rows as pretty-printed JSON arrays of about ``size`` bytes each, in the column ``value``.

    The rows are measured first; they are dealt to arrays in turn, so no array is much longer
    than another.
    """
    documents = rows.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
    total = documents.agg(F.sum(F.octet_length("value")).alias("bytes")).first()["bytes"] or 0
    arrays = max(1, -(-total // size))
    numbered = documents.withColumn("array", F.pmod(F.monotonically_increasing_id(), F.lit(arrays)))
    joined = F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("\n]"))
    return numbered.groupBy("array").agg(joined.alias("value")).select("value")


def write_json_arrays(rows: DataFrame, path: str, size: int = DOCUMENT_BYTES) -> None:
    """Write rows as files that each hold one pretty-printed JSON array."""
    json_arrays(rows, size).write.option("maxRecordsPerFile", 1).mode("overwrite").text(path)


def employee_rows(t: Tables) -> DataFrame:
    """Customers in the shape of the employee documents, with none to three earlier addresses."""
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    people = (
        t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    name = F.split("c_name", "#")
    earlier = F.array_compact(
        F.array(
            F.when(F.col("c_acctbal") > 0, F.col("n_name")),
            F.when(F.col("c_acctbal") > 3000, F.col("r_name")),
            F.when(F.col("c_acctbal") > 6000, F.col("c_mktsegment")),
        )
    )
    address = F.struct(
        F.col("c_mktsegment").alias("Street"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("State"),
        F.col("c_nationkey").cast("string").alias("ZipCode"),
        earlier.alias("PreviousAddresses"),
    )
    return people.select(
        F.col("c_custkey").alias("EmployeeID"),
        F.struct(name[0].alias("First"), name[1].alias("Last")).alias("Name"),
        F.struct(
            F.concat("c_name", F.lit("@example.org")).alias("Email"),
            F.col("c_custkey").cast("string").alias("Phone"),
            address.alias("Address"),
        ).alias("ContactInfo"),
        F.col("c_mktsegment").alias("Department"),
        F.col("c_acctbal").alias("Salary"),
    )


def employees(t: Tables) -> DataFrame:
    """The documents, written as multi-line JSON and read back with the nested schema, a file by as many tasks as it needs."""
    path = scratch_path(t.spark, "employees")
    write_json_arrays(employee_rows(t), path)
    return read_json_array(t.spark, path, EMPLOYEES)


_PEOPLE = "customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"
_EARLIER = """
    UNNEST([CASE WHEN c_acctbal > 0 THEN n_name END, CASE WHEN c_acctbal > 3000 THEN r_name END,
            CASE WHEN c_acctbal > 6000 THEN c_mktsegment END]) AS previous_address
"""
_FLAT = """
    c_custkey AS employee_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
    c_name || '@example.org' AS email, n_name AS city, r_name AS state, c_mktsegment AS department,
    c_acctbal AS salary
"""


@query(f"""
    SELECT c_custkey AS employee_id, split_part(c_name, '#', 2) AS last_name, c_custkey::VARCHAR AS phone,
           c_nationkey::VARCHAR AS zip_code, c_mktsegment AS department, c_acctbal AS salary FROM {_PEOPLE}
""")
def src_json_multiline(t: Tables) -> DataFrame:
    return employees(t).select(
        F.col("EmployeeID").alias("employee_id"),
        F.col("Name.Last").alias("last_name"),
        F.col("ContactInfo.Phone").alias("phone"),
        F.col("ContactInfo.Address.ZipCode").alias("zip_code"),
        F.col("Department").alias("department"),
        F.col("Salary").alias("salary"),
    )


@query(f"SELECT {_FLAT} FROM {_PEOPLE}")
def nst_struct_access(t: Tables) -> DataFrame:
    return flatten_employees(employee_rows(t))


@query(f"SELECT c_custkey AS employee_id, split_part(c_name, '#', 1) AS first_name, n_name AS city FROM {_PEOPLE}")
def nst_struct_access_sql(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT EmployeeID AS employee_id, Name.First AS first_name, ContactInfo.Address.City AS city"
        " FROM {employees}",
        employees=employee_rows(t),
    )


_EXPLODED_SQL = f"""
    SELECT * FROM (SELECT c_custkey AS employee_id, split_part(c_name, '#', 1) AS first_name, {_EARLIER}
                   FROM {_PEOPLE})
    WHERE previous_address IS NOT NULL
"""


@query(_EXPLODED_SQL)
def nst_explode(t: Tables) -> DataFrame:
    return previous_addresses(employee_rows(t))


@query(_EXPLODED_SQL)
def nst_explode_sql(t: Tables) -> DataFrame:
    return t.spark.sql(
        "SELECT EmployeeID AS employee_id, Name.First AS first_name,"
        " explode(ContactInfo.Address.PreviousAddresses) AS previous_address FROM {employees}",
        employees=employee_rows(t),
    )


@query(f"SELECT n_name AS city, COUNT(*) AS count FROM {_PEOPLE} GROUP BY n_name")
def nst_group_nested(t: Tables) -> DataFrame:
    cities = employee_rows(t).select(F.col("ContactInfo.Address.City").alias("city"))
    return cities.groupBy("city").count().orderBy(F.desc("count"), "city")


@query(f"SELECT * FROM (SELECT {_FLAT}, {_EARLIER} FROM {_PEOPLE}) WHERE previous_address IS NOT NULL")
def job_employee_flat(t: Tables) -> DataFrame:
    flat = ("last_name", "email", "city", "state", "department", "salary")
    paths = ("Name.Last", "ContactInfo.Email", "ContactInfo.Address.City", "ContactInfo.Address.State",
             "Department", "Salary")
    return previous_addresses(employees(t), *(F.col(path).alias(name) for path, name in zip(paths, flat)))
