"""Schemas of the files the reports are written for, as DDL.

CSV schemas bind by position, so their names may differ from a file's header. All
columns may be null.
"""

from __future__ import annotations

# Column names and types of the input files.
EMPLOYEES = """
    EmployeeID BIGINT,
    Name STRUCT<First: STRING, Last: STRING>,
    ContactInfo STRUCT<Email: STRING, Phone: STRING,
        Address: STRUCT<Street: STRING, City: STRING, State: STRING, ZipCode: STRING,
                        PreviousAddresses: ARRAY<STRING>>>,
    Department STRING,
    Salary DOUBLE
"""

PEOPLE = "id BIGINT, name STRING, details STRUCT<age: INT, address: STRUCT<street: STRING, city: STRING>>"
CHECKED_PEOPLE = f"{PEOPLE}, _corrupt_record STRING"
