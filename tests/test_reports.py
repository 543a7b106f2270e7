"""The reports on small tables whose results can be checked by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.aggregates import distinct_totals
from millrace.operators.joins import unmatched
from millrace.plans.databases import load_and_verify
from millrace.plans.incidents import Incidents
from millrace.plans.retail import customer_report, order_detail, row_counts, sales_summary
from millrace.plans.zones import kind_mix
from millrace.sources.files import read_csv
from millrace.sources.jdbc import Database
from file_schemas import FIRE_CALLS, TAXI_ZONES, YELLOW_TAXI


def money(text):
    return Decimal(text)


@pytest.fixture
def shop(spark):
    products = spark.createDataFrame(
        [(1, "Lamp", "Home"), (2, "Rug", "Home"), (3, "Pen", "Office"), (4, "Safe", "Office")],
        "product_id INT, product_name STRING, category STRING",
    )
    customers = spark.createDataFrame(
        [(1, "Ida", "Berg", "Oslo"), (2, "Tom", "Lund", "Bergen"), (3, "Eva", "Dahl", "Oslo")],
        "customer_id INT, first_name STRING, last_name STRING, city STRING",
    )
    day = dt.date(2024, 1, 5)
    orders = spark.createDataFrame(
        [
            (1, 1, 1, day, 2, money("500.00"), "Delivered"),
            (2, 1, 2, day, 1, money("499.99"), "Shipped"),
            (3, 2, 3, dt.date(2024, 1, 2), 10, money("277.46"), "Delivered"),
            (4, 2, 3, dt.date(2024, 1, 3), 5, money("277.47"), "Pending"),
            (5, 2, 99, day, 1, money("7.00"), "Pending"),
            (6, 77, 1, day, 1, money("9.00"), "Pending"),
        ],
        "order_id INT, customer_id INT, product_id INT, order_date DATE, quantity INT,"
        " total_amount DECIMAL(10,2), status STRING",
    )
    return orders, products, customers


def test_sales_summary(shop):
    orders, products, _ = shop
    assert [tuple(row) for row in sales_summary(orders, products).collect()] == [
        ("Home", 3, money("1008.99"), money("336.33"), 4),
        ("Office", 2, money("554.93"), money("277.47"), 15),
    ]


def test_customer_report(shop):
    orders, _, customers = shop
    assert [tuple(row) for row in customer_report(orders, customers).collect()] == [
        (1, "Ida Berg", "Oslo", 2, money("999.99"), money("500.00")),
        (2, "Tom Lund", "Bergen", 3, money("561.93"), money("187.31")),
    ]


def test_customer_report_with_a_repeated_customer_row(spark, shop):
    """The same result as grouping after the join."""
    orders, _, customers = shop
    twice = customers.unionAll(customers.filter("customer_id = 2"))
    joined = orders.join(twice, "customer_id").groupBy("customer_id").agg(
        F.count("*").alias("n"), F.sum("total_amount").alias("t")
    )
    expected = {row.customer_id: (row.n, row.t) for row in joined.collect()}
    found = {row.customer_id: (row.total_orders, row.total_spend) for row in customer_report(orders, twice).collect()}
    assert found == expected


def test_order_detail(shop):
    found = [(row.order_id, row.customer_name, row.product_name, row.value_tier) for row in order_detail(*shop).collect()]
    assert found == [
        (3, "Tom Lund", "Pen", "Medium"),
        (4, "Tom Lund", "Pen", "Medium"),
        (1, "Ida Berg", "Lamp", "High"),
        (2, "Ida Berg", "Rug", "Medium"),
    ]


def test_row_counts(shop):
    orders, products, customers = shop
    found = row_counts(products=products, customers=customers, orders=orders).collect()
    assert [tuple(row) for row in found] == [("products", 4), ("customers", 3), ("orders", 6)]


def test_load_and_verify(spark, shop):
    orders, products, _ = shop
    summary = sales_summary(orders, products)
    database = Database.of(spark)
    for _ in range(2):  # the second load replaces the first
        check = load_and_verify(database, summary, "summary_check", "category VARCHAR(50)").first()
        assert tuple(check) == (2, 2, True)
    assert [tuple(row) for row in database.read_table("summary_check").orderBy("category").collect()] == sorted(
        tuple(row) for row in summary.collect()
    )


@pytest.fixture
def calls(spark):
    rows = [
        (1, "Fire", "B1", "Dock", 2.0),
        (2, "Fire", "B1", "Dock", 12.345678),
        (3, "Medical", "B1", "Hill", 3.0),
        (4, "Medical", "B2", "Hill", 10.0),
        (5, "Medical", "B2", "Dock", None),
        (6, "Alarm", "B2", "Hill", 1844.55),
    ]
    df = spark.createDataFrame(rows, "number INT, kind STRING, unit STRING, area STRING, delay DOUBLE")
    return Incidents(df, number="number", kind="kind", delay="delay")


def test_incident_questions(calls):
    def plain(df):
        return [tuple(row) for row in df.collect()]

    assert plain(calls.kinds()) == [(3,)]
    assert plain(calls.of_kind("Fire", ["area"], 1)) == [(1, "Dock")]
    assert plain(calls.per_group("unit")) == [("B1", 3), ("B2", 3)]
    assert plain(calls.busiest("area", 1)) == [("Dock", 3)]
    assert plain(calls.slowest("kind", 2)) == [("Alarm", 1844.55), ("Fire", 7.17)]
    assert plain(calls.worst(10, ["kind"])) == [(6, "Alarm", 1844.55), (2, "Fire", 12.345678)]
    assert plain(calls.of_kind("Medical", ["delay"], area="Hill")) == [(3, 3.0), (4, 10.0)]
    assert [row[-1] for row in plain(calls.speeds([], 3, 10))] == ["Fast", "Slow", "Fast", "Normal", "Slow", "Slow"]
    assert plain(calls.kinds_per_group("unit", "Fire", "Medical")) == [
        ("B1", "Fire", 2), ("B1", "Medical", 1), ("B2", "Medical", 2)
    ]
    assert plain(calls.delays_of("Medical", "unit")) == [("B2", 2, 10.0, 10.0), ("B1", 1, 3.0, 3.0)]
    assert plain(calls.labelled("Medical", ["unit"])) == [
        (3, "Medical", "B1", 3.0, "Fast"), (4, "Medical", "B2", 10.0, "Normal"), (5, "Medical", "B2", None, "Slow")
    ]


def test_kind_mix_skips_nulls_and_the_unwanted_area(spark):
    df = spark.createDataFrame(
        [("N", "Y"), ("N", "Y"), ("N", "B"), ("EW", "Y"), (None, "Y"), ("S", None), ("S", "X"), ("S", "B")],
        "area STRING, kind STRING",
    )
    found = [tuple(row) for row in kind_mix(df, "area", "kind", "EW", ["Y", "B"]).collect()]
    assert found == [("N", "Y", 2), ("N", "B", 1), ("S", "B", 1)]


def test_incidents_of_a_fire_calls_file(spark, tmp_path):
    names = [field.name for field in StructType.fromDDL(FIRE_CALLS)]

    def line(**values):
        return ",".join(str(values.get(name, "")) for name in names)

    path = tmp_path / "calls.csv"
    path.write_text("\n".join([
        ",".join(names),
        line(CallNumber=1, CallType="Structure Fire", Battalion="B02", Neighborhood="Dock", Delay=2.95, ALSUnit="true"),
        line(CallNumber=2, CallType="Structure Fire", Battalion="B02", Neighborhood="Hill", Delay=4.7, ALSUnit="false"),
        line(CallNumber=3, CallType="Medical Incident", Battalion="B03", Neighborhood="Hill", CallDate="01/11/2002"),
    ]))
    calls = Incidents(read_csv(spark, str(path), FIRE_CALLS), number="CallNumber", kind="CallType", delay="Delay")
    assert calls.kinds().first().n_types == 2
    assert [tuple(row) for row in calls.delays_of("Structure Fire", "Battalion").collect()] == [("B02", 2, 3.83, 4.7)]
    assert calls.of_kind("Medical Incident", ["CallDate"]).first().CallDate == "01/11/2002"


def test_trips_and_zones(spark, tmp_path):
    trip = "1,2022-10-01 00:03:41,2022-10-01 00:18:39,1.0,1.7,1.0,N,{zone},4,2,9.5,3,0.5,2.65,0,0.3,{total},2.5,0"
    path = tmp_path / "trips.csv"
    path.write_text("\n".join(["header", trip.format(zone=1, total=15.95), trip.format(zone=1, total=0.1),
                               trip.format(zone=1, total=0.1), trip.format(zone=2, total=4.05)]))
    trips = read_csv(spark, str(path), YELLOW_TAXI)
    zones = spark.createDataFrame([(1, "N", "Dock", "Y"), (2, "N", "Hill", "Y"), (3, "S", "Vale", "B")], TAXI_ZONES)
    assert trips.select(F.date_format("lpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")).first()[0] == "2022-10-01 00:03:41"
    joined = trips.join(zones, trips["PULocationID"] == zones["LocationID"], "inner")
    assert joined.select("Zone", "total_amount").orderBy("total_amount").first() == ("Dock", 0.1)
    assert [row.Zone for row in unmatched(zones, trips, "LocationID", "PULocationID").collect()] == ["Vale"]
    totals = {row.PULocationID: row.total for row in distinct_totals(trips, "PULocationID", "total_amount", 2).collect()}
    assert totals == {1: money("16.05"), 2: money("4.05")}
