import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas
from tallyworks.operators import filters, projections
from tests.conftest import plan, rows


def order(number, date="2024-06-01", status="Shipped", customer=1, amount=100.0, pay="PayPal"):
    day = dt.date.fromisoformat(date) if date else None
    return (number, day, day, status, customer, amount, pay)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            order(1, "2024-05-31", "Shipped", 1, 5000.0),
            order(2, "2024-06-01", "Processing", 100, 5000.01, "Cash"),
            order(3, "2024-09-30", "On Hold", 101, 1000.0),
            order(4, "2024-10-01", "Cancelled", 0, 1000.01),
            order(5, "2024-12-31", "Shipped", 50, 9000.0),
            order(6, "2025-01-01", "Processing", 2, 9000.0),
            order(7, None, None, None, None, None),
        ],
        schemas.ORDERS,
    )


def numbers(df):
    return sorted(row["orderNumber"] for row in df.collect())


def test_limits_are_exclusive_and_nulls_fail(orders):
    assert numbers(filters.high_value(orders)) == [2, 5, 6]
    assert numbers(filters.status_above(orders, ["Shipped"], 2000)) == [1, 5]
    assert numbers(filters.status_above(orders, ["On Hold", "Cancelled"], 1000)) == [4]
    assert numbers(filters.paid_above(orders)) == [1, 5, 6]


def test_ranges_are_inclusive(orders):
    assert numbers(filters.amount_between(orders)) == [1, 3, 4]
    assert numbers(filters.early_customers(orders)) == [1, 2, 5, 6]
    assert numbers(filters.from_date(orders)) == [2, 3, 4, 5, 6]


def test_fourth_quarter_is_a_date_range(orders):
    found = filters.fourth_quarter(orders)
    assert numbers(found) == [4, 5]
    assert "year(" not in plan(found)


def test_status_filters(orders):
    assert numbers(filters.with_status(orders, "Processing")) == [2, 6]
    assert numbers(filters.with_status(orders, "Processing", "Shipped")) == [1, 2, 5, 6]


def test_endpoint_modes(spark):
    pages = spark.createDataFrame(
        [("/product/1",), ("/products",), ("/home",), (None,)], "p string"
    )
    page = F.col("p")

    def found(mode, text):
        return rows(pages.where(filters.endpoint_matches(page, mode, text)))

    assert found("exact", "/products") == [("/products",)]
    assert found("prefix", "/product/") == [("/product/1",)]
    assert found("contains", "product") == [("/product/1",), ("/products",)]
    with pytest.raises(ValueError):
        filters.endpoint_matches(page, "regex", "x")


def test_sample_keeps_rows_at_most_once(spark):
    sample = filters.sample_rows(spark.range(20000))
    ids = [row[0] for row in sample.collect()]
    assert len(ids) == len(set(ids))
    assert 1700 < len(ids) < 2300
    assert ids == [row[0] for row in filters.sample_rows(spark.range(20000)).collect()]


def test_first_rows_do_not_sort_everything(spark):
    first = filters.first_rows(spark.range(1000), 3, "id")
    assert rows(first) == [(0,), (1,), (2,)]
    assert "TakeOrderedAndProject" in plan(first)


def test_customer_filters(spark):
    customers = spark.createDataFrame(
        [("a", "USA", 50000.0), ("b", "Canada", 50000.01), ("c", None, None)],
        "customerName string, country string, creditLimit double",
    )
    assert filters.in_country(customers).count() == 1
    assert [r[0] for r in filters.high_credit(customers).collect()] == ["b"]


def test_order_projections(orders):
    assert projections.order_summary(orders).columns == ["id", "date", "amount", "status"]
    left = projections.without_columns(orders, "requiredDate", "paymentMethod")
    assert len(left.columns) == 5
    sizes = projections.with_order_size(orders).select("orderNumber", "orderSize")
    assert dict(rows(sizes))[7] == "Large"
    shipped = projections.shipped_priority(orders)
    assert [r[3] for r in rows(shipped)] == ["Medium", "High"]


def test_largest_orders_break_ties_by_number(orders):
    top = projections.largest_open_orders(orders, count=2)
    got = [(r["orderCode"], r["isLargeOrder"]) for r in top.collect()]
    assert got == [("ORDER-00005", True), ("ORDER-00006", True)]
    assert "TakeOrderedAndProject" in plan(top)


def test_customer_projections(spark):
    customers = spark.createDataFrame(
        [(31, "Ines", "0", "Porto", "Portugal", "Enterprise", 75000.5),
         (32, "Juma", "1", "Arusha", "Tanzania", "SMB", 25000.0)],
        "customerNumber int, customerName string, phone string, city string, "
        "country string, customerSegment string, creditLimit double",
    )
    upper = projections.upper_names(customers)
    assert rows(upper) == [("Ines", "0", "Porto", "Portugal", "INES")]
    assert rows(projections.city_country(customers)) == [
        ("Arusha", "Tanzania"), ("Porto", "Portugal"),
    ]
    assert rows(projections.formatted_ids(customers)) == [
        (31, "CUST-00031"), (32, "CUST-00032"),
    ]
    assert [r[3] for r in rows(projections.customer_tiers(customers))] == ["High", "Medium"]


def test_maps(spark, orders):
    numbers_ = spark.range(1, 4).withColumn("v", F.col("id"))
    assert rows(projections.squared(numbers_, "id", "v")) == [(1, 1, 1), (2, 2, 4), (3, 3, 9)]
    taxed = projections.amount_with_tax(orders).where("customerNumber = 1").first()
    assert taxed["with_tax"] == 5000.0 * 1.1
    texts = spark.createDataFrame([(1, "hello  world"), (2, " "), (3, None)], "i int, t string")
    assert rows(projections.explode_words(texts, "i", "t")) == [(1, "hello"), (1, "world")]


def test_scaled_per_partition(spark):
    df = spark.range(1, 11, 1, 3).withColumn("label", F.lit("x"))
    scaled = projections.scaled_per_partition(df, "id")
    assert rows(scaled) == sorted([(i * 10, "x") for i in range(1, 11)], key=repr)
    assert scaled.schema == df.schema


def test_only_the_per_partition_map_needs_python(orders):
    for df in (
        filters.high_value(orders),
        projections.largest_open_orders(orders),
        projections.shipped_priority(orders),
    ):
        assert "Python" not in plan(df).replace("MapInPython", "")
