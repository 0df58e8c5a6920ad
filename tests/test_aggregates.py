import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import aggregates as agg
from tests.conftest import plan, rows

ORDER_COLUMNS = (
    "orderNumber bigint, orderDate date, status string, customerNumber int, "
    "totalAmount double"
)


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (1, dt.date(2023, 1, 5), "Shipped", 1, 10.10),
            (2, dt.date(2024, 1, 6), "Shipped", 1, 20.20),
            (3, dt.date(2024, 2, 1), "Pending", 2, 30.30),
            (4, dt.date(2024, 12, 31), "Pending", 3, 30.30),
            (5, None, None, None, None),
        ],
        ORDER_COLUMNS,
    )


def test_statistics(orders):
    got = agg.amount_stats(orders).first()
    assert got["total"] == 90.9 and got["orders"] == 4 and got["average"] == 22.73
    population = statistics.pstdev([10.10, 20.20, 30.30, 30.30])
    assert got["deviation"] == round(population, 4)
    got = agg.order_amount_stats(orders).first()
    assert tuple(got) == (4, 10.10, 30.30, 22.73, 90.9)
    assert tuple(agg.order_amount_stats(orders.limit(0)).first()) == (0, None, None, None, None)


def test_ranked_counts_break_ties_by_key(orders):
    got = [tuple(r) for r in agg.ranked_counts(orders, "status").collect()]
    assert got == [("Pending", 2), ("Shipped", 2), (None, 1)]
    assert [tuple(r) for r in agg.most_common(orders, "status").collect()] == [("Pending", 2)]
    assert "TakeOrderedAndProject" in plan(agg.top_counts(orders, "status"))


def test_count_shares(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k")
    )
    got = [tuple(r) for r in agg.count_shares(df, "k").collect()]
    assert got == [("hot", 900, 90.0), ("cold", 100, 10.0)]


def test_months(orders):
    assert rows(agg.monthly_revenue(orders)) == [
        ("2023-01", 10.1), ("2024-01", 20.2), ("2024-02", 30.3), ("2024-12", 30.3),
        (None, None),
    ]
    pooled = {r[0]: r[1] for r in agg.orders_by_month(orders).collect()}
    assert pooled == {1: 2, 2: 1, 12: 1, None: 1}


def test_per_customer(orders):
    assert rows(agg.total_per_customer(orders)) == [
        (1, 30.3), (2, 30.3), (3, 30.3), (None, None),
    ]
    top = [r[0] for r in agg.largest_totals(orders, 2).collect()]
    assert top == [1, 2]
    assert rows(agg.customer_order_stats(orders))[0] == (1, 30.3, 2, 10.1, 20.2)
    assert rows(agg.avg_per_customer(orders))[0] == (1, 15.15)
    assert dict(rows(agg.revenue_by_status(orders)))["Pending"] == 60.6


def test_rfm_takes_the_latest_order_even_on_the_reference_date(spark):
    orders = spark.createDataFrame(
        [
            (1, dt.date(2024, 12, 1), "s", 1, 5.0),
            (2, dt.date(2024, 1, 1), "s", 1, 5.0),
            (3, dt.date(2024, 12, 11), "s", 2, 1.0),
        ],
        ORDER_COLUMNS,
    )
    assert rows(agg.rfm(orders)) == [(1, 0, 2, 10.0), (2, -10, 1, 1.0)]


def test_grouped_values_are_cut_by_position(spark):
    data = [(7, i, float(i)) for i in range(100)] + [(8, 5, 0.5), (8, 3, 0.3)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k int, pos bigint, v double")
    got = agg.grouped_values(df, "k", "pos", "v", span=30).collect()
    small = [r for r in got if r["k"] == 8]
    assert [(r["piece"], r["grouped"]) for r in small] == [(0, [0.3, 0.5])]
    large = sorted((r for r in got if r["k"] == 7), key=lambda r: r["piece"])
    assert [len(r["grouped"]) for r in large] == [30, 30, 30, 10]
    assert [v for r in large for v in r["grouped"]] == [float(i) for i in range(100)]


def test_no_list_outgrows_its_span(spark):
    data = [(None, i % 4, 1.0) for i in range(40)] + [(1, None, 2.0)] * 40 + [(1, 9, 3.0)]
    df = spark.createDataFrame(data, "k int, pos bigint, v double")
    got = agg.grouped_values(df, "k", "pos", "v", span=5).collect()
    assert sum(len(r["grouped"]) for r in got) == 81
    assert max(len(r["grouped"]) for r in got) <= 5


def test_fractional_quantities_count(spark):
    sales = spark.createDataFrame(
        [("a", 0.5), ("a", 0.25), ("b", 3.0)], "productCode string, quantity double"
    )
    products = spark.createDataFrame(
        [("a", "x", 10.0), ("b", "x", 1.99)],
        "productCode string, productCategory string, buyPrice double",
    )
    shuffled = agg.category_revenue_shuffle(sales, products)
    plain = agg.category_revenue(agg.revenue_enrich(sales, products))
    assert rows(shuffled) == rows(plain) == [("x", 13.47)]


def test_distinct_values_come_from_one_scan(orders):
    found = agg.distinct_values(orders, "status", "customerNumber")
    assert len(rows(found)) == 3 + 4
    assert plan(found).count("Scan") == 1


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [("p", "Pen", "Office", 5, 1.10, 2.0), ("l", "Lamp", "Home", 7, 9.99, 20.0),
         ("d", "Desk", "Home", 1, 99.0, 150.0)],
        "productCode string, productName string, productCategory string, "
        "quantityInStock int, buyPrice double, MSRP double",
    )


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(1, "p", 3.0), (1, "l", 1.0), (2, "p", 2.0), (2, "d", 1.0), (3, "none", 1.0)],
        "customerNumber int, productCode string, quantity double",
    )


def test_sales(sales, products):
    enriched = agg.revenue_enrich(sales, products)
    assert rows(agg.customer_ltv(enriched)) == [(1, 13.29), (2, 101.2)]
    assert [tuple(r) for r in agg.top_customers(enriched, 1).collect()] == [(2, 101.2)]
    assert dict(rows(agg.product_popularity(sales)))["p"] == 5
    expected = [("Home", 108.99), ("Office", 5.5)]
    assert rows(agg.category_revenue(enriched)) == expected
    shuffled = agg.category_revenue_shuffle(sales, products)
    assert rows(shuffled) == expected
    assert "SortMergeJoin" in plan(shuffled)
    measured = agg.category_revenue(enriched)
    assert rows(measured) == expected and "BroadcastHashJoin" in plan(measured)


def test_products(products):
    assert tuple(agg.product_price_stats(products).first()) == (
        1.1, 99.0, 36.7, 2.0, 150.0, 57.33,
    )
    assert tuple(agg.product_price_totals(products).first()) == (110.09, 36.7, 172.0, 57.33)
    assert [tuple(r) for r in agg.category_most_stock(products).collect()] == [("Home", 8)]


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [(1, "USA", "Enterprise", 10.0), (2, "USA", "SMB", 20.0), (3, "Peru", "SMB", 30.0)],
        "customerNumber int, country string, customerSegment string, creditLimit double",
    )


def test_business_questions(customers, products, orders):
    top = [tuple(r) for r in agg.top_country_credit(customers).collect()]
    assert top == [("Peru", 30.0)]
    assert rows(agg.segment_share(customers)) == [
        ("Enterprise Customers", 1.0), ("Enterprise Percentage", 33.33),
        ("Total Customers", 3.0),
    ]
    nobody = dict(rows(agg.segment_share(customers.limit(0))))
    assert nobody["Enterprise Percentage"] is None
    summary = agg.business_summary(customers, products, orders)
    assert dict(rows(summary)) == {
        "Total Customers": 3.0, "Total Products": 3.0, "Total Orders": 5.0,
        "Total Revenue": 90.9, "Average Order Value": 22.73,
    }
    assert dict(summary.dtypes) == {"Metric": "string", "Value": "double"}
    assert rows(agg.credit_by_segment(customers)) == [
        ("Enterprise", 1, 10.0, 10.0), ("SMB", 2, 25.0, 30.0),
    ]
    assert rows(agg.avg_credit_by_segment(customers)) == [("Enterprise", 10.0), ("SMB", 25.0)]


def test_order_line_summary_with_and_without_lines(spark, customers, products, orders):
    details = spark.createDataFrame(
        [(1, "p", 1.0), (1, "l", 2.0), (3, "p", 4.0), (99, "p", 8.0)],
        "orderNumber int, productCode string, priceEach double",
    )
    got = dict(rows(agg.order_line_summary(details, products, orders, customers)))
    assert got["Total Revenue"] == 7.0 and got["Average Order Value"] == 3.5
    without = dict(rows(agg.order_line_summary(None, products, orders, customers)))
    assert set(without) == {"Total Customers", "Total Products", "Total Orders"}
    by_product = agg.revenue_by_product(details, products, orders, customers)
    assert [tuple(r) for r in by_product.collect()] == [("Pen", 5.0), ("Lamp", 2.0)]


def test_size_distribution_counts_null_as_large(orders):
    got = dict(rows(agg.order_size_distribution(orders, 15, 25)))
    assert got == {"Small": 1, "Medium": 1, "Large": 3}
