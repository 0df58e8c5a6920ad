import pytest
from pyspark.sql import functions as F

from tallyworks.operators import joins
from tallyworks.sources.inline import status_descriptions
from tests.conftest import plan, rows


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "c"), (None, "n")], "customerNumber int, name string"
    )


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [(10, 1), (11, 1), (12, 2), (13, 9), (14, None)],
        "orderNumber int, customerNumber int",
    )


def test_outer_joins_agree_with_spark(customers, orders):
    key = "customerNumber"
    mine = joins.left_outer(customers, orders, key)
    assert mine.columns == customers.join(orders, key, "left").columns
    assert rows(mine) == rows(customers.join(orders, key, "left"))
    mine = joins.right_outer(orders, customers, key)
    assert mine.columns == orders.join(customers, key, "right").columns
    assert rows(mine) == rows(orders.join(customers, key, "right"))


def test_null_keys_match_nothing(customers, orders):
    assert rows(joins.inner(customers, orders, "customerNumber")) == [
        (1, "a", 10), (1, "a", 11), (2, "b", 12),
    ]
    assert rows(joins.without_match(customers, orders, "customerNumber")) == [
        (3, "c"), (None, "n"),
    ]
    assert rows(joins.without_match(orders, customers, "customerNumber")) == [
        (9, 13), (None, 14),
    ]


def test_match_classes_count_the_full_join(customers, orders):
    got = dict(rows(joins.match_classes(customers, orders, "customerNumber")))
    assert got == {"both": 3, "only_left": 2, "only_right": 2}
    nothing = customers.limit(0)
    got = dict(rows(joins.match_classes(nothing, orders.limit(0), "customerNumber")))
    assert got == {"both": 0, "only_left": 0, "only_right": 0}


def test_match_classes_with_a_hot_key(spark):
    left = spark.range(3).select(F.lit(1).alias("k"))
    right = spark.range(50000).select(F.lit(1).alias("k"))
    got = dict(rows(joins.match_classes(left, right, "k")))
    assert got == {"both": 150000, "only_left": 0, "only_right": 0}


def test_outer_join_never_builds_an_unsplittable_join(without_broadcast, customers, orders):
    text = plan(joins.left_outer(customers, orders, "customerNumber"))
    assert "LeftOuter" not in text and "Inner" in text and "LeftAnti" in text


def test_a_hot_join_key_is_split(without_broadcast):
    spark = without_broadcast
    wanted = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
        many = spark.range(0, 60000, 1, 8).select(
            hot.alias("k"), F.xxhash64("id").alias("v")
        )
        few = spark.range(0, 60000, 1, 8).select(F.col("id").alias("k"), F.lit(1).alias("w"))
        joined = joins.left_outer(few, many, "k")
        assert len(joined.collect()) == 60000 + 20000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_unknown_statuses_get_the_default(spark):
    orders = spark.createDataFrame(
        [(1, "Shipped"), (2, "Delivered"), (3, None)], "id int, status string"
    )
    described = joins.with_description(orders, status_descriptions(spark))
    got = dict(rows(described.select("id", "status_desc")))
    assert got == {1: "Order has been shipped to customer", 2: "Unknown", 3: "Unknown"}
    assert "BroadcastHashJoin" in plan(described)


def test_outer_joins_take_shared_column_names(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    right = spark.createDataFrame([(2, "c"), (3, "d")], "k int, name string")
    assert rows(joins.left_outer(left, right, "k")) == [(1, "a", None), (2, "b", "c")]
    assert rows(joins.right_outer(left, right, "k")) == [(2, "b", "c"), (3, None, "d")]
    keys = right.select("k")
    assert rows(joins.left_outer(left, keys, "k")) == [(1, "a"), (2, "b")]


def test_full_orders_with_and_without_lines(spark):
    details = spark.createDataFrame(
        [(10, "p"), (10, "q"), (99, "p"), (11, "zz")], "orderNumber int, productCode string"
    )
    products = spark.createDataFrame(
        [("p", "P"), ("q", "Q")], "productCode string, productName string"
    )
    orders = spark.createDataFrame(
        [(10, 1), (11, 2), (12, 7)], "orderNumber int, customerNumber int"
    )
    customers = spark.createDataFrame([(1, "a"), (2, "b")], "customerNumber int, name string")
    full = joins.orders_full(details, products, orders, customers)
    assert rows(full.select("orderNumber", "productName", "name")) == [
        (10, "P", "a"), (10, "Q", "a"),
    ]
    headed = joins.orders_full(None, products, orders, customers)
    assert rows(headed.select("orderNumber", "name")) == [(10, "a"), (11, "b")]
