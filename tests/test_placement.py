import hashlib

import pytest
from pyspark.sql import functions as F

from tallyworks.functions.buckets import md5_bucket, modulo_bucket, range_bucket
from tallyworks.operators import placement
from tallyworks.operators.aggregates import total_per_customer
from tallyworks.session import work_path
from tests.conftest import plan, rows


@pytest.fixture
def orders(spark):
    customers = [11, 12, 11, 13, 20, 11, 21, 12, 30, 39, 50, None]
    return spark.createDataFrame(
        [(i, c, i + 0.25) for i, c in enumerate(customers)],
        "orderNumber int, customerNumber int, totalAmount double",
    )


def where(placed):
    """Spark partition of every order."""
    located = placed.rows.select("orderNumber", F.spark_partition_id())
    return dict(tuple(r) for r in located.collect())


def test_rows_are_where_the_bucket_says(orders):
    bucket = range_bucket(F.col("customerNumber"), [20, 30])
    known = F.when(F.col("customerNumber").isNotNull(), bucket)
    placed = placement.place(orders, known, 3)
    assert placed.tasks == (1, 1, 1)
    expected = {}
    for i, c in [(r[0], r[1]) for r in orders.collect()]:
        expected[i] = 0 if c is None or c <= 20 else 1 if c <= 30 else 2
    assert where(placed) == expected
    assert dict(rows(placement.partition_rows(placed))) == {0: 8, 1: 2, 2: 2}


def test_md5_places_as_python_would(orders):
    numbered = orders.where("customerNumber IS NOT NULL")
    placed = placement.place(numbered, md5_bucket(F.col("customerNumber"), 4), 4)
    for number, customer, _ in numbered.collect():
        digest = int(hashlib.md5(str(customer).encode()).hexdigest(), 16)
        assert where(placed)[number] == digest % 4


def test_a_hot_partition_gets_more_tasks(spark):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 3).cast("int").alias("b")
    )
    placed = placement.place(df, F.col("b"), 3, row_id=["id"], tasks={1: 10})
    expected = {r["b"]: r["n"] for r in df.groupBy("b").agg(F.count("*").alias("n")).collect()}
    assert placed.tasks == (1, 10, 1)
    assert dict(rows(placement.partition_rows(placed))) == expected
    sizes = placed.rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 12
    assert max(r["count"] for r in sizes) < 200


def test_exact_copies_are_spread_by_their_place_in_the_scan(spark):
    path = work_path(spark, "copies")
    spark.range(1000, numPartitions=4).select(F.lit(5).alias("k")).write.parquet(path)
    copies = spark.read.parquet(path)
    placed = placement.place(copies, F.lit(1), 2, tasks={1: 10})
    assert placed.tasks == (1, 10)
    assert placed.rows.columns == ["k"]
    assert rows(placement.partition_rows(placed)) == [(1, 1000)]
    sizes = placed.rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) <= 104


def test_totals_survive_splitting(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"), F.lit(0.1).alias("v"))
    bucket = modulo_bucket(F.col("k"), 2)
    plain = placement.place(df, bucket, 2, row_id=["id"])
    split = placement.place(df, bucket, 2, row_id=["id"], tasks={0: 12, 1: 9})
    assert sum(split.tasks) > 2
    one = placement.partition_totals(plain, F.col("k"), "v")
    other = placement.partition_totals(split, F.col("k"), "v")
    assert rows(one) == rows(other) == [(0, 571, 4, 57.1), (1, 429, 3, 42.9)]


def test_sums_and_contents(spark):
    df = spark.range(1, 11, 1, 3)
    placed = placement.place(df, modulo_bucket(F.col("id"), 3), 3, row_id=["id"])
    assert rows(placement.partition_sums(placed, "id")) == [(0, 18), (1, 22), (2, 15)]
    contents = placement.partition_contents(placed, "id", span=6)
    assert rows(contents) == [
        (0, 0, [3]), (0, 1, [6, 9]), (1, 0, [1, 4]), (1, 1, [7, 10]),
        (2, 0, [2, 5]), (2, 1, [8]),
    ]


def test_top_key_takes_the_smaller_of_equals(spark):
    df = spark.createDataFrame(
        [(0, 0, "b"), (1, 0, "a"), (2, 1, "x"), (3, 1, "y"), (4, 1, "y")],
        "id int, p int, k string",
    )
    placed = placement.place(df, F.col("p"), 2, row_id=["id"])
    assert rows(placement.partition_top_key(placed, "k")) == [(0, 2, "a", 1), (1, 3, "y", 2)]


def test_sums_by_key_do_not_depend_on_placement(orders):
    expected = rows(total_per_customer(orders))
    customer = F.col("customerNumber")
    for bucket, n in [
        (range_bucket(customer, [20, 30]), 3),
        (modulo_bucket(customer, 4), 4),
        (md5_bucket(customer, 5), 5),
    ]:
        placed = placement.place(orders, bucket, n, row_id=["orderNumber"], tasks={0: 3, 1: 2})
        assert rows(total_per_customer(placed.rows)) == expected


def test_more_and_fewer_partitions_keep_the_rows(orders):
    more = orders.repartition(4, "orderNumber")
    fewer = more.coalesce(2)
    for df, label, limit in ((more, "up", 4), (fewer, "down", 2)):
        step, partitions, n, total = placement.partition_count(df, label, "totalAmount").first()
        assert (step, n, total) == (label, 12, 69.0) and partitions <= limit


def test_even_bounds_follow_the_data(spark):
    df = spark.range(1000).select("id", (F.col("id") * F.col("id")).alias("k"))
    bounds = placement.even_bounds(df, "k", 4)
    placed = placement.place(df, range_bucket(F.col("k"), bounds), 4, row_id=["id"])
    sizes = dict(rows(placement.partition_rows(placed)))
    assert len(sizes) == 4 and all(245 <= n <= 255 for n in sizes.values())
    one_key = df.withColumn("k", F.lit(7))
    assert placement.even_bounds(one_key, "k", 4) == [7]
    assert placement.even_bounds(one_key.limit(0), "k", 4) == []


def test_many_partitions_and_bounds(spark):
    df = spark.range(2000)
    bounds = list(range(0, 20_000, 2))
    got = df.select("id", range_bucket(F.col("id"), bounds).alias("b")).collect()
    assert all(r["b"] == (r["id"] + 1) // 2 for r in got)
    placed = placement.place(df, modulo_bucket(F.col("id"), 10_000), 10_000, tasks={7: 3})
    ids = placed.rows.select("id", placed.partition_id().alias("p")).where("id < 20")
    assert all(r["p"] == r["id"] for r in ids.collect())
    assert df.select(range_bucket(F.lit(None).cast("long"), [1, 2])).first()[0] == 2


def test_placement_is_one_shuffle(orders):
    placed = placement.place(orders, modulo_bucket(F.col("orderNumber"), 4), 4)
    assert plan(placed.rows).count("Exchange") == 1
