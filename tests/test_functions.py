import hashlib
import math
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyworks.functions import buckets, classify, money, numeric, text
from tallyworks.functions.once import once
from tests.conftest import rows


def amounts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_money_sum_is_exact_and_order_free(spark):
    generator = random.Random(7)
    cents = [generator.randint(-(10**9), 10**11) for _ in range(5000)]
    values = [c / 100 for c in cents]
    expected = float(Decimal(sum(cents)) / 100)
    for order in (values, sorted(values), sorted(values, reverse=True)):
        assert amounts(spark, order).agg(money.money_sum("x")).first()[0] == expected


def test_money_sum_beyond_the_range_of_a_long(spark):
    # 2,000 times 9e13 is 1.8e19 cents.
    df = spark.range(2000).select(F.lit(9e13).alias("x"))
    assert df.agg(money.money_sum("x")).first()[0] == 1.8e17


def test_money_of_nothing_is_null(spark):
    empty = amounts(spark, [])
    assert empty.agg(money.money_sum("x"), money.money_avg("x")).first() == (None, None)
    nulls = amounts(spark, [None, None])
    assert nulls.agg(money.money_sum("x"), money.money_avg("x")).first() == (None, None)


@pytest.mark.parametrize(
    "values, expected",
    [
        ([0.004] * 1000, 4.0),
        ([-0.125, -0.125], -0.25),
        ([1e18, 1.0, 0.25], 1e18),
        ([float("inf"), 1.0], float("inf")),
        ([19.99 * 3, 0.01], 59.98),
    ],
)
def test_money_sum_loses_nothing(spark, values, expected):
    got = amounts(spark, values).agg(money.money_sum("x")).first()[0]
    assert got == expected or math.isclose(got, expected, rel_tol=1e-12)
    nan = amounts(spark, [*values, float("nan")])
    assert all(math.isnan(v) for v in nan.agg(money.money_sum("x"), money.money_avg("x")).first())


def test_suffixes_that_are_no_numbers(spark):
    df = spark.createDataFrame([("A_3",), ("A",), ("A_x",), (None,)], "k string")
    got = [r[0] for r in df.select(buckets.suffix_number(F.col("k"))).collect()]
    assert got == [3, None, None, None]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([0.01, 0.02], 0.02),  # 0.015: a half goes up
        ([-0.01, -0.02], -0.02),
        ([1.0, None, 2.0], 1.5),
        ([231117.79, 231117.80], 231117.80),
        ([10.0, 10.0, 10.01], 10.0),
    ],
)
def test_money_avg_rounds_exactly(spark, values, expected):
    assert amounts(spark, values).agg(money.money_avg("x")).first()[0] == expected


@settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.integers(-(10**10), 10**10), min_size=1, max_size=30))
def test_money_avg_property(spark, cents):
    total, n = sum(cents), len(cents)
    nearest = (2 * abs(total) + n) // (2 * n)
    expected = math.copysign(nearest, total) / 100 if total else 0.0
    got = amounts(spark, [c / 100 for c in cents]).agg(money.money_avg("x")).first()[0]
    assert got == expected


def test_classes_at_their_limits(spark):
    df = amounts(spark, [999.99, 1000.0, 4999.99, 5000.0, None])
    got = df.select("x", classify.order_size(F.col("x"))).collect()
    assert [r[1] for r in got] == ["Small", "Medium", "Medium", "Large", "Large"]
    df = amounts(spark, [2000.0, 2000.01, 5000.0, 5000.01, None])
    got = df.select(classify.order_priority(F.col("x"))).collect()
    assert [r[0] for r in got] == ["Low", "Medium", "Medium", "High", "Low"]
    df = amounts(spark, [24999.0, 25000.0, 75000.0, 75000.01, None])
    got = df.select(classify.credit_tier(F.col("x"))).collect()
    assert [r[0] for r in got] == ["Low", "Medium", "Medium", "High", "Low"]


def test_words_split_as_python_does(spark):
    texts = [
        "hello world",
        "  lead and\ttrail \n",
        "",
        "   ",
        "tab\x0bform\x0cfeed\x1cgroup",
        "nbsp thin ideographic　next\x85line",
        "zero​width stays",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(text.words(F.col("t"))).collect()]
    assert got == [t.split() for t in texts]


def test_codes_keep_long_numbers(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n bigint")
    got = [r[0] for r in df.select(text.padded_code("ORDER", F.col("n"))).collect()]
    assert got == ["ORDER-00007", "ORDER-1234567"]


def test_stepwise_affine_has_the_bits_of_a_loop(spark):
    df = spark.createDataFrame([(0.0,), (3.0,), (-2.5,), (100000.0,)], "x double")
    stepwise = numeric.affine_steps(F.col("x"))
    for x, slow in df.select("x", stepwise).collect():
        value = x
        for _ in range(1000):
            value = (value * 1.1 + 0.5) / 1.05
        assert slow == value


def test_affine_steps_of_any_number(spark):
    rows = [(1,), (None,), (7,)] * 3000
    df = spark.createDataFrame(rows, "x int").coalesce(1)
    for steps in (3, 20, 47):
        stepped = df.select("x", numeric.affine_steps(F.col("x"), steps).alias("y"))
        expected = {None: None}
        for x in (1, 7):
            value = float(x)
            for _ in range(steps):
                value = (value * 1.1 + 0.5) / 1.05
            expected[x] = value
        assert [r.y for r in stepped.collect()] == [expected[x] for (x,) in rows]


def test_md5_bucket_is_the_whole_digest(spark):
    keys = ["", "a", "a longer key", "4711", "été"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for n in (1, 4, 7, 1000):
        got = [r[0] for r in df.select(buckets.md5_bucket(F.col("k"), n)).collect()]
        assert got == [int(hashlib.md5(k.encode()).hexdigest(), 16) % n for k in keys]


def test_buckets(spark):
    df = spark.createDataFrame([(1,), (20,), (21,), (30,), (31,)], "k int")
    got = df.select(buckets.range_bucket(F.col("k"), [20, 30])).collect()
    assert [r[0] for r in got] == [0, 0, 1, 1, 2]
    df = spark.createDataFrame([(-1,), (4,), (7,)], "k int")
    got = df.select(buckets.modulo_bucket(F.col("k"), 4)).collect()
    assert [r[0] for r in got] == [3, 0, 3]
    df = spark.createDataFrame([("UK_201",), ("XX_1",), (None,), ("a_b_17",)], "k string")
    named = buckets.named_bucket(buckets.key_prefix(F.col("k")), {"USA": 0, "UK": 1}, 0)
    got = df.select(named, buckets.suffix_number(F.col("k"))).collect()
    assert [tuple(r) for r in got] == [(1, 201), (0, 1), (0, None), (0, 17)]


def test_row_salt_is_stable_and_spread(spark):
    salted = spark.range(10000).select("id", buckets.row_salt(10, "id").alias("s"))
    counts = {r["s"]: r["count"] for r in salted.groupBy("s").count().collect()}
    assert set(counts) == set(range(10))
    assert max(counts.values()) < 2 * min(counts.values())
    again = spark.range(10000).repartition(7).select("id", buckets.row_salt(10, "id").alias("s"))
    assert rows(salted) == rows(again)


def test_once_keeps_nulls_and_rows(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert rows(df.select("x", once(F.col("x") + 1).alias("y"))) == [(1, 2), (None, None)]
