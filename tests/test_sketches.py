"""Sketches: merged states against exact results, hot keys, missing values, empty tables."""

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import sketches
from tests.conftest import plan

CHANCES = (0.0, 0.5, 0.95, 0.99, 1.0)


@pytest.fixture(scope="module")
def visits(spark):
    """A third of all rows under one key; every seventh value is missing."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5))
    value = F.when(F.col("id") % 7 != 0, F.pmod(F.xxhash64("id"), F.lit(20_000)))
    return spark.range(90_000, numPartitions=6).select(
        key.alias("key"), (F.col("id") % 24).alias("hour"), value.alias("value")
    )


def test_distinct_counts_of_merged_states(visits):
    states = sketches.distinct_states(visits, ["key", "hour"], "value")
    merged = {r.key: r.estimate for r in sketches.distinct_counts(states, ["key"]).collect()}
    exact = visits.groupBy("key").agg(F.count_distinct("value").alias("n")).collect()
    assert set(merged) == {r.key for r in exact} and len(exact) == 6
    for row in exact:
        assert abs(merged[row.key] - row.n) <= 4 * sketches.distinct_error() * row.n


def test_quantiles_of_merged_states(visits):
    states = sketches.quantile_states(visits, ["key", "hour"], "value")
    found = sketches.quantiles(states, ["key"], CHANCES).collect()
    numbers = {}
    for row in visits.where("value IS NOT NULL").collect():
        numbers.setdefault(row.key, []).append(row.value)
    assert len(found) == len(CHANCES) * len(numbers)
    slack = 2 * sketches.rank_error()
    for row in found:
        mine = numbers[row.key]
        assert row.n == len(mine)
        below = sum(x < row.estimate for x in mine) / row.n
        up_to = sum(x <= row.estimate for x in mine) / row.n
        assert below <= row.chance + slack and up_to >= row.chance - slack


def test_groups_without_values_and_empty_tables(spark, visits):
    none = spark.createDataFrame([("a", None), (None, 3)], "key string, value long")
    counted = sketches.distinct_counts(sketches.distinct_states(none, ["key"], "value"), ["key"])
    assert {tuple(r) for r in counted.collect()} == {("a", 0), (None, 1)}
    states = sketches.quantile_states(none, ["key"], "value")
    found = sketches.quantiles(states, ["key"], [0.5]).collect()
    assert {(r.key, r.n, r.estimate) for r in found} == {("a", 0, None), (None, 1, 3.0)}
    empty = visits.where("false")
    assert sketches.distinct_states(empty, ["key"], "value").count() == 0
    assert sketches.quantile_states(empty, ["key"], "value").count() == 0


def test_states_are_built_before_the_shuffle(visits):
    for states in (sketches.distinct_states, sketches.quantile_states):
        text = plan(states(visits, ["key"], "value"))
        assert "partial_" in text and text.count("Exchange") == 1
