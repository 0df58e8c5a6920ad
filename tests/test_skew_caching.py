import pytest
from pyspark.sql import functions as F

from tallyworks.operators import caching, skew
from tests.conftest import plan, rows


@pytest.fixture
def pairs(spark):
    """Four fifths of the rows on one key; one key holds the salt mark in its text."""
    rest = F.col("id") % 50
    key = (
        F.when(rest < 40, "hot")
        .when(rest == 40, "odd_salt_3")
        .otherwise(F.concat(F.lit("cold "), rest.cast("string")))
    )
    return spark.range(10000).select("id", key.alias("key"), F.col("id").alias("value"))


def test_salted_sum_is_the_plain_sum(pairs):
    doubled = F.col("value") * 2
    plain = skew.key_sum(pairs, "key", doubled)
    assert rows(skew.salted_sum(pairs, "key", doubled, ("id",))) == rows(plain)
    assert rows(skew.key_sum(pairs.repartition(16), "key", doubled)) == rows(plain)


def test_sums_are_partly_made_before_the_shuffle(pairs):
    assert "partial_sum" in plan(skew.key_sum(pairs, "key", F.col("value")))


def test_hot_keys(pairs):
    assert rows(skew.hot_keys(pairs, "key")) == [("hot", 8000, 0.8)]
    assert len(rows(skew.hot_keys(pairs, "key", 0.01))) == 11


def test_shares_shuffle_the_keys_once(pairs):
    hot = skew.hot_keys(pairs, "key")
    hot.collect()
    assert "ReusedExchange" in plan(hot)


def test_only_hot_keys_are_salted(pairs):
    salted = skew.salt_keys(pairs, "key", ("hot",), 10, F.col("id"))
    counts = dict(rows(skew.salted_key_counts(salted, "key")))
    assert counts["hot_salt_0"] == 800
    assert counts["odd_salt_3"] == 200
    assert len(counts) == 20
    back = salted.groupBy("key").count()
    assert rows(back) == rows(pairs.groupBy("key").count())


def persistent(spark):
    return spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_cached_results_equal_uncached_and_nothing_stays_cached(spark, pairs):
    before = persistent(spark)
    assert dict(rows(caching.cached_totals(pairs, "value"))) == {
        "count": 10000, "sum": 49995000, "max": 9999,
    }
    assert plan(caching.cached_totals(pairs, "value")).count("Exchange") == 1
    by_level = caching.totals_by_level(pairs, "value").collect()
    assert {r["level"] for r in by_level} == set(caching.LEVELS)
    assert {tuple(r)[1:] for r in by_level} == {(10000, 49995000, 9999)}
    assert persistent(spark) == before


def test_cache_is_released_after_an_error(spark):
    df = spark.range(10)
    with pytest.raises(RuntimeError):
        with caching.persisted(df) as shared:
            shared.count()
            raise RuntimeError
    assert not df.is_cached


def test_cache_points_give_one_result(pairs):
    results = {
        tuple(caching.clean_enrich(pairs, "value", point).first())[0::2]
        for point in caching.CACHE_POINTS
    }
    assert len(results) == 1
    assert next(iter(results))[0] == sum(1 for x in range(10000) if x * 2 % 3)
    with pytest.raises(ValueError):
        caching.clean_enrich(pairs, "value", "nowhere")


def test_costly_steps_are_spread_over_tasks(spark):
    one_split = spark.range(900).coalesce(1)
    clean = caching.cleaned(one_split, "id")
    parts = caching.enriched(clean, 3).select(F.spark_partition_id().alias("part"))
    sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 2 * min(sizes) + 2


def test_shared_enrichment(spark):
    sales = spark.createDataFrame(
        [(1, "p", 3.0), (2, "p", 1.0)],
        "customerNumber int, productCode string, quantity double",
    )
    products = spark.createDataFrame(
        [("p", "Office", 1.5)],
        "productCode string, productCategory string, buyPrice double",
    )
    assert rows(caching.shared_enrichment(sales, products)) == [
        ("category_revenue", "Office", 6.0),
        ("customer_ltv", "1", 4.5),
        ("customer_ltv", "2", 1.5),
        ("product_popularity", "p", 4.0),
    ]
    # One shuffle for all three results, after partial sums.
    text = plan(caching.shared_enrichment(sales, products).hint("rebalance"))
    assert "partial_sum" in text and "InMemory" not in text
