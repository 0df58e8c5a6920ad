"""Sharing one computed frame between several results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.money import money_sum
from tallyworks.functions.numeric import affine_steps
from tallyworks.operators.aggregates import number_totals, revenue_enrich
from tallyworks.session import cut_lineage, spread_evenly

LEVELS = {
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
    "MEMORY_AND_DISK_DESER": StorageLevel.MEMORY_AND_DISK_DESER,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
}
CACHE_POINTS = ("none", "cleaned", "enriched", "both")


@contextmanager
def persisted(df: DataFrame, level: str = "MEMORY_AND_DISK") -> Iterator[DataFrame]:
    """Keep ``df`` for the block and release it after.

    Results must be computed inside the block, by ``session.cut_lineage`` if small and
    by ``session.keep_table`` if not. A lost executor costs only a recomputation of
    what it held.
    """
    df.persist(LEVELS[level])
    try:
        yield df
    finally:
        df.unpersist()


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def cached_totals(df: DataFrame, value: str) -> DataFrame:
    """Count, sum and largest as rows, from one pass over the frame."""
    totals = number_totals(df, value)
    measures = {"count": "n", "sum": "total", "max": "largest"}
    listed = [
        F.struct(F.lit(name).alias("measure"), F.col(column).cast("bigint").alias("value"))
        for name, column in measures.items()
    ]
    return totals.select(F.inline(F.array(*listed)))


def totals_by_level(df: DataFrame, value: str) -> DataFrame:
    """The same totals as kept under every storage level; the frame is read once."""
    totals = cut_lineage(number_totals(df, value))
    parts = []
    for level in LEVELS:
        with persisted(totals.select(F.lit(level).alias("level"), "*"), level) as kept:
            parts.append(cut_lineage(kept))
    return _union(parts)


def shared_enrichment(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Customer, product and category results of the sales, enriched and scanned once.

    All three groupings are summed on the map side, so no enriched line is kept or shuffled.
    """
    enriched = revenue_enrich(sales.select("customerNumber", "productCode", "quantity"), products)
    keys = {
        "customerNumber": "customer_ltv",
        "productCode": "product_popularity",
        "productCategory": "category_revenue",
    }
    # Each line once for every grouping, with the measure that the grouping sums.
    listed = [
        F.struct(
            F.lit(name).alias("metric"),
            F.col(key).cast("string").alias("key"),
            F.when(F.lit(name == "product_popularity"), F.col("quantity")).cast("double").alias("units"),
            F.when(F.lit(name != "product_popularity"), F.col("revenue")).alias("revenue"),
        )
        for key, name in keys.items()
    ]
    summed = (
        enriched.select(F.inline(F.array(*listed)))
        .groupBy("metric", "key")
        .agg(
            F.sum("units").cast("bigint").cast("double").alias("units"),
            money_sum("revenue").alias("revenue"),
        )
    )
    value = F.when(F.col("metric") == "product_popularity", F.col("units")).otherwise(F.col("revenue"))
    return summed.select("metric", "key", value.alias("value"))


def cleaned(df: DataFrame, x: str) -> DataFrame:
    """Double the number; keep what is not a multiple of three."""
    doubled = df.select((F.col(x) * 2).alias("x"))
    return doubled.where(F.col("x") % 3 != 0)


def enriched(clean: DataFrame, steps: int = 1000) -> DataFrame:
    return spread_evenly(clean).select(affine_steps(F.col("x"), steps).alias("y"))


def enriched_totals(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("y").alias("n"),
        F.sum("y").alias("total"),
        F.max("y").alias("largest"),
    )


def clean_enrich(df: DataFrame, x: str, cache_point: str = "none") -> DataFrame:
    """Clean, enrich and total, keeping the stages that ``cache_point`` names."""
    if cache_point not in CACHE_POINTS:
        raise ValueError(f"unknown cache point: {cache_point}")
    clean = cleaned(df, x)
    rows = enriched(clean)
    if cache_point == "none":
        return enriched_totals(rows)
    with ExitStack() as stack:
        if cache_point in ("cleaned", "both"):
            stack.enter_context(persisted(clean))
        if cache_point in ("enriched", "both"):
            stack.enter_context(persisted(rows))
        return cut_lineage(enriched_totals(rows))
