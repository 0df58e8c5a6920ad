"""Joins between customers, orders, order lines and products.

A hot key may hold a large part of the orders. Inner joins leave that to the
adaptive skew join. An outer join cannot split the side it does not preserve, so the
outer joins here are an inner join plus the rows without a match, found against the
distinct keys only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RIGHT = "_right_side"

def without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def inner(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key)


def left_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every row of ``left``, with its matches or with NULLs.

    The columns of both sides may share names, as in a plain left join.
    """
    others = [name for name in right.columns if name != key]
    packed = right.select(key, F.struct(*others).alias(_RIGHT)) if others else right.select(key)
    matched = left.join(packed, key)
    rest = without_match(left, right, key)
    if not others:
        return matched.unionByName(rest)
    missing = F.lit(None).cast(packed.schema[_RIGHT].dataType)
    both = matched.unionByName(rest.withColumn(_RIGHT, missing))
    return both.select(*(F.col(name) for name in matched.columns[:-1]), f"{_RIGHT}.*")


def right_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every row of ``right``, with its matches or with NULLs."""
    size = len(right.columns)
    joined = left_outer(right, left, key)
    names = joined.columns
    # By place: names may repeat.
    plain = joined.toDF(*(f"c{at}" for at in range(len(names))))
    order = [0, *range(size, len(names)), *range(1, size)]
    return plain.select(*(F.col(f"c{at}").alias(names[at]) for at in order))


def match_classes(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many rows a full outer join has, by the sides that are present.

    Both sides are counted by key before they meet, so no pair is built.
    """
    lefts = left.groupBy(key).agg(F.count("*").alias("lefts"))
    rights = right.groupBy(key).agg(F.count("*").alias("rights"))
    paired = lefts.join(rights, key, "full")
    counts = paired.agg(
        F.sum(F.col("lefts") * F.col("rights")).alias("both"),
        F.sum(F.when(F.col("rights").isNull(), F.col("lefts"))).alias("only_left"),
        F.sum(F.when(F.col("lefts").isNull(), F.col("rights"))).alias("only_right"),
    )
    return counts.na.fill(0).unpivot(
        [], ["both", "only_left", "only_right"], "presence", "rows"
    )


def with_description(orders: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Add the meaning of each status; 'Unknown' where there is none."""
    return (
        orders.join(descriptions, "status", "left")
        .withColumn("status_desc", F.coalesce("status_desc", F.lit("Unknown")))
    )


def orders_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customerNumber")


def orders_full(
    details: DataFrame | None,
    products: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Order lines with product, order and customer; orders alone without lines.

    Orders meet customers on their own, as they are far fewer than the order lines.
    The lines meet their order last, so that a result by order needs no more shuffle.
    """
    headed = orders_customers(orders, customers)
    if details is None:
        return headed
    return details.join(products, "productCode").join(headed, "orderNumber")
