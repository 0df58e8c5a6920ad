"""Projections and row-wise maps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.classify import credit_tier, order_priority, order_size
from tallyworks.functions.text import padded_code, words
from tallyworks.operators.filters import from_date, with_status


def order_summary(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("orderNumber").alias("id"),
        F.col("orderDate").alias("date"),
        F.col("totalAmount").alias("amount"),
        "status",
    )


def upper_names(
    customers: DataFrame, segment: str = "Enterprise", columns: Sequence[str] = ()
) -> DataFrame:
    """Customers of one segment with their name in capitals added."""
    kept = columns or ("customerName", "phone", "city", "country")
    return (
        customers.where(F.col("customerSegment") == segment)
        .select(*kept)
        .withColumn("customerNameUpper", F.upper("customerName"))
    )


def without_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def with_order_size(
    orders: DataFrame, small: float = 1000, medium: float = 5000
) -> DataFrame:
    return orders.withColumn(
        "orderSize", order_size(F.col("totalAmount"), small, medium)
    )


def shipped_priority(
    orders: DataFrame, high: float = 5000, medium: float = 2000
) -> DataFrame:
    amount = F.col("totalAmount")
    return with_status(orders, "Shipped").select(
        "orderNumber",
        "orderDate",
        F.round(amount, 0).alias("amountRounded"),
        order_priority(amount, high, medium).alias("priority"),
        "status",
    )


def largest_open_orders(
    orders: DataFrame,
    first: dt.date = dt.date(2024, 6, 1),
    large: float = 3000,
    statuses: Sequence[str] = ("Processing", "Shipped"),
    count: int = 10,
) -> DataFrame:
    """The largest orders since a date, with a large-order mark and an order code."""
    return (
        with_status(from_date(orders, first), *statuses)
        .withColumn("isLargeOrder", F.col("totalAmount") > large)
        .withColumn("orderCode", padded_code("ORDER", F.col("orderNumber")))
        .orderBy(F.desc("totalAmount"), "orderNumber")
        .limit(count)
    )


def city_country(customers: DataFrame) -> DataFrame:
    return customers.select("city", "country")


def formatted_ids(customers: DataFrame) -> DataFrame:
    number = F.col("customerNumber")
    return customers.select(
        "customerNumber", padded_code("CUST", number).alias("customerCode")
    )


def customer_tiers(
    customers: DataFrame, high: float = 75000, medium: float = 25000
) -> DataFrame:
    return customers.select(
        "customerNumber",
        "customerName",
        "customerSegment",
        credit_tier(F.col("creditLimit"), high, medium).alias("tier"),
    )


def squared(df: DataFrame, key: str, value: str) -> DataFrame:
    number = F.col(value)
    if df.schema[value].dataType.typeName() in ("byte", "short", "integer"):
        number = number.cast("bigint")
    return df.select(key, value, (number * number).alias("squared"))


def amount_with_tax(orders: DataFrame, factor: float = 1.1) -> DataFrame:
    """Amounts by customer, with tax, and squared."""
    amount = F.col("totalAmount")
    return orders.select(
        "customerNumber",
        (amount * factor).alias("with_tax"),
        (amount * amount).alias("amount_squared"),
    )


def explode_words(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per word of every text."""
    return texts.select(key, F.explode(words(F.col(text))).alias("word"))


def scaled_per_partition(df: DataFrame, column: str, factor: int = 10) -> DataFrame:
    """Multiply a column, with one set-up per partition and not per row.

    The function sent to the executors needs pyarrow there, but not this package.
    """
    place = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = pa.scalar(factor)  # stands for a costly set-up, wanted once per task
        for batch in batches:
            field = batch.schema.field(place)
            scaled = pc.multiply_checked(batch.column(place), times).cast(field.type)
            yield batch.set_column(place, field, scaled)

    return df.mapInArrow(run, df.schema)
