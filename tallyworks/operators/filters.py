"""Row filters over orders, customers and log requests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_value(orders: DataFrame, above: float = 5000) -> DataFrame:
    return orders.where(F.col("totalAmount") > above)


def status_above(
    orders: DataFrame, statuses: Sequence[str], above: float
) -> DataFrame:
    """Orders in one of the statuses whose amount is above the limit."""
    return orders.where(F.col("status").isin(*statuses) & (F.col("totalAmount") > above))


def fourth_quarter(orders: DataFrame, year: int = 2024) -> DataFrame:
    """As a half-open date range, which the scan can prune by."""
    date = F.col("orderDate")
    return orders.where(
        (date >= F.lit(dt.date(year, 10, 1))) & (date < F.lit(dt.date(year + 1, 1, 1)))
    )


def amount_between(
    orders: DataFrame, low: float = 1000, high: float = 5000
) -> DataFrame:
    return orders.where(F.col("totalAmount").between(low, high))


def with_status(orders: DataFrame, *statuses: str) -> DataFrame:
    return orders.where(F.col("status").isin(*statuses))


def early_customers(orders: DataFrame, first: int = 1, last: int = 100) -> DataFrame:
    return orders.where(F.col("customerNumber").between(first, last))


def paid_above(
    orders: DataFrame, method: str = "PayPal", above: float = 2000
) -> DataFrame:
    return orders.where(
        (F.col("paymentMethod") == method) & (F.col("totalAmount") > above)
    )


def in_country(customers: DataFrame, country: str = "USA") -> DataFrame:
    return customers.where(F.col("country") == country)


def high_credit(customers: DataFrame, above: float = 50000) -> DataFrame:
    return customers.where(F.col("creditLimit") > above)


def from_date(orders: DataFrame, first: dt.date = dt.date(2024, 6, 1)) -> DataFrame:
    return orders.where(F.col("orderDate") >= F.lit(first))


def endpoint_matches(endpoint: Column, mode: str, text: str) -> Column:
    """Match an endpoint as a whole, by its beginning, or anywhere in it."""
    if mode == "exact":
        return endpoint == text
    if mode == "prefix":
        return endpoint.startswith(text)
    if mode == "contains":
        return endpoint.contains(text)
    raise ValueError(f"unknown match mode: {mode}")


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Each row is kept with the same chance, and at most once."""
    return df.sample(False, fraction, seed)


def first_rows(df: DataFrame, count: int, *order: str) -> DataFrame:
    """The first rows in a stated order, so that every run gives the same ones."""
    return df.orderBy(*order).limit(count)
