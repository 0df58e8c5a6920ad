"""Classes of orders and customers. A NULL amount falls to the last class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_size(amount: Column, small: float = 1000, medium: float = 5000) -> Column:
    return (
        F.when(amount < small, "Small").when(amount < medium, "Medium").otherwise("Large")
    )


def order_priority(amount: Column, high: float = 5000, medium: float = 2000) -> Column:
    return (
        F.when(amount > high, "High").when(amount > medium, "Medium").otherwise("Low")
    )


def credit_tier(credit: Column, high: float = 75000, medium: float = 25000) -> Column:
    return (
        F.when(credit > high, "High").when(credit >= medium, "Medium").otherwise("Low")
    )
