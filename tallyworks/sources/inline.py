"""Frames from literals."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyworks import schemas

# What each order status means.
STATUS_DESCRIPTIONS = (
    ("Shipped", "Order has been shipped to customer"),
    ("Processing", "Order is being processed"),
    ("On Hold", "Order is temporarily on hold"),
    ("Cancelled", "Order was cancelled"),
)


def inline_table(
    spark: SparkSession, rows: Iterable[tuple], schema: StructType
) -> DataFrame:
    """Rows known when the plan is made; by way of Arrow they become part of it."""
    columns = list(zip(*rows)) or [() for _ in schema.names]
    table = pa.table({name: list(column) for name, column in zip(schema.names, columns)})
    return spark.createDataFrame(table, schema)


def status_descriptions(spark: SparkSession) -> DataFrame:
    return inline_table(spark, STATUS_DESCRIPTIONS, schemas.STATUS_DESCRIPTIONS)
