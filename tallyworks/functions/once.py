"""Costly expressions that several columns and filters read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(column: Column) -> Column:
    """Compute ``column`` once per row, for use in a ``select``.

    Spark copies an expression into every filter and column that reads it. It does not
    copy through a generator, so the value goes through one that makes a single row.
    """
    return F.explode(F.array(column))
