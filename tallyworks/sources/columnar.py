"""Parquet in and out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class MissingInput(Exception):
    """The path holds no Parquet data."""


class EmptyInput(Exception):
    """The Parquet data has no rows."""


def read_parquet(spark: SparkSession, path: str, *, allow_empty: bool = False) -> DataFrame:
    """Parquet scan that says plainly when its input is missing or empty."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingInput(path) from error
        raise
    if not allow_empty and df.isEmpty():
        raise EmptyInput(path)
    return df


def write_parquet(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> None:
    """Write Parquet, optionally in one folder per value of some columns.

    Rows of one folder are brought together first, so that a folder gets few files;
    the rebalance hint lets Spark spread a folder that is too large over many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
