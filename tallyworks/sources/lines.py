"""Plain text, one row per line."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write a frame of one string column as text."""
    lines.write.mode("overwrite").text(path)


@contextmanager
def minimum_splits(spark: SparkSession, splits: int) -> Iterator[None]:
    """File scans planned inside the block are cut into at least ``splits`` parts.

    Small files are cut too: the padding that Spark normally adds per file is off.
    """
    wanted = {
        "spark.sql.files.minPartitionNum": str(splits),
        "spark.sql.files.openCostInBytes": "1",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
