"""Finding hot keys, and sums that do not suffer from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.buckets import row_salt
from tallyworks.operators.aggregates import count_by


def hot_keys(df: DataFrame, key: str, share: float = 0.1) -> DataFrame:
    """Keys with at least ``share`` of all rows; at most ``1 / share`` of them."""
    counts = count_by(df, key)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).where(F.col("share") >= share)


def salt_keys(
    df: DataFrame, key: str, hot: tuple[str, ...], salts: int, salt: Column
) -> DataFrame:
    """Add a salt column: 0 up to ``salts - 1`` for hot keys, NULL for the others.

    The salt stays a column of its own, so no key text can be mistaken for one.
    """
    number = F.pmod(salt, F.lit(salts)).cast("int")
    return df.withColumn("salt", F.when(F.col(key).isin(*hot), number))


def salted_key_counts(salted: DataFrame, key: str) -> DataFrame:
    """Rows per salted key, the salt shown as part of the key."""
    counts = salted.groupBy(key, "salt").agg(F.count("*").alias("n"))
    shown = F.concat_ws("_salt_", key, F.col("salt").cast("string"))
    return counts.select(shown.alias("salted_key"), "n")


def salted_sum(
    df: DataFrame, key: str, value: Column, row_id: tuple[str, ...], salts: int = 10
) -> DataFrame:
    """Sum per key in two steps, by key and salt and then by key."""
    partial = (
        df.withColumn("salt", row_salt(salts, *row_id))
        .groupBy(key, "salt")
        .agg(F.sum(value).alias("total"))
    )
    return partial.groupBy(key).agg(F.sum("total").alias("total"))


def key_sum(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Sum per key. Spark adds up before the shuffle, so a hot key costs little."""
    return df.groupBy(key).agg(F.sum(value).alias("total"))
