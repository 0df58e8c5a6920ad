"""Data-quality profiles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.filters import sample_rows


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count of each column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "nulls")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; NULL counts as one key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
    )
    return totals.withColumn(
        "duplicates", F.col("total_rows") - F.col("distinct_keys")
    )


def duplicate_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    return _union(
        duplicate_keys(df, key).select(
            F.lit(name).alias("table_name"), F.lit(key).alias("key_name"), "*"
        )
        for name, (df, key) in tables.items()
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.count("*").alias("total_rows")).select(
            F.lit(name).alias("table_name"), "total_rows"
        )
        for name, df in tables.items()
    )


def schema_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, type and position of every column, with its table's row count."""

    def columns(name: str, df: DataFrame) -> DataFrame:
        described = F.array(
            *[
                F.struct(
                    F.lit(place).alias("position"),
                    F.lit(column).alias("column_name"),
                    F.lit(kind).alias("column_type"),
                )
                for place, (column, kind) in enumerate(df.dtypes, start=1)
            ]
        )
        counted = df.agg(F.count("*").alias("total_rows"))
        return counted.select(
            F.lit(name).alias("table_name"), "total_rows", F.inline(described)
        )

    return _union(columns(name, df) for name, df in tables.items())


def sample_facts(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """What holds for a sample without replacement, whichever rows it drew.

    ``n``: rows of ``df``; ``contained``: no key is in the sample more often than in ``df``;
    ``fair``: the sample's size is within five standard deviations of what is expected.
    """
    given = df.select(key, F.lit(1).alias("given"), F.lit(0).alias("drawn"))
    drawn = sample_rows(df.select(key), fraction).select(
        key, F.lit(0).alias("given"), F.lit(1).alias("drawn")
    )
    per_key = given.unionByName(drawn).groupBy(key).agg(
        F.sum("given").alias("given"), F.sum("drawn").alias("drawn")
    )
    n = F.coalesce(F.sum("given"), F.lit(0))
    off = F.abs(F.coalesce(F.sum("drawn"), F.lit(0)) - n * fraction)
    return per_key.agg(
        n.alias("n"),
        F.coalesce(F.bool_and(F.col("drawn") <= F.col("given")), F.lit(True)).alias("contained"),
        (off <= 5 * F.sqrt(n * fraction * (1 - fraction))).alias("fair"),
    )


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other: ``extra_left``, ``extra_right``.

    Both are counted with signs in one pass and one shuffle; every task first sums its own, so a
    row that is repeated much is no hot key. NULL equals NULL, and columns go by their names.
    """
    columns = left.columns
    signed = left.withColumn("_sign", F.lit(1)).unionByName(right.withColumn("_sign", F.lit(-1)))
    counted = signed.groupBy(*columns).agg(F.sum("_sign").alias("_more")).where("_more <> 0")
    return counted.select(
        *columns,
        F.greatest("_more", F.lit(0)).cast("bigint").alias("extra_left"),
        F.greatest(-F.col("_more"), F.lit(0)).cast("bigint").alias("extra_right"),
    )
