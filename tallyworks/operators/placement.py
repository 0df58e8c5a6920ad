"""Placing rows in chosen partitions, and looking at what each partition holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.buckets import row_salt
from tallyworks.functions.money import money_sum

_TASK = "_placed_in_task"


@dataclass(frozen=True)
class Placed:
    """Rows shuffled so that each partition has tasks of its own.

    Partition ``p`` owns ``tasks[p]`` consecutive Spark partitions.
    """

    rows: DataFrame
    tasks: tuple[int, ...]

    def partition_id(self) -> Column:
        """The partition a row is in, read from where the row really is.

        Valid as long as ``rows`` has not been shuffled again.
        """
        spark_id = F.spark_partition_id()
        if sum(self.tasks) == len(self.tasks):
            return spark_id
        owners = [number for number, tasks in enumerate(self.tasks) for _ in range(tasks)]
        return F.element_at(F.lit(owners), spark_id + 1)


def even_bounds(df: DataFrame, key: str, partitions: int) -> list[int]:
    """Upper bounds for ``range_bucket`` that share the rows out about evenly."""
    parts = [number / partitions for number in range(1, partitions)]
    bounds = df.agg(F.percentile_approx(key, parts, 10_000)).first()[0]
    return sorted(set(bounds or []))


def place(
    df: DataFrame,
    bucket: Column,
    partitions: int,
    *,
    row_id: Sequence[str] = (),
    tasks: Mapping[int, int] | None = None,
) -> Placed:
    """Shuffle each row to the partition that ``bucket`` names; NULL goes to 0.

    ``tasks`` gives partitions known to be large several tasks; all others have one. The rows
    are not counted for it: one pass places them. A row's task must not change when lost work is
    redone: it follows from the row's place in the scan, which spreads even exact copies. For a
    frame that has been shuffled, name the columns that tell its rows apart instead.
    """
    target = F.pmod(F.coalesce(bucket, F.lit(0)), F.lit(partitions)).cast("int")
    given = tasks or {}
    counts = tuple(max(1, given.get(number, 1)) for number in range(partitions))
    total = sum(counts)
    if total == partitions:
        return Placed(df.repartitionById(partitions, target), counts)
    starts = [end - count for end, count in zip(accumulate(counts), counts)]
    first = F.element_at(F.lit(starts), target + 1)
    spread = F.element_at(F.lit(list(counts)), target + 1)
    if row_id:
        salt = row_salt(spread, *row_id)
    else:
        salt = F.pmod(F.monotonically_increasing_id(), spread).cast("int")
    salted = df.withColumn(_TASK, first + salt)
    return Placed(salted.repartitionById(total, F.col(_TASK)).drop(_TASK), counts)


def partition_rows(placed: Placed) -> DataFrame:
    """Rows in each partition."""
    located = placed.rows.select(placed.partition_id().alias("partition"))
    return located.groupBy("partition").agg(F.count("*").alias("n"))


def partition_totals(placed: Placed, key: Column, value: str) -> DataFrame:
    """Rows, different keys and sum of a value in each partition.

    The sum is taken by partition and key first, which also leaves the keys distinct.
    """
    located = placed.rows.select(
        placed.partition_id().alias("partition"),
        key.alias("key"),
        F.col(value).alias("value"),
    )
    by_key = located.groupBy("partition", "key").agg(
        F.count("*").alias("n"), money_sum("value").alias("total")
    )
    return by_key.groupBy("partition").agg(
        F.sum("n").alias("n"),
        F.count("key").alias("keys"),
        money_sum("total").alias("total"),
    )


def partition_sums(placed: Placed, value: str) -> DataFrame:
    """One sum per partition."""
    located = placed.rows.select(
        placed.partition_id().alias("partition"), F.col(value).alias("value")
    )
    return located.groupBy("partition").agg(F.sum("value").alias("total"))


def partition_contents(
    placed: Placed, position: str, span: int = 100_000
) -> DataFrame:
    """The values of a unique whole-number column in each partition, as lists.

    A list covers ``span`` consecutive positions, so none outgrows a row.
    """
    piece = F.floor(F.col(position) / span)
    located = placed.rows.select(
        placed.partition_id().alias("partition"),
        piece.alias("piece"),
        F.col(position).alias("item"),
    )
    return located.groupBy("partition", "piece").agg(
        F.array_sort(F.collect_list("item")).alias("items")
    )


def partition_top_key(placed: Placed, key: str) -> DataFrame:
    """Rows and most frequent key of each partition; the smaller key of equals."""
    located = placed.rows.select(
        placed.partition_id().alias("partition"), F.col(key).alias("key")
    )
    counts = located.groupBy("partition", "key").agg(F.count("*").alias("n"))
    # The smallest of (-n, key) has the largest n.
    first = F.min(F.struct((-F.col("n")).alias("minus_n"), "key"))
    return counts.groupBy("partition").agg(
        F.sum("n").alias("n"), first.alias("first")
    ).select(
        "partition",
        "n",
        F.col("first.key").alias("top_key"),
        (-F.col("first.minus_n")).alias("top_n"),
    )


def partition_count(df: DataFrame, label: str, value: str) -> DataFrame:
    """Non-empty partitions, rows and sum of a value, in one labelled row."""
    per_partition = df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count("*").alias("n"), money_sum(value).alias("total")
    )
    return per_partition.agg(
        F.count("*").alias("partitions"),
        F.sum("n").alias("n"),
        money_sum("total").alias("total"),
    ).select(F.lit(label).alias("step"), "*")
