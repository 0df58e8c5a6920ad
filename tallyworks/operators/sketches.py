"""Mergeable sketches: distinct counts and quantiles from stored states.

A state is a column of a few kilobytes, built on the map side too, so a hot key reaches the shuffle
as one state for each task. States of fine groups are merged to coarser ones without a second look
at the rows. Results are estimates; the bounds say how far they may be off.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = "state"
LG_BUCKETS = 12
QUANTILE_SIZE = 800


def distinct_states(
    df: DataFrame, keys: Sequence[str | Column], value: str, *, lg_buckets: int = LG_BUCKETS
) -> DataFrame:
    """One state of the distinct values for each group; NULL values do not count."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_buckets).alias(STATE))


def distinct_counts(states: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Estimated number of distinct values by coarser groups of the states (``estimate``)."""
    merged = states.groupBy(*keys).agg(F.hll_union_agg(STATE).alias(STATE))
    return merged.withColumn("estimate", F.hll_sketch_estimate(STATE)).drop(STATE)


def distinct_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Relative standard error of an estimated distinct count."""
    return 1.04 / math.sqrt(2**lg_buckets)


def quantile_states(
    df: DataFrame, keys: Sequence[str | Column], value: str, *, size: int = QUANTILE_SIZE
) -> DataFrame:
    """One state of the distribution of a number for each group; NULL numbers do not count."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(number, size).alias(STATE))


def quantiles(
    states: DataFrame, keys: Sequence[str | Column], chances: Sequence[float]
) -> DataFrame:
    """Estimated quantiles by coarser groups of the states, one row for each chance.

    ``n``: how many numbers the group has, exactly; ``chance``; ``estimate``: one of the numbers,
    NULL where there are none.
    """
    merged = states.groupBy(*keys).agg(F.kll_merge_agg_double(STATE).alias(STATE))
    counted = merged.withColumn("n", F.kll_sketch_get_n_double(STATE))
    # The function takes literal chances only.
    listed = [
        F.struct(
            F.lit(chance).alias("chance"),
            F.when(
                F.col("n") > 0, F.kll_sketch_get_quantile_double(STATE, F.lit(chance))
            ).alias("estimate"),
        )
        for chance in chances
    ]
    groups = [name for name in counted.columns if name != STATE]
    return counted.select(*groups, F.inline(F.array(*listed)))


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far the rank of an estimated quantile may be off, with 99 % confidence."""
    return 2.296 / size**0.9021
