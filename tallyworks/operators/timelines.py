"""Joins and sums along time: as-of and interval joins, sessions, ordered funnels, running totals.

None of them sorts all rows of one key in a single task. Time is cut into buckets; a bucket of a key
is worked on by itself, and what it has to know of those before it is carried over in a
table that has one row for each key and bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyworks.session import keep_table


def _micros(time: Column | str) -> Column:
    """A time in microseconds; one without zone is read in the session's, which is UTC."""
    time = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(time.cast("timestamp"))


def _bucket(time: Column, seconds: int) -> Column:
    return F.floor(_micros(time) / F.lit(seconds * 1_000_000)).cast("bigint")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    order: str,
    *,
    values: Mapping[str, str],
    inclusive: bool = False,
    bucket_seconds: int = 86_400,
) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` of its key before its time.

    ``values`` maps columns of ``right`` to the names under which they are added. With
    ``inclusive``, a row at the same time counts too. Of rows at one time the one that is last by
    ``order`` is taken. All rows of ``left`` stay; a NULL key or time meets nothing.

    Both sides go through one sorted pass over (key, bucket). The last row of ``right`` in earlier
    buckets is put in front of a bucket as one more row, so buckets need not see each other.
    """
    at = F.struct(
        F.col(time).alias("_at"),
        F.col(order).alias("_order"),
        *(F.col(name).alias(f"_{new}") for name, new in values.items()),
    )
    known = right.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    given = known.select(
        F.col(key).alias("_key"), _bucket(F.col(time), bucket_seconds).alias("_bucket"), at.alias("_match")
    )
    row = F.struct(*left.columns)
    # Rows that can meet nothing are spread by their order column.
    apart = F.col(key).isNull() | F.col(time).isNull()
    asking = left.select(
        F.when(~apart, F.col(key)).alias("_key"),
        F.when(apart, F.xxhash64(order)).otherwise(_bucket(F.col(time), bucket_seconds)).alias("_bucket"),
        F.col(time).alias("_time"),
        row.alias("_row"),
    )

    lasts = given.groupBy("_key", "_bucket").agg(F.max("_match").alias("_match"))
    asked = asking.where(F.col("_key").isNotNull()).select("_key", "_bucket").distinct()
    lasts = lasts.join(asked, ["_key", "_bucket"], "full_outer")
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = lasts.select(
        "_key", "_bucket", F.last("_match", ignorenulls=True).over(earlier).alias("_match")
    ).where(F.col("_match").isNotNull())

    offers = given.unionByName(carried).withColumn("_time", F.col("_match._at"))
    both = offers.unionByName(asking, allowMissingColumns=True)
    # At one time, what may be met comes first; what may not, last.
    side = F.col("_row").isNull() if inclusive else F.col("_row").isNotNull()
    order_ = Window.partitionBy("_key", "_bucket").orderBy(
        "_time", F.desc(side), F.col("_match._order")
    )
    met = F.last("_match", ignorenulls=True).over(
        order_.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.select("_row", met.alias("_met")).where(F.col("_row").isNotNull())
    return found.select("_row.*", *(F.col(f"_met._{new}").alias(new) for new in values.values()))


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    time: str,
    start: str,
    stop: str,
    *,
    keys: Sequence[str] = (),
    base_seconds: int = 60,
) -> DataFrame:
    """Each point with each interval, from ``start`` to before ``stop``, that it lies in.

    ``keys`` must be equal too. An interval belongs to the level whose bins are as long as itself
    at least, powers of two of ``base_seconds``, so it lies in two bins at most; a point is in one bin
    of every level that occurs. A pair thus meets once, in an equi-join that splits where a
    bin is hot, and the exact bounds are checked after that. Intervals without bounds or length,
    and points without time, meet nothing.
    """
    base = base_seconds * 1_000_000
    begin, end = _micros(start), _micros(stop)
    level = F.greatest(F.lit(0), F.ceil(F.log2((end - begin) / F.lit(base)))).cast("int")
    width = F.expr(f"{base} * shiftleft(1L, _level)")

    def bin_of(micros: Column) -> Column:
        return F.floor(micros / width).cast("bigint")

    levelled = intervals.where(F.col(start) < F.col(stop)).withColumn("_level", level)
    first, last = bin_of(begin), bin_of(end - 1)
    binned = levelled.withColumn("_bin", F.explode(F.array_distinct(F.array(first, last))))
    # A level is the logarithm of a length: a few dozen numbers at most.
    levels = [row[0] for row in levelled.select("_level").distinct().collect()]
    placed = points.where(F.col(time).isNotNull()).withColumn(
        "_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))
    )
    placed = placed.withColumn("_bin", bin_of(_micros(time)))
    met = placed.join(binned, [*keys, "_level", "_bin"])
    inside = (F.col(time) >= F.col(start)) & (F.col(time) < F.col(stop))
    return met.where(inside).drop("_level", "_bin")


def sessions(
    events: DataFrame, key: str, time: str, *, gap_seconds: int, bucket_seconds: int = 86_400
) -> DataFrame:
    """Runs of a key's events with no gap over ``gap_seconds``: start, end and number of events.

    In each (key, bucket) events are cut into runs, the first of which may go on from an earlier
    bucket; only runs are joined over the buckets' edges. Events without key or time are
    left out; events at one time are all counted.
    """
    known = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        key, F.col(time).alias("_time"), _bucket(F.col(time), bucket_seconds).alias("_bucket")
    )
    ends = known.groupBy(key, "_bucket").agg(F.max("_time").alias("_time"))
    of_key = Window.partitionBy(key).orderBy("_bucket")
    carried = ends.select(
        key, F.lag("_time").over(of_key).alias("_time"), "_bucket", F.lit(True).alias("_carried")
    ).where(F.col("_time").isNotNull())
    both = known.withColumn("_carried", F.lit(False)).unionByName(carried)
    in_bucket = Window.partitionBy(key, "_bucket").orderBy("_time", F.desc("_carried"))
    gap = _micros("_time") - _micros(F.lag("_time").over(in_bucket))
    opens = F.col("_gap").isNull() | (F.col("_gap") > gap_seconds * 1_000_000)
    so_far = in_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The carried row is the first of its bucket and opens nothing: what follows goes on from it.
    flagged = both.withColumn("_gap", gap).withColumn(
        "_opened", F.when(opens & ~F.col("_carried"), F.col("_time"))
    )
    runs = (
        flagged.withColumn("_start", F.last("_opened", ignorenulls=True).over(so_far))
        .where(~F.col("_carried"))
        .groupBy(key, "_bucket", "_start")
        .agg(F.max("_time").alias("_end"), F.count("*").alias("_events"))
    )
    runs = keep_table(runs)
    # One row for a bucket: the last start in it, and before it.
    starts = runs.groupBy(key, "_bucket").agg(F.max("_start").alias("_latest"))
    before = of_key.rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_before", F.last("_latest", ignorenulls=True).over(before))
    whole = runs.join(starts, [key, "_bucket"]).withColumn(
        "session_start", F.coalesce("_start", "_before")
    )
    return whole.groupBy(key, "session_start").agg(
        F.max("_end").alias("session_end"), F.sum("_events").alias("events")
    )


def ordered_funnel(
    events: DataFrame, key: str, order: Sequence[str], steps: Mapping[str, Column]
) -> DataFrame:
    """Different keys that reached each step after the step before it.

    A key's state is where it first could have reached a step, by the columns of ``order``. The
    earliest place of the next step after that is a minimum, which every task takes of its own rows
    first, so the events of a key never have to meet. Events without key or place are left out.
    """
    place = F.struct(*order)
    known = events.where(F.col(key).isNotNull())
    for name in order:
        known = known.where(F.col(name).isNotNull())
    counts, reached = None, None
    for number, (name, matches) in enumerate(steps.items()):
        rows = known.where(matches).select(key, place.alias("_place"))
        if reached is not None:
            rows = rows.join(reached, key).where(F.col("_place") > F.col("_reached"))
        reached = keep_table(rows.groupBy(key).agg(F.min("_place").alias("_reached")))
        count = reached.agg(F.count("*").alias("visitors")).select(
            F.lit(number + 1).alias("position"), F.lit(name).alias("step"), "visitors"
        )
        counts = count if counts is None else counts.unionByName(count)
    return counts


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], count: int
) -> DataFrame:
    """The first ``count`` rows of each group with their ``rank``; ``order`` should leave no ties.

    Every task ranks its own rows and drops all but ``count`` of each group before the shuffle,
    so the task that ranks a hot group gets no more than that from each.
    """
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= count)


def running_totals(
    df: DataFrame, order: Sequence[str], units: Column, *, frame: int | None = None
) -> DataFrame:
    """``df`` with ``running``: the sum of whole ``units`` of all rows up to each, in order.

    ``frame`` sums a row and the ``frame - 1`` before it only. Rows are dealt by ranges of ``order``
    and kept with their places; each range is summed by itself, and what the ranges before it come
    to, one row for each, is added. ``order`` must tell all rows apart. NULL units count as 0.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = keep_table(
        ranged.withColumn("_units", F.coalesce(units.cast("bigint"), F.lit(0))).withColumn(
            "_place", F.monotonically_increasing_id()
        )
    ).withColumn("_part", F.shiftright("_place", 33))
    parts = kept.groupBy("_part").agg(
        F.sum("_units").alias("_sum"), F.count("*").alias("_rows")
    )
    # One row for each range: this window has as many rows as the shuffle had partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
    )
    so_far = Window.partitionBy("_part").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = kept.join(F.broadcast(bases), "_part").withColumn(
        "running", F.sum("_units").over(so_far) + F.col("_base")
    )
    if frame is not None:
        # The total before the frame is that of the row ``frame`` places earlier.
        numbered = summed.withColumn(
            "_number", F.col("_rows_before") + F.row_number().over(
                Window.partitionBy("_part").orderBy("_place")
            )
        )
        numbered = keep_table(numbered)
        back = numbered.select((F.col("_number") + frame).alias("_number"), F.col("running").alias("_back"))
        summed = numbered.join(back, "_number", "left").withColumn(
            "running", F.col("running") - F.coalesce("_back", F.lit(0))
        )
    return summed.select(*df.columns, "running")
