"""Estimates from stored sketches, held against exact results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyworks.operators import sketches
from tallyworks.plans.log_queries import timed
from tallyworks.plans.registry import query
from tallyworks.plans.tables import Tables
from tallyworks.session import keep_table

CHANCES = (0.5, 0.95, 0.99)


@query(
    "weekly_visitors",
    """SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type,
              COUNT(DISTINCT user_id) AS visitors, TRUE AS within_bounds
       FROM events GROUP BY 1, 2""",
)
def _(t: Tables):
    """Visitors by week from daily states; four standard errors count as within bounds."""
    events = t.raw("events").select("ts", "user_id", "event_type")
    day, week = F.col("ts").cast("date").alias("day"), F.trunc("day", "week").alias("week")
    daily = keep_table(sketches.distinct_states(events, [day, "event_type"], "user_id"))
    estimated = sketches.distinct_counts(daily, [week, "event_type"])
    exact = (
        events.select(F.trunc("ts", "week").alias("week"), "event_type", "user_id")
        .groupBy("week", "event_type")
        .agg(F.count_distinct("user_id").alias("visitors"))
    )
    off = F.abs(F.col("estimate") - F.col("visitors"))
    within = off <= 4 * sketches.distinct_error() * F.col("visitors") + 1
    both = exact.join(estimated, ["week", "event_type"])
    return both.select("week", "event_type", "visitors", within.alias("within_bounds"))


@query(
    "response_quantiles",
    """SELECT endpoint, chance, COUNT(response_time_ms) AS n, TRUE AS within_bounds
       FROM timed, (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.95 AS DOUBLE)),
                           (CAST(0.99 AS DOUBLE))) AS c(chance)
       WHERE response_time_ms IS NOT NULL AND endpoint IS NOT NULL GROUP BY 1, 2""",
    uses="lines parsed logs timed",
)
def _(t: Tables):
    """p50, p95 and p99 of response times by endpoint, merged from hourly states.

    Within bounds is an estimate whose exact ranks come near the chance.
    """
    logs = timed(t).where("response_time_ms IS NOT NULL AND endpoint IS NOT NULL")
    logs = logs.select("endpoint", "hour", "response_time_ms")
    hourly = keep_table(sketches.quantile_states(logs, ["endpoint", "hour"], "response_time_ms"))
    found = sketches.quantiles(hourly, ["endpoint"], CHANCES)
    time, slack = F.col("response_time_ms"), 2 * sketches.rank_error()
    ranked = logs.join(found, "endpoint").groupBy("endpoint", "chance", "n").agg(
        F.count_if(time < F.col("estimate")).alias("below"),
        F.count_if(time <= F.col("estimate")).alias("up_to"),
    )
    low, high = (F.col("chance") - slack) * F.col("n"), (F.col("chance") + slack) * F.col("n")
    within = (F.col("below") <= high) & (F.col("up_to") >= low)
    return ranked.select("endpoint", "chance", "n", within.alias("within_bounds"))
