"""Queries along time: over the events, and over orders by date."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyworks.operators import timelines
from tallyworks.plans.registry import query
from tallyworks.plans.tables import Tables

STEPS = ("signup", "view", "click", "purchase")


def events(t: Tables):
    return t.raw("events").select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "asof_purchase",
    """SELECT e.event_id, p.event_id AS purchase_id, p.value AS purchase_value
       FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
         ON e.user_id = p.user_id AND e.ts > p.ts""",
)
def _(t: Tables):
    found = timelines.asof_join(
        events(t),
        events(t).where("event_type = 'purchase'"),
        "user_id",
        "ts",
        "event_id",
        values={"event_id": "purchase_id", "value": "purchase_value"},
    )
    return found.select("event_id", "purchase_id", "purchase_value")


@query(
    "interval_after_purchase",
    """SELECT p.event_id AS purchase_id, e.event_id
       FROM (SELECT *, ts + to_microseconds(CAST(floor(value * 3600) AS BIGINT) * 1000000) AS stop
             FROM events WHERE event_type = 'purchase') p
       JOIN events e ON e.user_id = p.user_id AND e.ts >= p.ts AND e.ts < p.stop
       WHERE e.event_type <> 'purchase'""",
)
def _(t: Tables):
    """What a customer does in the hours after a purchase, as many hours as it was worth."""
    stop = F.expr("timestampadd(SECOND, CAST(floor(value * 3600) AS BIGINT), ts)")
    periods = events(t).where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("start"), stop.alias("stop")
    )
    points = events(t).where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    met = timelines.interval_join(points, periods, "ts", "start", "stop", keys=["user_id"])
    return met.select("purchase_id", "event_id")


@query(
    "sessions",
    """SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS session_end,
              COUNT(*) AS events
       FROM (SELECT *, SUM(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number
             FROM (SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                       <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM events))
       GROUP BY user_id, number""",
)
def _(t: Tables):
    return timelines.sessions(events(t), "user_id", "ts", gap_seconds=6 * 3600)


@query(
    "ordered_funnel",
    """WITH s1 AS (SELECT user_id, MIN((ts, event_id)) AS at FROM events
                   WHERE event_type = 'signup' GROUP BY user_id),
            s2 AS (SELECT user_id, MIN((e.ts, e.event_id)) AS at FROM events e JOIN s1 USING (user_id)
                   WHERE event_type = 'view' AND (e.ts, e.event_id) > s1.at GROUP BY user_id),
            s3 AS (SELECT user_id, MIN((e.ts, e.event_id)) AS at FROM events e JOIN s2 USING (user_id)
                   WHERE event_type = 'click' AND (e.ts, e.event_id) > s2.at GROUP BY user_id),
            s4 AS (SELECT DISTINCT user_id FROM events e JOIN s3 USING (user_id)
                   WHERE event_type = 'purchase' AND (e.ts, e.event_id) > s3.at)
       SELECT 1 AS position, 'signup' AS step, COUNT(*) AS visitors FROM s1
       UNION ALL SELECT 2, 'view', COUNT(*) FROM s2
       UNION ALL SELECT 3, 'click', COUNT(*) FROM s3
       UNION ALL SELECT 4, 'purchase', COUNT(*) FROM s4""",
)
def _(t: Tables):
    steps = {step: F.col("event_type") == step for step in STEPS}
    return timelines.ordered_funnel(events(t), "user_id", ["ts", "event_id"], steps)


@query(
    "top_orders_per_customer",
    """SELECT "customerNumber", CAST(rank AS INTEGER) AS rank, "orderNumber", "totalAmount"
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "customerNumber"
                                          ORDER BY "totalAmount" DESC, "orderNumber") AS rank
             FROM ordered)
       WHERE rank <= 3""",
    uses="ordered",
)
def _(t: Tables):
    best = [F.desc("totalAmount"), F.asc("orderNumber")]
    found = timelines.top_per_group(t.orders(), ["customerNumber"], best, 3)
    return found.select("customerNumber", "rank", "orderNumber", "totalAmount")


@query(
    "top_products_per_category",
    """SELECT "productCategory", CAST(rank AS INTEGER) AS rank, "productCode", quantity
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "productCategory"
                                          ORDER BY quantity DESC, "productCode") AS rank
             FROM (SELECT "productCategory", "productCode",
                          CAST(SUM(CAST(quantity AS BIGINT)) AS BIGINT) AS quantity
                   FROM details JOIN products USING ("productCode") GROUP BY ALL))
       WHERE rank <= 5""",
    uses="details products",
)
def _(t: Tables):
    sold = t.details().groupBy("productCode").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("quantity")
    )
    named = sold.join(t.products().select("productCode", "productCategory"), "productCode")
    best = [F.desc("quantity"), F.asc("productCode")]
    found = timelines.top_per_group(named, ["productCategory"], best, 5)
    return found.select("productCategory", "rank", "productCode", "quantity")


_CENTS = 'CAST(round("totalAmount" * 100) AS BIGINT)'


@query(
    "running_revenue",
    f"""SELECT "orderNumber", "orderDate",
               CAST(SUM({_CENTS}) OVER (ORDER BY "orderDate", "orderNumber") AS BIGINT) AS running
        FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    orders = t.orders().select("orderNumber", "orderDate", "totalAmount")
    cents = F.round(F.col("totalAmount") * 100)
    found = timelines.running_totals(orders, ["orderDate", "orderNumber"], cents)
    return found.select("orderNumber", "orderDate", "running")


@query(
    "moving_revenue",
    f"""SELECT "orderNumber", "orderDate",
               CAST(SUM({_CENTS}) OVER (ORDER BY "orderDate", "orderNumber"
                                        ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS BIGINT) AS running
        FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    """Cents of the last hundred orders, at each order."""
    orders = t.orders().select("orderNumber", "orderDate", "totalAmount")
    cents = F.round(F.col("totalAmount") * 100)
    found = timelines.running_totals(orders, ["orderDate", "orderNumber"], cents, frame=100)
    return found.select("orderNumber", "orderDate", "running")
