"""Queries over web-server log lines, which are written out from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyworks.operators import weblogs
from tallyworks.operators.filters import endpoint_matches
from tallyworks.plans.registry import query
from tallyworks.plans.tables import Tables

_LINES = "lines parsed"
_LOGS = "lines parsed logs"
_TIMED = "lines parsed logs timed"


def logs(t: Tables):
    return weblogs.parse_lines(t.log_lines())


def timed(t: Tables):
    return weblogs.with_times(logs(t))


def with_day(df):
    return df.withColumn("day", F.col("parsed_timestamp").cast("date"))


@query(
    "log_valid",
    "SELECT ip, method, endpoint, parsed_timestamp FROM timed",
    uses=_TIMED,
)
def _(t: Tables):
    return timed(t).select("ip", "method", "endpoint", "parsed_timestamp")


@query(
    "log_timestamps",
    "SELECT ip, timestamp, parsed_timestamp, hour FROM timed",
    uses=_TIMED,
)
def _(t: Tables):
    return timed(t).select("ip", "timestamp", "parsed_timestamp", "hour")


@query(
    "log_quality",
    """SELECT COUNT(*) AS total, COUNT(*) FILTER (ip <> '') AS valid,
              COUNT(*) FILTER (ip = '') AS invalid FROM parsed""",
    uses=_LINES,
)
def _(t: Tables):
    return weblogs.line_quality(t.log_lines())


@query(
    "status_distribution",
    "SELECT status, COUNT(*) AS n FROM logs GROUP BY status",
    uses=_LOGS,
)
def _(t: Tables):
    return weblogs.status_distribution(logs(t))


@query(
    "method_distribution",
    "SELECT method, COUNT(*) AS n FROM logs GROUP BY method",
    uses=_LOGS,
)
def _(t: Tables):
    return weblogs.method_distribution(logs(t))


@query(
    "top_endpoints",
    "SELECT endpoint, COUNT(*) AS n FROM logs GROUP BY endpoint",
    uses=_LOGS,
)
def _(t: Tables):
    return weblogs.top_endpoints(logs(t))


@query(
    "top_ips",
    "SELECT ip, COUNT(*) AS n FROM logs GROUP BY ip ORDER BY n DESC, ip LIMIT 10",
    uses=_LOGS,
)
def _(t: Tables):
    return weblogs.top_ips(logs(t))


@query(
    "response_time_stats",
    """SELECT COUNT(response_time_ms) AS n, MIN(response_time_ms) AS fastest,
              MAX(response_time_ms) AS slowest, ROUND(AVG(response_time_ms), 4) AS average
       FROM logs""",
    uses=_LOGS,
)
def _(t: Tables):
    return weblogs.response_time_stats(logs(t))


@query(
    "traffic_by_hour",
    "SELECT hour, COUNT(*) AS n FROM timed GROUP BY hour",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.traffic_by_hour(timed(t))


@query(
    "peak_hour",
    "SELECT hour, COUNT(*) AS n FROM timed GROUP BY hour ORDER BY n DESC, hour LIMIT 1",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.peak_hour(timed(t))


@query(
    "log_summary",
    """SELECT COUNT(*) AS total_requests,
              COUNT(*) FILTER (ip <> '') AS valid_requests,
              COUNT(DISTINCT endpoint) FILTER (ip <> '') AS unique_pages
       FROM parsed""",
    uses=_LINES,
)
def _(t: Tables):
    return weblogs.log_summary(t.log_lines())


# A visitor is an address on one day.
@query(
    "bounce_rate",
    """SELECT COUNT(*) AS visitors, COUNT(*) FILTER (n = 1) AS bounced,
              ROUND(COUNT(*) FILTER (n = 1) * 100 / COUNT(*), 4) AS bounce_rate
       FROM (SELECT COUNT(*) AS n FROM timed
             GROUP BY ip, CAST(parsed_timestamp AS DATE))""",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.bounce_rate(with_day(timed(t)), "ip", "day")


def _funnel_sql(steps: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS step, COUNT(DISTINCT ip) AS visitors FROM logs WHERE {test}"
        for name, test in steps.items()
    )


@query(
    "conversion_funnel",
    _funnel_sql(
        {
            "Home": "endpoint = '/home'",
            "Products": "endpoint = '/products'",
            "Product Detail": "starts_with(endpoint, '/product/')",
            "Cart": "endpoint = '/cart'",
            "Checkout": "endpoint = '/checkout'",
        }
    ),
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.conversion_funnel(timed(t))


@query(
    "conversion_funnel_contains",
    _funnel_sql(
        {
            name.capitalize(): f"contains(endpoint, '{name}')"
            for name in ("home", "products", "product", "cart", "checkout")
        }
    ),
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.conversion_funnel(timed(t), weblogs.FUNNEL_CONTAINS)


@query(
    "endpoint_match",
    """SELECT endpoint, endpoint = '/products' AS exact,
              starts_with(endpoint, '/product/') AS prefix,
              contains(endpoint, 'product') AS contains, COUNT(*) AS n
       FROM logs GROUP BY ALL""",
    uses=_LOGS,
)
def _(t: Tables):
    endpoint = F.col("endpoint")
    counts = weblogs.top_endpoints(logs(t))
    return counts.select(
        "endpoint",
        endpoint_matches(endpoint, "exact", "/products").alias("exact"),
        endpoint_matches(endpoint, "prefix", "/product/").alias("prefix"),
        endpoint_matches(endpoint, "contains", "product").alias("contains"),
        "n",
    )


@query(
    "suspicious_rate",
    """SELECT ip, time_bucket(INTERVAL '1 minute', parsed_timestamp) AS window_start,
              time_bucket(INTERVAL '1 minute', parsed_timestamp) + INTERVAL '1 minute'
                AS window_end,
              COUNT(*) AS requests
       FROM timed GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.busy_windows(timed(t), "1 minute", above=1)


@query(
    "suspicious_rate_hourly",
    """SELECT COUNT(DISTINCT ip) AS visitors
       FROM (SELECT ip, hour FROM timed GROUP BY ip, hour HAVING COUNT(*) > 5)""",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.busy_hours(timed(t), above=5)


@query(
    "high_404_ips",
    """SELECT ip, COUNT(*) FILTER (status = 404) / COUNT(*) AS ratio_404,
              COUNT(*) AS total_requests
       FROM timed GROUP BY ip HAVING ratio_404 > 0.2""",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.high_404(timed(t), above=0.2)


@query(
    "high_404_ip_days",
    """SELECT ip, CAST(parsed_timestamp AS DATE) AS day,
              COUNT(*) FILTER (status = 404) / COUNT(*) AS ratio_404,
              COUNT(*) AS total_requests
       FROM timed GROUP BY 1, 2 HAVING ratio_404 > 0.5""",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.high_404(with_day(timed(t)), 0.5, ("ip", "day"))


# The given response times average about 2,500 ms for every page.
@query(
    "slow_endpoints",
    """SELECT endpoint, ROUND(AVG(response_time_ms), 4) AS avg_response_time,
              COUNT(*) AS request_count
       FROM logs GROUP BY endpoint
       HAVING AVG(response_time_ms) > 2000 AND COUNT(*) > 10""",
    uses=_LOGS,
)
def _(t: Tables):
    return weblogs.slow_endpoints(logs(t))


@query(
    "slow_endpoint_status",
    """SELECT endpoint, status, ROUND(AVG(response_time_ms), 4) AS avg_response_time
       FROM timed GROUP BY endpoint, status HAVING AVG(response_time_ms) > 2000""",
    uses=_TIMED,
)
def _(t: Tables):
    return weblogs.slow_endpoint_status(timed(t))
