"""Web-server log analytics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.once import once
from tallyworks.operators.aggregates import ranked_counts
from tallyworks.operators.filters import endpoint_matches

# The layout of a log line and of its time stamp.
LOG_PATTERN = r'(\S+) - - \[([\w:/]+\s*)\] "(\S+) (\S+) (\S+)" (\d{3}) (\d+) ".*"'
LOG_FIELDS = (
    "ip",
    "timestamp",
    "method",
    "endpoint",
    "protocol",
    "status",
    "response_time_ms",
)
NUMBER_FIELDS = ("status", "response_time_ms")
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"

# How each step of the conversion funnel is recognised.
FUNNEL = {
    "Home": ("exact", "/home"),
    "Products": ("exact", "/products"),
    "Product Detail": ("prefix", "/product/"),
    "Cart": ("exact", "/cart"),
    "Checkout": ("exact", "/checkout"),
}
FUNNEL_CONTAINS = {
    name.capitalize(): ("contains", name)
    for name in ("home", "products", "product", "cart", "checkout")
}


def _typed_fields(fields: Column) -> list[Column]:
    """Columns from an array of texts; absent texts are '' and absent numbers NULL."""
    columns = []
    for place, name in enumerate(LOG_FIELDS, start=1):
        text = F.get(fields, F.lit(place))
        if name in NUMBER_FIELDS:
            columns.append(text.try_cast("int").alias(name))
        else:
            columns.append(F.coalesce(text, F.lit("")).alias(name))
    return columns


def parse_lines(
    lines: DataFrame, pattern: str = LOG_PATTERN, *, keep_invalid: bool = False
) -> DataFrame:
    """Log lines (column ``value``) as typed fields.

    The pattern has one group per field and may match anywhere in a line. It runs once per line, not once per
    field: the match is rewritten as its groups with line breaks between, which no line
    can contain, and split. Lines without a match are dropped, or kept with empty fields.
    """
    groups = "".join(f"\n${number}" for number in range(1, len(LOG_FIELDS) + 1))
    # The text around the match may hold any character, so there "." takes them all.
    around = rf"(?s:^.*?){pattern}(?s:.*$)"
    rewritten = F.regexp_replace("value", around, groups)
    split = lines.select(once(F.split(rewritten, "\n")).alias("fields"))
    matched = F.size("fields") == len(LOG_FIELDS) + 1
    if keep_invalid:
        split = split.select(F.when(matched, F.col("fields")).alias("fields"))
    else:
        split = split.where(matched)
    return split.select(*_typed_fields(F.col("fields")))


def line_quality(lines: DataFrame, pattern: str = LOG_PATTERN) -> DataFrame:
    """Lines in all, lines that match, and lines that do not."""
    return lines.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("value").rlike(pattern)).alias("valid"),
    ).withColumn("invalid", F.col("total") - F.col("valid"))


def with_times(logs: DataFrame, time_format: str = TIME_FORMAT) -> DataFrame:
    """Add the parsed time and its hour; requests without a readable time go."""
    parsed = F.try_to_timestamp(F.trim("timestamp"), F.lit(time_format))
    return (
        logs.select("*", once(parsed.cast("timestamp_ntz")).alias("parsed_timestamp"))
        .where(F.col("parsed_timestamp").isNotNull())
        .withColumn("hour", F.hour("parsed_timestamp"))
    )


def status_distribution(logs: DataFrame) -> DataFrame:
    return ranked_counts(logs, "status")


def method_distribution(logs: DataFrame) -> DataFrame:
    return ranked_counts(logs, "method")


def top_endpoints(logs: DataFrame) -> DataFrame:
    return ranked_counts(logs, "endpoint")


def top_ips(logs: DataFrame, count: int = 10) -> DataFrame:
    return ranked_counts(logs, "ip").limit(count)


def response_time_stats(logs: DataFrame) -> DataFrame:
    time = F.col("response_time_ms")
    return logs.agg(
        F.count(time).alias("n"),
        F.min(time).alias("fastest"),
        F.max(time).alias("slowest"),
        F.round(F.avg(time), 4).alias("average"),
    )


def traffic_by_hour(logs: DataFrame) -> DataFrame:
    return logs.groupBy("hour").agg(F.count("*").alias("n")).orderBy("hour")


def peak_hour(logs: DataFrame) -> DataFrame:
    """The hour with the most requests; the earliest of equals."""
    return ranked_counts(logs, "hour").limit(1)


def log_summary(lines: DataFrame, pattern: str = LOG_PATTERN) -> DataFrame:
    """Lines, valid lines and different pages.

    Lines are counted by page before the pages are, which needs one shuffle of
    small counts.
    """
    logs = parse_lines(lines, pattern, keep_invalid=True)
    pages = logs.groupBy("endpoint").agg(F.count("*").alias("n"))
    valid = F.col("endpoint") != ""
    return pages.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_requests"),
        F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).alias("valid_requests"),
        F.count_if(valid).alias("unique_pages"),
    )


def bounce_rate(logs: DataFrame, *visitor: str) -> DataFrame:
    """Percentage of visitors with a single request; NULL without visitors."""
    visits = logs.groupBy(*(visitor or ("ip",))).agg(F.count("*").alias("requests"))
    totals = visits.agg(
        F.count("*").alias("visitors"),
        F.count_if(F.col("requests") == 1).alias("bounced"),
    )
    rate = F.try_divide(F.col("bounced") * 100, F.col("visitors"))
    return totals.withColumn("bounce_rate", F.round(rate, 4))


def conversion_funnel(
    logs: DataFrame, steps: Mapping[str, tuple[str, str]] = FUNNEL
) -> DataFrame:
    """Different visitors per step; steps do not have to follow each other.

    Each visitor is first reduced to one row of step marks, so all steps together
    take one shuffle.
    """
    endpoint = F.col("endpoint")
    marks = [
        F.bool_or(endpoint_matches(endpoint, mode, text)).alias(name)
        for name, (mode, text) in steps.items()
    ]
    visitors = logs.groupBy("ip").agg(*marks)
    counts = visitors.agg(*[F.count_if(F.col(f"`{name}`")).alias(name) for name in steps])
    return counts.unpivot([], [f"`{name}`" for name in steps], "step", "visitors")


def busy_windows(
    logs: DataFrame, window: str = "1 minute", above: int = 50
) -> DataFrame:
    """Visitors with more than ``above`` requests in a tumbling time window."""
    return (
        logs.groupBy("ip", F.window("parsed_timestamp", window).alias("w"))
        .agg(F.count("*").alias("requests"))
        .where(F.col("requests") > above)
        .select(
            "ip",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "requests",
        )
    )


def busy_hours(logs: DataFrame, above: int = 50) -> DataFrame:
    """Number of visitors with more than ``above`` requests in one hour of the day."""
    hours = logs.groupBy("ip", "hour").agg(F.count("*").alias("requests"))
    return hours.where(F.col("requests") > above).agg(
        F.count_distinct("ip").alias("visitors")
    )


def high_404(
    logs: DataFrame, above: float = 0.5, visitor: Sequence[str] = ("ip",)
) -> DataFrame:
    """Visitors for whom more than the given part of the requests ended in 404."""
    missing = F.count_if(F.col("status") == 404)
    return (
        logs.groupBy(*visitor)
        .agg(
            (missing / F.count("*")).alias("ratio_404"),
            F.count("*").alias("total_requests"),
        )
        .where(F.col("ratio_404") > above)
    )


def slow_endpoints(
    logs: DataFrame, slower_than: float = 2000, more_than: int = 10
) -> DataFrame:
    return (
        logs.groupBy("endpoint")
        .agg(
            F.avg("response_time_ms").alias("average"),
            F.count("*").alias("request_count"),
        )
        .where((F.col("average") > slower_than) & (F.col("request_count") > more_than))
        .select(
            "endpoint",
            F.round("average", 4).alias("avg_response_time"),
            "request_count",
        )
        .orderBy(F.desc("avg_response_time"), "endpoint")
    )


def slow_endpoint_status(logs: DataFrame, slower_than: float = 2000) -> DataFrame:
    return (
        logs.groupBy("endpoint", "status")
        .agg(F.avg("response_time_ms").alias("average"))
        .where(F.col("average") > slower_than)
        .select("endpoint", "status", F.round("average", 4).alias("avg_response_time"))
        .orderBy(F.desc("avg_response_time"), "endpoint", "status")
    )
