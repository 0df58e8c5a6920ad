"""The standard reports on a shop's tables and on a web server's logs.

Each function gives named DataFrames at the operators' default parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators import aggregates, quality, weblogs
from tallyworks.sources import columnar, delimited, lines

Reports = dict[str, DataFrame]


def retail_reports(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    details: DataFrame | None = None,
) -> Reports:
    """Profiles, distributions, statistics and business questions.

    Each report reads its table anew and only the columns it needs, so large tables
    are best given as Parquet, or kept for the while by ``caching.persisted``.
    """
    tables = {"customers": customers, "products": products, "orders": orders}
    keys = {
        "customers": (customers, "customerNumber"),
        "orders": (orders, "orderNumber"),
    }
    reports = {
        "schemas": quality.schema_profile(tables),
        "customer_nulls": quality.null_profile(customers),
        "order_nulls": quality.null_profile(orders),
        "duplicates": quality.duplicate_report(keys),
        "customers_by_segment": aggregates.ranked_counts(customers, "customerSegment"),
        "top_countries": aggregates.top_counts(customers, "country"),
        "orders_by_status": aggregates.ranked_counts(orders, "status"),
        "orders_by_payment": aggregates.ranked_counts(orders, "paymentMethod"),
        "products_by_category": aggregates.ranked_counts(products, "productCategory"),
        "order_amounts": aggregates.order_amount_stats(orders),
        "credit_by_segment": aggregates.credit_by_segment(customers),
        "product_prices": aggregates.product_price_stats(products),
        "summary": aggregates.business_summary(customers, products, orders),
        "q1_top_country_credit": aggregates.top_country_credit(customers),
        "q2_most_common_status": aggregates.most_common(orders, "status"),
        "q3_category_most_stock": aggregates.category_most_stock(products),
        "q4_enterprise_percentage": aggregates.segment_share(customers),
        "q5_orders_by_month": aggregates.orders_by_month(orders),
    }
    if details is not None:
        reports["line_summary"] = aggregates.order_line_summary(
            details, products, orders, customers
        )
        reports["revenue_by_product"] = aggregates.revenue_by_product(
            details, products, orders, customers
        )
    return reports


def process_logs(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Parse a text log once and keep the requests as Parquet, by day.

    Reports then read the few columns they need, instead of parsing text again.
    """
    requests = weblogs.with_times(weblogs.parse_lines(lines.read_lines(spark, source)))
    by_day = requests.withColumn("day", F.col("parsed_timestamp").cast("date"))
    columnar.write_parquet(by_day, target, partition_by=("day",))
    return columnar.read_parquet(spark, target)


def log_reports(requests: DataFrame) -> Reports:
    """Traffic, behaviour, suspicious visitors and slow pages of processed logs."""
    return {
        "status_distribution": weblogs.status_distribution(requests),
        "method_distribution": weblogs.method_distribution(requests),
        "top_endpoints": weblogs.top_endpoints(requests),
        "response_times": weblogs.response_time_stats(requests),
        "traffic_by_hour": weblogs.traffic_by_hour(requests),
        "top_ips": weblogs.top_ips(requests),
        "bounce_rate": weblogs.bounce_rate(requests),
        "conversion_funnel": weblogs.conversion_funnel(requests),
        "peak_hour": weblogs.peak_hour(requests),
        "suspicious_rate": weblogs.busy_windows(requests),
        "high_404": weblogs.high_404(requests),
        "slow_endpoints": weblogs.slow_endpoints(requests),
        "slow_endpoint_status": weblogs.slow_endpoint_status(requests),
    }


def write_reports(reports: Reports, folder: str) -> None:
    """Write each report as CSV with a header, in a folder of its own."""
    for name, report in reports.items():
        delimited.write_report(report, f"{folder}/{name}")
