"""The plans of registered queries: what is pushed, pruned, combined and shuffled."""

import re

import pytest

from tallyworks.plans.catalog import QUERIES
from tests.conftest import DATA_DIR, plan


def plan_of(spark, name):
    return plan(QUERIES[name].run(spark, DATA_DIR))


def read_columns(text):
    """Columns read of each table, in the order of the plan."""
    return [
        sorted(re.findall(r"(\w+):", schema))
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)
    ]


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("filter_high_value", "GreaterThan(o_totalprice,250000.0)"),
        ("filter_amount_range", "LessThanOrEqual(o_totalprice,250000.0)"),
        ("filter_q4", "LessThan(o_orderdate,2001-01-01T00:00)"),
        ("filter_from_date", "GreaterThanOrEqual(o_orderdate,1999-06-01T00:00)"),
        ("filter_early_customers", "LessThanOrEqual(o_custkey,100)"),
        ("filter_high_credit", "GreaterThan(c_acctbal,5000.0)"),
        ("filter_country", "EqualTo(n_name,NATION_19)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in QUERIES[name].run(spark, DATA_DIR)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize(
    "name, columns",
    [
        ("amount_stats", [["o_totalprice"]]),
        ("monthly_revenue", [["o_orderdate", "o_totalprice"]]),
        ("rfm", [["o_custkey", "o_orderdate", "o_totalprice"]]),
        ("credit_by_segment", [["c_acctbal", "c_mktsegment"]]),
        ("product_popularity", [["l_partkey", "l_quantity"]]),
        ("word_explode", [["doc_id", "text"]]),
        ("table_counts", [[], [], []]),
    ],
)
def test_scans_read_only_what_is_used(spark, name, columns):
    assert read_columns(plan_of(spark, name)) == columns


@pytest.mark.parametrize(
    "name",
    [
        "orders_final_top10",
        "limit_rows",
        "top_customers",
        "largest_totals",
        "top_countries",
        "top_country_credit",
        "most_common_status",
        "category_most_stock",
        "top_ips",
        "peak_hour",
    ],
)
def test_top_rows_need_no_full_sort(spark, name):
    text = plan_of(spark, name)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("order_summary", 0),
        ("filter_shipped_high", 0),
        ("revenue_by_status", 1),
        ("rfm", 1),
        ("total_per_customer", 1),
        ("salt_keys", 1),
        ("skew_sum", 1),
        ("high_404_ips", 1),
        ("suspicious_rate", 1),
        ("salted_sum", 2),
        ("conversion_funnel", 2),
        ("bounce_rate", 2),
        ("log_summary", 2),
    ],
)
def test_shuffles(spark, name, shuffles):
    text = plan_of(spark, name)
    assert len(re.findall(r"\bExchange ", text)) == shuffles
    if shuffles:
        assert "partial_" in text


def test_joins_are_chosen_by_size(spark, without_broadcast):
    assert "SortMergeJoin" in plan_of(spark, "category_revenue")
    text = plan_of(spark, "category_revenue_shuffle")
    assert "SortMergeJoin" in text
    # The quantities are added up before they are shuffled, and that shuffle serves
    # the join as well.
    assert text.count("hashpartitioning(productCode") == 2
    assert "BroadcastHashJoin" in plan_of(spark, "broadcast_lookup")
