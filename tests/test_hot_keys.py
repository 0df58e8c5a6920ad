"""Queries on tables where one key holds a third of the rows, without broadcast."""

import pytest

from tallyworks.operators import placement
from tallyworks.plans.catalog import QUERIES
from tests.oracle import connect, differences

SOURCE = "/root/testdata/sf0.01"

# One customer with a third of the orders, one product with a third of the lines, one
# order with a third of the rest, and one visitor with a third of the requests.
HOT = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": """* REPLACE (CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey,
                   CASE WHEN l_suppkey % 3 = 1 THEN 7 ELSE l_orderkey END AS l_orderkey)""",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
    "customer": "*",
    "nation": "*",
    "part": "*",
}

NAMES = [
    "join_inner",
    "join_left",
    "join_right",
    "join_full_classified",
    "customers_without_orders",
    "orphaned_orders",
    "orders_full",
    "revenue_by_product",
    "avg_order_value",
    "category_revenue",
    "category_revenue_shuffle",
    "customer_ltv",
    "grouped_orders",
    "rfm",
    "shared_enrichment",
    "duplicate_keys",
    "md5_partition",
    "range_partition",
    "partition_top_key",
    "partition_contents",
    "agg_after_partition",
    "skew_report",
    "bounce_rate",
    "conversion_funnel",
    "suspicious_rate",
    "high_404_ips",
]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = connect(SOURCE)
    for name, columns in HOT.items():
        con.execute(f"COPY (SELECT {columns} FROM {name}) TO '{folder}/{name}.parquet'")
    return str(folder)


@pytest.fixture(scope="module")
def duck(hot_dir):
    return connect(hot_dir)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_no_result(without_broadcast, hot_dir, duck, name, monkeypatch):
    # Every placed partition is spread over several tasks.
    spread = {"row_id": (), "tasks": dict.fromkeys(range(16), 3)}
    monkeypatch.setattr(placement.place, "__kwdefaults__", spread)
    query = QUERIES[name]
    mine = query.run(without_broadcast, hot_dir).toArrow()
    assert differences(mine, duck.sql(query.sql).to_arrow_table()) == []
