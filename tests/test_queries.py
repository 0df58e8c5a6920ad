"""Every registered query against its check SQL."""

import re

import pytest

import __spark_entry__ as contract
from tallyworks.plans.catalog import QUERIES
from tests.conftest import DATA_DIR, plan
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def duck():
    return connect(DATA_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    query = QUERIES[name]
    df = query.run(spark, DATA_DIR)
    mine = df.toArrow()
    text = plan(df)
    assert "Cartesian" not in text and "NestedLoop" not in text
    if name != "partition_resource":
        assert not re.search("EvalPython|MapInArrow|MapInPandas", text)
    if query.sql is None:
        assert mine.num_rows > 0
        return
    other = duck.sql(query.sql).to_arrow_table()
    assert differences(mine, other) == []


JOINING = [
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
    "customer_ltv",
    "grouped_orders",
]


@pytest.mark.parametrize("name", JOINING)
def test_result_is_the_same_without_broadcast(without_broadcast, duck, name):
    query = QUERIES[name]
    mine = query.run(without_broadcast, DATA_DIR)
    other = duck.sql(query.sql).to_arrow_table()
    assert differences(mine.toArrow(), other) == []


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns == ["productCategory", "revenue"]
    assert flagship.count() == 6
