"""Timeline operators against plain Python, on hot keys, ties and missing values, and their plans."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import aggregates, quality, timelines
from tallyworks.plans.catalog import QUERIES
from tests.conftest import plan, rows
from tests.oracle import connect, differences

NAMES = [
    "asof_purchase", "interval_after_purchase", "sessions", "ordered_funnel",
    "top_orders_per_customer", "running_revenue", "moving_revenue",
]
SCHEMA = "id bigint, user string, at timestamp, kind string"
START = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def made():
    """Two thirds of the events belong to one user; times repeat, users and times are missing."""
    draw = random.Random(4)
    found = []
    for number in range(900):
        user = "hot" if number % 3 else draw.choice(["a", "b", "c", None])
        at = START + dt.timedelta(minutes=10 * draw.randint(0, 1500))
        found.append((number, user, None if number % 40 == 0 else at, draw.choice("xyz")))
    return found


@pytest.fixture(scope="module")
def events(spark, made):
    return spark.createDataFrame(made, SCHEMA).repartition(5)


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("hours", [1, 24, 10_000])
def test_asof_join(events, made, inclusive, hours):
    found = timelines.asof_join(
        events, events.where("kind = 'x'"), "user", "at", "id",
        values={"id": "last_id", "at": "last_at"}, inclusive=inclusive, bucket_seconds=3600 * hours,
    )
    expected = []
    for row in made:
        _, user, at, _ = row
        before = [
            (other[2], other[0])
            for other in made
            if other[3] == "x" and None not in (user, at, other[2]) and other[1] == user
            and (other[2] <= at if inclusive else other[2] < at)
        ]
        best = max(before, default=(None, None))
        expected.append((*row, best[1], best[0]))
    assert rows(found) == sorted(expected, key=repr)
    assert found.columns == [*events.columns, "last_id", "last_at"]


@pytest.mark.parametrize("keys", [[], ["user"]])
@pytest.mark.parametrize("base", [60, 86_400])
def test_interval_join(spark, events, made, keys, base):
    draw = random.Random(8)
    periods = []
    for number in range(60):
        begin = START + dt.timedelta(minutes=draw.randint(-500, 15_000))
        end = begin + dt.timedelta(minutes=draw.choice([-5, 0, 1, 10, 60, 900, 20_000]))
        periods.append((number, draw.choice(["hot", "a", "b", None]), begin, None if number % 9 == 0 else end))
    intervals = spark.createDataFrame(periods, "period bigint, user string, begin timestamp, end timestamp")
    if not keys:
        intervals = intervals.drop("user")
    found = timelines.interval_join(events, intervals, "at", "begin", "end", keys=keys, base_seconds=base)
    expected = [
        (number, event[0])
        for number, user, begin, end in periods
        for event in made
        if end and event[2] and begin <= event[2] < end and (not keys or user and user == event[1])
    ]
    assert rows(found.select("period", "id")) == sorted(expected, key=repr)


@pytest.mark.parametrize("hours", [1, 24, 10_000])
def test_sessions(events, made, hours):
    found = timelines.sessions(events, "user", "at", gap_seconds=1800, bucket_seconds=3600 * hours)
    expected = []
    for user in ("hot", "a", "b", "c"):
        times = sorted(event[2] for event in made if event[1] == user and event[2])
        for at in times:
            if expected and expected[-1][0] == user and at - expected[-1][2] <= dt.timedelta(seconds=1800):
                expected[-1][2:] = [at, expected[-1][3] + 1]
            else:
                expected.append([user, at, at, 1])
    assert rows(found) == sorted(map(tuple, expected), key=repr)


def test_ordered_funnel(events, made):
    steps = {name: F.col("kind") == name for name in "xyzx"[:3]}
    found = timelines.ordered_funnel(events, "user", ["at", "id"], steps).collect()
    reached = dict.fromkeys("xyz", 0)
    for user in ("hot", "a", "b", "c"):
        state = 0
        for _, _, kind in sorted((e[2], e[0], e[3]) for e in made if e[1] == user and e[2]):
            if state < 3 and kind == "xyz"[state]:
                state += 1
                reached[kind] += 1
    assert [(row.step, row.visitors) for row in found] == list(reached.items())


def test_an_order_that_is_never_kept_reaches_no_step(spark):
    data = [(1, "a", START, "y"), (2, "a", START + dt.timedelta(hours=1), "x"), (3, None, START, "x")]
    steps = {name: F.col("kind") == name for name in "xy"}
    found = timelines.ordered_funnel(spark.createDataFrame(data, SCHEMA), "user", ["at", "id"], steps)
    assert [row.visitors for row in found.collect()] == [1, 0]


def test_running_totals(spark):
    draw = random.Random(6)
    data = [(number, draw.randint(0, 9), draw.choice([None, 5, -3, 10**12])) for number in range(500)]
    table = spark.createDataFrame(data, "id bigint, day int, cents bigint").repartition(7)
    ordered = sorted(data, key=lambda row: (row[1], row[0]))
    for frame in (None, 1, 20, 1000):
        found = timelines.running_totals(table, ["day", "id"], F.col("cents"), frame=frame)
        expected = [
            (*row, sum(r[2] or 0 for r in ordered[max(0, at + 1 - (frame or at + 1)) : at + 1]))
            for at, row in enumerate(ordered)
        ]
        assert rows(found) == sorted(expected, key=repr)


def test_empty_tables(events, spark):
    none = events.where("false")
    assert timelines.asof_join(none, none, "user", "at", "id", values={"id": "other"}).count() == 0
    assert timelines.sessions(none, "user", "at", gap_seconds=5).count() == 0
    assert timelines.interval_join(events, none.selectExpr("at begin", "at end"), "at", "begin", "end").count() == 0
    assert timelines.running_totals(none, ["id"], F.col("id")).count() == 0
    funnel = timelines.ordered_funnel(none, "user", ["at"], {"x": F.col("kind") == "x"}).collect()
    assert [row.visitors for row in funnel] == [0]


def test_ranks_are_cut_before_the_shuffle(spark):
    text = plan(QUERIES["top_orders_per_customer"].run(spark, "/root/testdata/sf0.001"))
    cuts = [at for at in range(len(text)) if text.startswith("WindowGroupLimit", at)]
    assert len(cuts) == 2 and cuts[0] < text.index("Exchange hashpartitioning") < cuts[1]


@pytest.mark.parametrize("name", ["asof_purchase", "sessions"])
def test_no_task_sorts_the_rows_of_one_key(spark, name):
    text = plan(QUERIES[name].run(spark, "/root/testdata/sf0.001"))
    assert "Cartesian" not in text and "NestedLoop" not in text and "SinglePartition" not in text
    if name == "asof_purchase":
        sorts = [line for line in text.split("\n") if "Window [last(_match" in line and "_row" in line]
        assert sorts == [] or all("_bucket" in line for line in sorts)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_without_broadcast(without_broadcast, tmp_path, name):
    import duckdb

    source = "/root/testdata/sf0.01"
    changed = {
        "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)",
        "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    }
    for table, columns in changed.items():
        duckdb.sql(
            f"COPY (SELECT {columns} FROM '{source}/{table}.parquet') TO '{tmp_path}/{table}.parquet'"
        )
    query = QUERIES[name]
    mine = query.run(without_broadcast, str(tmp_path)).toArrow()
    assert differences(mine, connect(str(tmp_path)).sql(query.sql).to_arrow_table()) == []


def test_rollup_of_missing_values(spark):
    data = [("a", "x", 1.5), ("a", None, 2.25), (None, "x", None), ("a", "x", float("nan")), (None, None, 0.1)]
    table = spark.createDataFrame(data, "a string, b string, amount double")
    found = {row[:4]: row[4] for row in rows(aggregates.revenue_rollup(table, ["a", "b"], "amount").drop("average"))}
    counts = {key[:3]: key[3] for key in found}
    assert counts[None, None, 0] == 5 and counts["a", None, 1] == 3 and counts["a", None, 2] == 1
    assert counts[None, None, 1] == 2 and counts[None, None, 2] == 1
    assert found[None, None, 0, 5] == 3.85 and found[None, "x", 2, 1] is None


def test_multiset_difference(spark):
    left = spark.createDataFrame([(1, "a")] * 3 + [(None, "b"), (2, None)], "k int, v string")
    right = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("c", 3)], "v string, k int")
    assert rows(quality.multiset_difference(left, right)) == rows_of(
        (1, "a", 2, 0), (2, None, 1, 0), (3, "c", 0, 2)
    )
    assert quality.multiset_difference(left, left).count() == 0


def rows_of(*expected):
    return sorted(expected, key=repr)
