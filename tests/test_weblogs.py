import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import weblogs
from tests.conftest import plan, rows


def line(ip="1.1.1.1", time="01/Jan/2024:10:00:00", page="/home", status=200, ms=100):
    return f'{ip} - - [{time}] "GET {page} HTTP/1.1" {status} {ms} "Agent"'


def text(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def logs(spark, *values):
    return weblogs.parse_lines(text(spark, values))


ODD = {
    "good": line(),
    "trailing blank": line(time="01/Jan/2024:10:00:00 "),
    "zone": line(time="01/Jan/2024:10:00:00 +0000"),
    "size is a dash": line(ms="-"),
    "leading junk": "xx " + line(),
    "trailing junk": line() + " tail",
    "empty": "",
    "words": "not a log line",
    "bad day": line(time="99/Jan/2024:10:00:00"),
}


def test_which_lines_match(spark):
    verdicts = {}
    for name, value in ODD.items():
        verdicts[name] = logs(spark, value).count() == 1
    assert verdicts == {
        "good": True,
        "trailing blank": True,
        "zone": False,
        "size is a dash": False,
        "leading junk": True,
        "trailing junk": True,
        "empty": False,
        "words": False,
        "bad day": True,
    }


SEPARATORS = [
    f"before{mark}{line()}{mark}after" for mark in ("\u2028", "\x85", "\x0b", "\x01", "$1")
]


def test_fields_are_those_of_one_extraction_each(spark):
    values = text(spark, [*ODD.values(), *SEPARATORS, line(page="/a$2\\b"), line() + line()])
    parsed = weblogs.parse_lines(values, keep_invalid=True)
    fields = [
        F.regexp_extract("value", weblogs.LOG_PATTERN, place).alias(name)
        for place, name in enumerate(weblogs.LOG_FIELDS, start=1)
    ]
    expected = values.select(*fields)
    for name in weblogs.NUMBER_FIELDS:
        expected = expected.withColumn(name, F.col(name).try_cast("int"))
    assert rows(parsed) == rows(expected)
    valid = parsed.where("ip <> ''").count()
    assert valid == 5 + len(SEPARATORS) + 2
    assert weblogs.line_quality(values).first()["valid"] == valid
    assert weblogs.parse_lines(values).count() == valid


def test_numbers_too_large_become_null(spark):
    row = logs(spark, line(ms=99999999999)).first()
    assert row["response_time_ms"] is None and row["ip"] == "1.1.1.1"


def test_quality(spark):
    assert tuple(weblogs.line_quality(text(spark, ODD.values())).first()) == (9, 5, 4)


def test_summary_counts_before_the_filter(spark):
    values = [line(page="/a"), line(page="/a"), line(page="/b"), "junk"]
    assert tuple(weblogs.log_summary(text(spark, values)).first()) == (4, 3, 2)
    assert tuple(weblogs.log_summary(text(spark, [])).first()) == (0, 0, 0)


def test_pattern_runs_once_per_line(spark):
    parsed = weblogs.with_times(logs(spark, line()))
    assert plan(parsed).count("regexp_replace") == 1
    assert plan(weblogs.traffic_by_hour(parsed)).count("try_to_timestamp") == 1


def test_times(spark):
    timed = weblogs.with_times(
        logs(spark, line(), line(time="99/Jan/2024:10:00:00"), ODD["trailing blank"])
    )
    got = [(r["parsed_timestamp"], r["hour"]) for r in timed.collect()]
    assert got == [(dt.datetime(2024, 1, 1, 10), 10)] * 2
    assert dict(timed.dtypes)["parsed_timestamp"] == "timestamp_ntz"


def test_distributions(spark):
    df = weblogs.with_times(
        logs(
            spark,
            line("a", page="/x", status=404, ms=10),
            line("b", page="/x", ms=20, time="01/Jan/2024:11:00:00"),
            line("b", page="/y", ms=30, time="01/Jan/2024:11:30:00"),
        )
    )
    assert [tuple(r) for r in weblogs.status_distribution(df).collect()] == [(200, 2), (404, 1)]
    assert [tuple(r) for r in weblogs.top_endpoints(df).collect()] == [("/x", 2), ("/y", 1)]
    assert [tuple(r) for r in weblogs.method_distribution(df).collect()] == [("GET", 3)]
    assert [tuple(r) for r in weblogs.top_ips(df, 1).collect()] == [("b", 2)]
    assert tuple(weblogs.response_time_stats(df).first()) == (3, 10, 30, 20.0)
    assert [tuple(r) for r in weblogs.traffic_by_hour(df).collect()] == [(10, 1), (11, 2)]
    assert [tuple(r) for r in weblogs.peak_hour(df).collect()] == [(11, 2)]


def test_bounce_rate(spark):
    df = logs(spark, line("a"), line("b"), line("b"), line("c"))
    assert tuple(weblogs.bounce_rate(df).first()) == (3, 2, 66.6667)
    assert tuple(weblogs.bounce_rate(df.limit(0)).first()) == (0, 0, None)


def test_funnels_disagree_on_product_pages(spark):
    df = logs(
        spark,
        line("a", page="/home"),
        line("a", page="/home"),
        line("b", page="/products"),
        line("c", page="/product/1"),
        line("d", page="/cart/old"),
    )
    assert dict(rows(weblogs.conversion_funnel(df))) == {
        "Home": 1, "Products": 1, "Product Detail": 1, "Cart": 0, "Checkout": 0,
    }
    assert dict(rows(weblogs.conversion_funnel(df, weblogs.FUNNEL_CONTAINS))) == {
        "Home": 1, "Products": 1, "Product": 2, "Cart": 1, "Checkout": 0,
    }
    assert plan(weblogs.conversion_funnel(df)).count("hashpartitioning") == 1


def test_busy_windows_are_tumbling(spark):
    burst = [line("a", time=f"01/Jan/2024:10:00:{s:02d}") for s in range(51)]
    spread = [line("b", time=f"01/Jan/2024:10:{m:02d}:00") for m in range(60)]
    df = weblogs.with_times(logs(spark, *burst, *spread))
    assert rows(weblogs.busy_windows(df)) == [
        ("a", dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 1), 51)
    ]
    assert weblogs.busy_windows(df, above=51).count() == 0
    assert weblogs.busy_hours(df).first()[0] == 2


def test_404_ratio(spark):
    df = logs(spark, line("a", status=404), line("a"), line("b", status=404))
    assert rows(weblogs.high_404(df)) == [("b", 1.0, 1)]
    assert rows(weblogs.high_404(df, 0.4)) == [("a", 0.5, 2), ("b", 1.0, 1)]


@pytest.mark.parametrize("count, found", [(10, []), (11, [("/slow", 3000.0, 11)])])
def test_slow_endpoints_need_enough_requests(spark, count, found):
    df = logs(spark, *[line(page="/slow", ms=3000)] * count, line(page="/quick", ms=10))
    assert rows(weblogs.slow_endpoints(df)) == found
    assert rows(weblogs.slow_endpoint_status(df)) == [("/slow", 200, 3000.0)]
