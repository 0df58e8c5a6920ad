from tallyworks.operators import quality
from tests.conftest import plan, rows


def test_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    profile = quality.null_profile(df)
    assert dict(rows(profile)) == {"a": 1, "b": 2}
    assert plan(profile).count("Scan") == 1


def test_a_null_key_counts_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert tuple(quality.duplicate_keys(df, "k").first()) == (5, 3, 2)
    assert tuple(quality.duplicate_keys(df.limit(0), "k").first()) == (0, 0, 0)


def test_reports(spark):
    one = spark.range(3)
    two = spark.createDataFrame([("a", 1.0)], "s string, d double")
    assert rows(quality.table_counts({"one": one, "two": two})) == [("one", 3), ("two", 1)]
    assert rows(quality.duplicate_report({"one": (one, "id")})) == [("one", "id", 3, 3, 0)]
    assert rows(quality.schema_profile({"one": one, "two": two})) == [
        ("one", 3, 1, "id", "bigint"),
        ("two", 1, 1, "s", "string"),
        ("two", 1, 2, "d", "double"),
    ]


def test_what_holds_for_a_sample(spark):
    df = spark.range(2000)
    assert tuple(quality.sample_facts(df, "id", 0.1).first()) == (2000, True, True)
    assert tuple(quality.sample_facts(df.limit(0), "id", 0.1).first()) == (0, True, True)
