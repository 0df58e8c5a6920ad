import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyworks import schemas
from tallyworks.session import work_path
from tallyworks.sources import columnar, delimited, inline, lines
from tests.conftest import plan, rows


def files(path):
    return glob.glob(f"{path.removeprefix('file:')}/part-*")


@pytest.fixture
def path(spark):
    return work_path(spark, "test")


ORDER = (1, dt.date(2024, 1, 2), dt.date(2024, 1, 9), "Shipped", 7, 12.5, "PayPal")


def test_csv_round_trip_with_quotes_and_nulls(spark, path):
    rows_in = [ORDER, (2, None, None, 'a "b", c', None, None, None)]
    orders = spark.createDataFrame(rows_in, schemas.ORDERS)
    delimited.write_csv(orders, path)
    back = delimited.read_csv(spark, path, schemas.ORDERS)
    assert back.schema == schemas.ORDERS
    assert rows(back) == rows(orders)


def test_csv_types_can_be_inferred(spark, path):
    delimited.write_csv(spark.createDataFrame([ORDER], schemas.ORDERS), path)
    kinds = dict(delimited.read_csv(spark, path).dtypes)
    assert kinds["orderNumber"] == "int"
    assert kinds["orderDate"] == "date"
    assert kinds["totalAmount"] == "double"


def test_amount_is_renamed_and_total_amount_is_kept(spark):
    old = spark.createDataFrame([(1, 2.0)], "orderNumber int, amount double")
    new = spark.createDataFrame([(1, 2.0)], "orderNumber int, totalAmount double")
    assert delimited.canonical_orders(old).columns == new.columns
    assert delimited.canonical_orders(new).columns == new.columns


def test_csv_modes_for_malformed_lines(spark, path):
    text = spark.createDataFrame([("a,1.5",), ("b,much",)], "value string")
    lines.write_lines(text, path)

    def read(mode):
        return delimited.read_csv(spark, path, schemas.METRICS, header=False, mode=mode)

    assert rows(read("PERMISSIVE")) == [("a", 1.5), ("b", None)]
    assert rows(read("DROPMALFORMED")) == [("a", 1.5)]
    with pytest.raises(Exception, match="MALFORMED"):
        read("FAILFAST").collect()


CHECKED = (
    StructType().add("id", "long").add("name", "string").add("amount", "double")
)


def test_malformed_lines_are_kept_whole(spark):
    header = "id,name,amount"
    texts = [header, '1,"a, b",2.5', "x,c,1.0", "3,d", header, "4,e,n/a", "5,,7.0"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    checked = delimited.parse_checked(df, CHECKED, header=header)
    good, bad = delimited.split_checked(checked)
    assert rows(good) == [(1, "a, b", 2.5), (5, None, 7.0)]
    assert rows(bad) == [("3,d",), ("4,e,n/a",), ("x,c,1.0",)]
    # The verdict does not depend on the columns that are asked for.
    assert rows(good.select("id")) == [(1,), (5,)]
    assert good.count() == 2 and bad.count() == 3


def test_dates_of_another_form_are_kept_and_told(spark, path):
    texts = ["1,24/12/2024", "2,2024-12-24", "3,31/02/2024", "4,"]
    schema = "id int, day date"
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    checked = delimited.parse_checked(
        df, StructType.fromDDL(schema), date_format="dd/MM/yyyy"
    )
    good, bad = delimited.split_checked(checked)
    assert rows(good) == [(1, dt.date(2024, 12, 24)), (4, None)]
    assert rows(bad) == [("2,2024-12-24",), ("3,31/02/2024",)]
    df.write.text(path)
    read = delimited.read_csv(
        spark, path, StructType.fromDDL(schema), header=False, date_format="dd/MM/yyyy"
    )
    assert rows(read) == [(1, dt.date(2024, 12, 24)), (2, None), (3, None), (4, None)]


def test_lines_are_parsed_once(spark):
    df = spark.createDataFrame([("1,a,2.0",)], "value string")
    good, _ = delimited.split_checked(delimited.parse_checked(df, CHECKED))
    assert plan(good).count("from_csv") == 1


def test_empty_report_has_a_header(spark, path):
    orders = spark.createDataFrame([ORDER], schemas.ORDERS)
    delimited.write_report(orders.where(F.col("status") == "none"), path)
    assert len(files(path)) == 1
    assert open(files(path)[0]).read().strip() == ",".join(schemas.ORDERS.names)
    assert rows(delimited.read_csv(spark, path, schemas.ORDERS)) == []


def test_report_is_one_file(spark, path):
    report = spark.range(1000, numPartitions=8).groupBy((F.col("id") % 5).alias("k")).count()
    delimited.write_report(report, path)
    assert len(files(path)) == 1


def test_parts_are_merged(spark, path):
    parts = work_path(spark, "parts")
    metrics = spark.createDataFrame([("a", 1.0), ("b", 2.0)], schemas.METRICS)
    delimited.write_csv(metrics.repartition(5, "Metric"), parts, header=False)
    assert len(files(parts)) > 1
    delimited.merge_parts(spark, parts, path, schemas.METRICS)
    assert len(files(path)) == 1
    assert rows(delimited.read_csv(spark, path, schemas.METRICS, header=False)) == rows(metrics)


def test_parquet_guards(spark, path):
    with pytest.raises(columnar.MissingInput):
        columnar.read_parquet(spark, path)
    empty = spark.createDataFrame([], schemas.METRICS)
    columnar.write_parquet(empty, path)
    with pytest.raises(columnar.EmptyInput):
        columnar.read_parquet(spark, path)
    assert columnar.read_parquet(spark, path, allow_empty=True).count() == 0


def test_partitioned_parquet_is_pruned(spark, path):
    orders = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("day"))
    columnar.write_parquet(orders, path, partition_by=("day",))
    back = columnar.read_parquet(spark, path)
    one = back.where(F.col("day") == 1)
    assert one.count() == 33
    assert "PartitionFilters: [isnotnull(day" in plan(one)


def test_rebalance_is_planned_before_a_partitioned_write(spark):
    hinted = spark.range(10).withColumn("day", F.lit(1)).hint("rebalance", "day")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(hinted)


def test_lines_and_minimum_splits(spark, path):
    text = spark.range(1, 1001).select(
        F.format_string("row number %d of the file", "id").alias("value")
    )
    lines.write_lines(text.coalesce(1), path)
    key = "spark.sql.files.minPartitionNum"
    with lines.minimum_splits(spark, 4):
        split = lines.read_lines(spark, path)
        assert split.rdd.getNumPartitions() >= 4
        assert split.count() == 1000
    assert spark.conf.get(key, None) is None
    assert lines.read_lines(spark, path).rdd.getNumPartitions() == 1


def test_inline_tables(spark):
    status = inline.status_descriptions(spark)
    assert status.schema == schemas.STATUS_DESCRIPTIONS
    assert status.count() == 4
    assert "LocalTableScan" in plan(status)
    assert inline.inline_table(spark, [], schemas.METRICS).count() == 0
    assert rows(inline.inline_table(spark, [("a", None)], schemas.METRICS)) == [("a", None)]
