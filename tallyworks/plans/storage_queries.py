"""Queries that write tables to the shared work folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from tallyworks import schemas
from tallyworks.operators import weblogs
from tallyworks.operators.aggregates import business_summary
from tallyworks.operators.filters import in_country
from tallyworks.plans.log_queries import timed
from tallyworks.plans.registry import query
from tallyworks.plans.retail_queries import average, money
from tallyworks.plans.tables import Tables
from tallyworks.session import cut_lineage, work_path
from tallyworks.sources import columnar, delimited, lines


@query("csv_roundtrip", "SELECT * FROM ordered", uses="ordered")
def _(t: Tables):
    path = work_path(t.spark, "orders-csv")
    delimited.write_csv(t.orders(), path)
    return delimited.read_csv(t.spark, path, schemas.ORDERS)


@query(
    "csv_date_format",
    """SELECT "orderNumber",
              CASE WHEN "orderNumber" % 10 <> 0 THEN "orderDate" END AS "orderDate",
              "orderNumber" % 10 = 0 AS malformed
       FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    """Dates in the day-first form; every tenth order has one of another form, to be kept and told."""
    day_first = F.date_format("orderDate", "dd/MM/yyyy")
    other = F.date_format("orderDate", "yyyy.MM.dd")
    written = F.when(F.col("orderNumber") % 10 != 0, day_first).otherwise(other)
    texts = t.orders().select(F.concat_ws(",", "orderNumber", written).alias("value"))
    path = work_path(t.spark, "orders-by-date-format")
    texts.write.text(path)
    schema = schemas.ORDERS
    schema = StructType([schema["orderNumber"], schema["orderDate"]])
    checked = delimited.parse_checked(t.spark.read.text(path), schema, date_format="dd/MM/yyyy")
    number = F.substring_index(F.col(delimited.CORRUPT), ",", 1).cast(schema["orderNumber"].dataType)
    return checked.select(
        F.coalesce("orderNumber", number).alias("orderNumber"),
        "orderDate",
        F.col(delimited.CORRUPT).isNotNull().alias("malformed"),
    )


def inferred(t: Tables, table: DataFrame, label: str) -> DataFrame:
    """A table written as CSV and read with the types that its text shows.

    The reader takes the narrowest whole number that fits; here they are all long.
    """
    path = work_path(t.spark, label)
    delimited.write_csv(table, path)
    found = delimited.read_csv(t.spark, path)
    whole = [f.name for f in found.schema if isinstance(f.dataType, IntegralType)]
    return found.withColumns({name: found[name].cast("long") for name in whole})


@query("csv_inferred_customers", "SELECT * FROM customers", uses="customers")
def _(t: Tables):
    return inferred(t, t.customers(), "customers-csv")


@query(
    "csv_inferred_products",
    """SELECT * REPLACE (CAST("quantityInStock" AS BIGINT) AS "quantityInStock")
       FROM products""",
    uses="products",
)
def _(t: Tables):
    return inferred(t, t.products(), "products-csv")


@query("csv_multipart_sink","SELECT * FROM products", uses="products")
def _(t: Tables):
    path = work_path(t.spark, "products-csv")
    products = t.products()
    delimited.write_csv(products, path, header=False)
    return delimited.read_csv(t.spark, path, products.schema, header=False)


# Amounts of cancelled orders are written as text that is no number. The note holds a
# comma, inside quotes.
@query(
    "csv_typed_parse",
    """SELECT CASE WHEN NOT bad THEN "orderNumber" END AS "orderNumber",
              CASE WHEN NOT bad THEN "orderDate" END AS "orderDate",
              CASE WHEN NOT bad THEN note END AS note,
              CASE WHEN NOT bad THEN "totalAmount" END AS "totalAmount",
              CASE WHEN bad THEN concat("orderNumber", ',', "orderDate", ',"', note,
                                        '",n/a') END AS _corrupt_record
       FROM (SELECT *, status = 'Cancelled' AS bad, status || ', ' || "paymentMethod" AS note
             FROM ordered)""",
    uses="ordered",
)
def _(t: Tables):
    path = work_path(t.spark, "checked-csv")
    note = F.concat_ws(", ", "status", "paymentMethod")
    amount = F.when(F.col("status") == "Cancelled", "n/a").otherwise(
        F.col("totalAmount").cast("string")
    )
    text = F.format_string(
        '%d,%s,"%s",%s', "orderNumber", F.col("orderDate").cast("string"), note, amount
    )
    lines.write_lines(t.orders().select(text.alias("value")), path)
    schema = (
        StructType()
        .add("orderNumber", "long")
        .add("orderDate", "date")
        .add("note", "string")
        .add("totalAmount", "double")
    )
    return delimited.parse_checked(lines.read_lines(t.spark, path), schema)


@query(
    "empty_csv_sink",
    """SELECT 'customerNumber,customerName,city,country,creditLimit,customerSegment'
                AS header, COUNT(*) AS data_rows
       FROM customers WHERE country = 'USA'""",
    uses="customers",
)
def _(t: Tables):
    path = work_path(t.spark, "usa-csv")
    customers = t.customers()
    delimited.write_report(in_country(customers, "USA"), path)
    # The reader takes the names from the header of a file.
    header = ",".join(t.spark.read.option("header", True).csv(path).columns)
    rows = delimited.read_csv(t.spark, path, customers.schema)
    return rows.agg(F.count("*").alias("data_rows")).select(
        F.lit(header).alias("header"), "data_rows"
    )


@query(
    "merge_parts",
    f"""SELECT 'Total Customers' AS "Metric", CAST(COUNT(*) AS DOUBLE) AS "Value"
       FROM customer
       UNION ALL SELECT 'Total Products', COUNT(*) FROM part
       UNION ALL SELECT 'Total Orders', COUNT(*) FROM orders
       UNION ALL SELECT 'Total Revenue',
                 {money("o_totalprice")} FROM orders
       UNION ALL SELECT 'Average Order Value', {average("o_totalprice")} FROM orders""",
)
def _(t: Tables):
    parts = work_path(t.spark, "summary-parts")
    merged = work_path(t.spark, "summary")
    summary = business_summary(t.accounts(), t.products(), t.orders())
    delimited.write_csv(summary, parts, header=False)
    delimited.merge_parts(t.spark, parts, merged, schemas.METRICS)
    return delimited.read_csv(t.spark, merged, schemas.METRICS, header=False)


@query("log_parse", "SELECT * FROM parsed", uses="lines parsed")
def _(t: Tables):
    path = work_path(t.spark, "web-logs")
    lines.write_lines(t.log_lines(), path)
    return weblogs.parse_lines(lines.read_lines(t.spark, path), keep_invalid=True)


@query("text_split_scan", "SELECT COUNT(*) AS n, TRUE AS split FROM events")
def _(t: Tables):
    path = work_path(t.spark, "split-lines")
    lines.write_lines(t.log_lines(), path)
    with lines.minimum_splits(t.spark, 16):
        text = lines.read_lines(t.spark, path)
        by_split = text.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
        counted = cut_lineage(by_split)
    return counted.agg(F.sum("n").alias("n"), (F.count("*") >= 16).alias("split"))


@query(
    "parquet_roundtrip",
    "SELECT *, CAST(parsed_timestamp AS DATE) AS day FROM timed",
    uses="lines parsed logs timed",
)
def _(t: Tables):
    path = work_path(t.spark, "processed-logs")
    logs = timed(t).withColumn("day", F.col("parsed_timestamp").cast("date"))
    columnar.write_parquet(logs, path, partition_by=("day",))
    return columnar.read_parquet(t.spark, path)
