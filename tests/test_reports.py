import datetime as dt

from tallyworks import schemas
from tallyworks.plans import reports
from tallyworks.plans.tables import Tables
from tallyworks.session import work_path
from tallyworks.sources import delimited, lines
from tests.conftest import DATA_DIR, plan, rows


def shop(spark):
    customers = spark.createDataFrame(
        [(1, "A, Inc", None, None, "0", "x", "Rome", None, "Italy", 10.0, "Enterprise"),
         (2, "B", None, None, "0", "x", "Lyon", None, "France", 30.0, "SMB")],
        schemas.CUSTOMERS,
    )
    products = spark.createDataFrame(
        [("P1", "Pen", "Office", 4, 1.0, 2.0)], schemas.PRODUCTS
    )
    day = dt.date(2024, 6, 1)
    orders = spark.createDataFrame(
        [(10, day, day, "Shipped", 1, 5.5, "Cash"), (11, day, day, "Shipped", 2, 4.5, "Cash")],
        schemas.ORDERS,
    )
    details = spark.createDataFrame(
        [(10, "P1", 2.0), (11, "P1", 3.0)],
        "orderNumber bigint, productCode string, priceEach double",
    )
    return customers, products, orders, details


def test_retail_reports_from_csv(spark):
    folder = work_path(spark, "shop")
    customers, products, orders, details = shop(spark)
    for name, df in (("customers", customers), ("products", products), ("orders", orders)):
        delimited.write_csv(df, f"{folder}/{name}")
    read = [
        delimited.read_csv(spark, f"{folder}/{name}", schema)
        for name, schema in (
            ("customers", schemas.CUSTOMERS),
            ("products", schemas.PRODUCTS),
            ("orders", schemas.ORDERS),
        )
    ]
    found = reports.retail_reports(*read, details)
    assert dict(rows(found["summary"]))["Total Revenue"] == 10.0
    assert rows(found["q1_top_country_credit"]) == [("France", 30.0)]
    assert rows(found["revenue_by_product"]) == [("Pen", 5.0)]
    assert dict(rows(found["customer_nulls"]))["state"] == 2
    assert "revenue_by_product" not in reports.retail_reports(*read)
    reports.write_reports({"summary": found["summary"]}, f"{folder}/out")
    back = delimited.read_csv(spark, f"{folder}/out/summary", schemas.METRICS)
    assert rows(back) == rows(found["summary"])


def test_logs_are_parsed_once_and_then_read_by_column(spark):
    source, target = work_path(spark, "log"), work_path(spark, "requests")
    lines.write_lines(Tables(spark, DATA_DIR).log_lines(), source)
    requests = reports.process_logs(spark, source, target)
    found = reports.log_reports(requests)
    total = requests.count()
    assert sum(n for _, n in rows(found["status_distribution"])) == total
    assert sum(n for _, n in rows(found["traffic_by_hour"])) == total
    text = plan(found["status_distribution"])
    assert "regexp" not in text and "ReadSchema: struct<status:int>" in text
    for report in found.values():
        report.collect()
