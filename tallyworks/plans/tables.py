"""The given tables seen as customers, products, orders, order lines and log lines.

Every mapping keeps all rows of its source table. Each has its SQL twin in
``TABLE_SQL``, which the check queries put in front as common table expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.weblogs import LOG_FIELDS, LOG_PATTERN
from tallyworks.schemas import GIVEN

# Order priority to payment method.
PAYMENTS = (
    ("1-URGENT", "Credit Card"),
    ("2-HIGH", "PayPal"),
    ("3-MEDIUM", "Bank Transfer"),
    ("4-NOT SPECIFIED", "Debit Card"),
    ("5-LOW", "Cash"),
)
# Event type to page, and the lists that log fields are taken from.
PAGES = (
    ("signup", "/home"),
    ("view", "/products"),
    ("error", "/cart"),
    ("purchase", "/checkout"),
)
METHODS = ("GET", "POST", "PUT", "DELETE")
STATUSES = (200, 304, 404, 500, 503)
AGENT = "Mozilla/5.0 (Windows)"

# Customers of this segment carry numbers that no order uses: orders of theirs have
# no customer, and they have no orders.
UNMATCHED_SEGMENT = "MACHINERY"


def _case(subject: str, choices, otherwise: str) -> str:
    whens = " ".join(f"WHEN {key} THEN {value}" for key, value in choices)
    return f"CASE {subject} {whens} ELSE {otherwise} END"


def _quoted(pairs):
    return [(f"'{key}'", f"'{value}'") for key, value in pairs]


# Expressions that Spark and the check SQL read alike.
_STATUS = """CASE WHEN o_orderstatus = 'F' THEN 'Shipped'
                  WHEN o_orderstatus = 'O' THEN 'Processing'
                  WHEN o_orderkey % 2 = 0 THEN 'On Hold'
                  ELSE 'Cancelled' END"""
_PAYMENT = _case("o_orderpriority", _quoted(PAYMENTS), "NULL")
_METHOD = _case(
    f"event_id % {len(METHODS)}", [(i, f"'{m}'") for i, m in enumerate(METHODS)], "NULL"
)
_PAGE = _case("event_type", _quoted(PAGES), "concat('/product/', 1 + event_id % 2)")


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    data_dir: str

    def raw(self, name: str) -> DataFrame:
        """A given table; its schema is stated, so planning opens no file."""
        reader = self.spark.read.schema(GIVEN[name])
        return reader.parquet(f"{self.data_dir}/{name}.parquet")

    def accounts(self) -> DataFrame:
        """Customers without their country."""
        return self.raw("customer").selectExpr(
            "c_custkey AS customerNumber",
            "c_name AS customerName",
            "c_acctbal AS creditLimit",
            "c_mktsegment AS customerSegment",
        )

    def customers(self) -> DataFrame:
        nation = self.raw("nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
        return self.raw("customer").join(nation, "c_nationkey").selectExpr(
            "c_custkey AS customerNumber",
            "c_name AS customerName",
            "n_name AS city",
            "n_name AS country",
            "c_acctbal AS creditLimit",
            "c_mktsegment AS customerSegment",
        )

    def renumbered(self) -> DataFrame:
        """All accounts, those of one segment under numbers that no order uses."""
        unmatched = f"customerSegment = '{UNMATCHED_SEGMENT}'"
        return self.accounts().withColumn(
            "customerNumber",
            F.expr(f"IF({unmatched}, -1 - customerNumber, customerNumber)"),
        )

    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS productCode",
            "p_name AS productName",
            "p_type AS productCategory",
            "p_size AS quantityInStock",
            "p_retailprice AS buyPrice",
            "p_retailprice * 2 AS MSRP",
        )

    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS orderNumber",
            "CAST(o_orderdate AS DATE) AS orderDate",
            "date_add(CAST(o_orderdate AS DATE), 7) AS requiredDate",
            f"{_STATUS} AS status",
            "o_custkey AS customerNumber",
            "o_totalprice AS totalAmount",
            f"{_PAYMENT} AS paymentMethod",
        )

    def details(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS orderNumber",
            "l_partkey AS productCode",
            "l_linenumber AS lineNumber",
            "l_extendedprice AS priceEach",
            "l_quantity AS quantity",
        )

    def sales(self) -> DataFrame:
        """Order lines with the customer of their order."""
        owner = self.orders().select("orderNumber", "customerNumber")
        lines = self.details().select("orderNumber", "productCode", "quantity")
        return lines.join(owner, "orderNumber")

    def pairs(self) -> DataFrame:
        """One key holds nine tenths of all rows."""
        return self.raw("lineitem").selectExpr(
            "IF(l_orderkey % 10 < 9, 'popular_key', concat('key_', l_suppkey % 10)) AS key",
            "CAST(l_quantity AS BIGINT) AS value",
            "l_orderkey AS orderNumber",
            "l_linenumber AS lineNumber",
        )

    def log_lines(self) -> DataFrame:
        """Every event as a line of a web-server log; some lines are malformed."""
        shade = f"CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % {len(STATUSES)}"
        status = _case(shade, enumerate(STATUSES), "NULL")
        time = """CASE WHEN event_id % 89 = 0
                       THEN date_format(ts, 'dd/MMM/yyyy:HH:mm:ss +0000')
                       WHEN event_id % 83 = 0
                       THEN date_format(ts, '99/MMM/yyyy:HH:mm:ss')
                       ELSE date_format(ts, 'dd/MMM/yyyy:HH:mm:ss') END"""
        line = f"""format_string('192.168.%d.%d - - [%s] "%s %s HTTP/1.1" %d %d "{AGENT}"',
                                 user_id div 256, user_id % 256, {time}, {_METHOD},
                                 {_PAGE}, {status}, floor(value * 50))"""
        return self.raw("events").selectExpr(
            f"IF(event_id % 97 = 0, concat('junk ', event_id), {line}) AS value"
        )


_ACCOUNTS = """
    SELECT c_custkey AS "customerNumber", c_name AS "customerName",
           c_acctbal AS "creditLimit", c_mktsegment AS "customerSegment"
    FROM customer"""

_LOG_FIELDS = ", ".join(f"'{name}'" for name in LOG_FIELDS)

TABLE_SQL: dict[str, str] = {
    "accounts": _ACCOUNTS,
    "customers": """
    SELECT c_custkey AS "customerNumber", c_name AS "customerName",
           n_name AS city, n_name AS country, c_acctbal AS "creditLimit",
           c_mktsegment AS "customerSegment"
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "renumbered": f"""
    SELECT * REPLACE (CASE WHEN "customerSegment" = '{UNMATCHED_SEGMENT}'
                           THEN -1 - "customerNumber"
                           ELSE "customerNumber" END AS "customerNumber")
    FROM ({_ACCOUNTS})""",
    "products": """
    SELECT p_partkey AS "productCode", p_name AS "productName",
           p_type AS "productCategory", p_size AS "quantityInStock",
           p_retailprice AS "buyPrice", p_retailprice * 2 AS "MSRP"
    FROM part""",
    "ordered": f"""
    SELECT o_orderkey AS "orderNumber",
           CAST(o_orderdate AS DATE) AS "orderDate",
           CAST(o_orderdate AS DATE) + 7 AS "requiredDate",
           {_STATUS} AS status,
           o_custkey AS "customerNumber", o_totalprice AS "totalAmount",
           {_PAYMENT} AS "paymentMethod"
    FROM orders""",
    "details": """
    SELECT l_orderkey AS "orderNumber", l_partkey AS "productCode",
           l_linenumber AS "lineNumber", l_extendedprice AS "priceEach",
           l_quantity AS quantity
    FROM lineitem""",
    "sales": """
    SELECT l_orderkey AS "orderNumber", l_partkey AS "productCode",
           l_quantity AS quantity, o_custkey AS "customerNumber"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "enriched": """
    SELECT l_orderkey AS "orderNumber", l_partkey AS "productCode",
           l_quantity AS quantity, o_custkey AS "customerNumber",
           p_type AS "productCategory", p_retailprice * l_quantity AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                  JOIN part ON l_partkey = p_partkey""",
    "orders_full": """
    SELECT * FROM details JOIN products USING ("productCode")
                          JOIN ordered USING ("orderNumber")
                          JOIN customers USING ("customerNumber")""",
    "pairs": """
    SELECT CASE WHEN l_orderkey % 10 < 9 THEN 'popular_key'
                ELSE 'key_' || CAST(l_suppkey % 10 AS VARCHAR) END AS key,
           CAST(l_quantity AS BIGINT) AS value,
           l_orderkey AS "orderNumber", l_linenumber AS "lineNumber"
    FROM lineitem""",
    "lines": f"""
    SELECT CASE WHEN event_id % 97 = 0 THEN 'junk ' || CAST(event_id AS VARCHAR)
           ELSE '192.168.' || CAST(user_id // 256 AS VARCHAR) || '.'
             || CAST(user_id % 256 AS VARCHAR) || ' - - ['
             || CASE WHEN event_id % 89 = 0
                     THEN strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000'
                     WHEN event_id % 83 = 0
                     THEN '99/' || strftime(ts, '%b/%Y:%H:%M:%S')
                     ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END
             || '] "'
             || {_METHOD}
             || ' '
             || {_PAGE}
             || ' HTTP/1.1" '
             || CAST({_case(r"CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) % 5",
                            list(enumerate(STATUSES)), "NULL")} AS VARCHAR)
             || ' ' || CAST(CAST(floor(value * 50) AS BIGINT) AS VARCHAR)
             || ' "{AGENT}"' END AS value
    FROM events""",
    "parsed": f"""
    SELECT f.ip AS ip, f.timestamp AS timestamp, f.method AS method,
           f.endpoint AS endpoint, f.protocol AS protocol,
           TRY_CAST(f.status AS INTEGER) AS status,
           TRY_CAST(f.response_time_ms AS INTEGER) AS response_time_ms
    FROM (SELECT regexp_extract(value, '{LOG_PATTERN}', [{_LOG_FIELDS}]) AS f FROM lines)""",
    "logs": "SELECT * FROM parsed WHERE ip <> ''",
    "timed": """
    SELECT *, CAST(hour(parsed_timestamp) AS INTEGER) AS hour
    FROM (SELECT *, try_strptime(trim(timestamp), '%d/%b/%Y:%H:%M:%S') AS parsed_timestamp
          FROM logs)
    WHERE parsed_timestamp IS NOT NULL""",
}
