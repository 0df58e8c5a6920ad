"""Queries over customers, products, orders and order lines.

Amount limits are fifty times the operators' defaults, and credit limits a tenth, as
the given amounts and balances are on other scales.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyworks.functions.numeric import affine_steps
from tallyworks.functions.text import WHITESPACE
from tallyworks.operators import aggregates, filters, joins, projections, quality
from tallyworks.plans.registry import query
from tallyworks.plans.tables import PAYMENTS, TABLE_SQL, UNMATCHED_SEGMENT, Tables
from tallyworks.schemas import PAYMENT_METHODS
from tallyworks.session import spread_evenly
from tallyworks.sources.inline import inline_table, status_descriptions

SEGMENT = "HOUSEHOLD"
REFERENCE_DATE = dt.date(2001, 8, 2)


def money(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def average(column: str) -> str:
    """Exact average to the cent, in whole numbers; for averages above zero."""
    total = f"SUM(CAST(CAST({column} AS DECIMAL(18,2)) * 100 AS BIGINT))"
    return f"CAST((2 * {total} + COUNT({column})) // (2 * COUNT({column})) AS DOUBLE) / 100"


# --- Projections and row-wise maps ------------------------------------------------


@query(
    "order_summary",
    """SELECT "orderNumber" AS id, "orderDate" AS date, "totalAmount" AS amount, status
       FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    return projections.order_summary(t.orders())


@query(
    "enterprise_upper",
    f"""SELECT "customerName", city, country, upper("customerName") AS "customerNameUpper"
        FROM customers WHERE "customerSegment" = '{SEGMENT}'""",
    uses="customers",
)
def _(t: Tables):
    return projections.upper_names(
        t.customers(), SEGMENT, ("customerName", "city", "country")
    )


@query(
    "drop_columns",
    """SELECT "orderNumber", "orderDate", status, "customerNumber", "totalAmount"
       FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    return projections.without_columns(t.orders(), "requiredDate", "paymentMethod")


@query(
    "order_size",
    """SELECT "orderNumber", "totalAmount",
              CASE WHEN "totalAmount" < 50000 THEN 'Small'
                   WHEN "totalAmount" < 250000 THEN 'Medium'
                   ELSE 'Large' END AS "orderSize"
       FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    sized = projections.with_order_size(t.orders(), 50000, 250000)
    return sized.select("orderNumber", "totalAmount", "orderSize")


@query(
    "shipped_priority",
    """SELECT "orderNumber", "orderDate", ROUND("totalAmount", 0) AS "amountRounded",
              CASE WHEN "totalAmount" > 250000 THEN 'High'
                   WHEN "totalAmount" > 100000 THEN 'Medium'
                   ELSE 'Low' END AS priority, status
       FROM ordered WHERE status = 'Shipped'""",
    uses="ordered",
)
def _(t: Tables):
    return projections.shipped_priority(t.orders(), 250000, 100000)


@query(
    "orders_final_top10",
    """SELECT *, "totalAmount" > 150000 AS "isLargeOrder",
              printf('ORDER-%05d', "orderNumber") AS "orderCode"
       FROM ordered
       WHERE "orderDate" >= DATE '1999-06-01' AND status IN ('Processing', 'Shipped')
       ORDER BY "totalAmount" DESC, "orderNumber" LIMIT 10""",
    uses="ordered",
)
def _(t: Tables):
    return projections.largest_open_orders(t.orders(), dt.date(1999, 6, 1), 150000)


@query("city_country", "SELECT city, country FROM customers", uses="customers")
def _(t: Tables):
    return projections.city_country(t.customers())


@query(
    "formatted_ids",
    """SELECT "customerNumber", printf('CUST-%05d', "customerNumber") AS "customerCode"
       FROM accounts""",
    uses="accounts",
)
def _(t: Tables):
    return projections.formatted_ids(t.accounts())


@query(
    "customer_tier",
    """SELECT "customerNumber", "customerName", "customerSegment",
              CASE WHEN "creditLimit" > 7500 THEN 'High'
                   WHEN "creditLimit" >= 2500 THEN 'Medium' ELSE 'Low' END AS tier
       FROM accounts""",
    uses="accounts",
)
def _(t: Tables):
    return projections.customer_tiers(t.accounts(), 7500, 2500)


@query(
    "square_map",
    """SELECT "productCode", "quantityInStock",
              CAST("quantityInStock" AS BIGINT) * "quantityInStock" AS squared FROM products""",
    uses="products",
)
def _(t: Tables):
    return projections.squared(t.products(), "productCode", "quantityInStock")


@query(
    "amount_with_tax",
    """SELECT "customerNumber", "totalAmount" * CAST(1.1 AS DOUBLE) AS with_tax,
              "totalAmount" * "totalAmount" AS amount_squared FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    return projections.amount_with_tax(t.orders())


@query(
    "word_explode",
    f"""SELECT doc_id, word
        FROM (SELECT doc_id, unnest(string_split_regex(text, '{WHITESPACE}')) AS word
              FROM documents)
        WHERE word <> ''""",
)
def _(t: Tables):
    return projections.explode_words(t.raw("documents"), "doc_id", "text")


@query(
    "revenue_enrich",
    """SELECT "productCode", "orderNumber", quantity, "customerNumber",
              "productCategory", revenue FROM enriched""",
    uses="enriched",
)
def _(t: Tables):
    return aggregates.revenue_enrich(t.sales(), t.products())


@query(
    "iterated_affine",
    """SELECT "productCode",
              ROUND(log10(list_reduce(
                list_prepend(CAST("productCode" AS DOUBLE),
                             list_transform(range(1000), lambda i: CAST(0 AS DOUBLE))),
                lambda a, z: (a * CAST(1.1 AS DOUBLE) + CAST(0.5 AS DOUBLE))
                             / CAST(1.05 AS DOUBLE) + z)), 9) AS log10_y
       FROM products""",
    uses="products",
)
def _(t: Tables):
    y = affine_steps(F.col("productCode"))
    codes = spread_evenly(t.products().select("productCode"))
    return codes.select("productCode", F.round(F.log10(y), 9).alias("log10_y"))


@query(
    "partition_resource",
    """SELECT "productCode", "quantityInStock" * 10 AS "quantityInStock"
       FROM products""",
    uses="products",
)
def _(t: Tables):
    stock = t.products().select("productCode", "quantityInStock")
    return projections.scaled_per_partition(stock, "quantityInStock", 10)


# --- Filters ------------------------------------------------------------------------


def _orders_where(condition: str) -> str:
    return f"SELECT * FROM ordered WHERE {condition}"


@query("filter_high_value", _orders_where('"totalAmount" > 250000'), uses="ordered")
def _(t: Tables):
    return filters.high_value(t.orders(), 250000)


@query(
    "filter_shipped_high",
    _orders_where("""status = 'Shipped' AND "totalAmount" > 100000"""),
    uses="ordered",
)
def _(t: Tables):
    return filters.status_above(t.orders(), ["Shipped"], 100000)


@query(
    "filter_problem_orders",
    _orders_where("""status IN ('On Hold', 'Cancelled') AND "totalAmount" > 50000"""),
    uses="ordered",
)
def _(t: Tables):
    return filters.status_above(t.orders(), ["On Hold", "Cancelled"], 50000)


@query(
    "filter_q4",
    _orders_where('year("orderDate") = 2000 AND month("orderDate") >= 10'),
    uses="ordered",
)
def _(t: Tables):
    return filters.fourth_quarter(t.orders(), 2000)


@query(
    "filter_amount_range",
    _orders_where('"totalAmount" BETWEEN 50000 AND 250000'),
    uses="ordered",
)
def _(t: Tables):
    return filters.amount_between(t.orders(), 50000, 250000)


@query("filter_status_eq", _orders_where("status = 'Processing'"), uses="ordered")
def _(t: Tables):
    return filters.with_status(t.orders(), "Processing")


@query(
    "filter_early_customers",
    _orders_where('"customerNumber" BETWEEN 1 AND 100'),
    uses="ordered",
)
def _(t: Tables):
    return filters.early_customers(t.orders())


@query(
    "filter_paypal_high",
    _orders_where("""\"paymentMethod\" = 'PayPal' AND "totalAmount" > 100000"""),
    uses="ordered",
)
def _(t: Tables):
    return filters.paid_above(t.orders(), "PayPal", 100000)


@query(
    "filter_country",
    "SELECT * FROM customers WHERE country = 'NATION_19'",
    uses="customers",
)
def _(t: Tables):
    return filters.in_country(t.customers(), "NATION_19")


@query(
    "filter_high_credit",
    'SELECT * FROM accounts WHERE "creditLimit" > 5000',
    uses="accounts",
)
def _(t: Tables):
    return filters.high_credit(t.accounts(), 5000)


@query(
    "filter_from_date",
    _orders_where("\"orderDate\" >= DATE '1999-06-01'"),
    uses="ordered",
)
def _(t: Tables):
    return filters.from_date(t.orders(), dt.date(1999, 6, 1))


@query(
    "filter_status_in",
    _orders_where("status IN ('Processing', 'Shipped')"),
    uses="ordered",
)
def _(t: Tables):
    return filters.with_status(t.orders(), "Processing", "Shipped")


# Sampling has no SQL twin: rows only. What holds for every sample is checked next.
@query("sample_orders")
def _(t: Tables):
    return filters.sample_rows(t.orders())


@query("sample_facts", "SELECT COUNT(*) AS n, TRUE AS contained, TRUE AS fair FROM orders")
def _(t: Tables):
    return quality.sample_facts(t.orders(), "orderNumber", 0.1)


@query(
    "limit_rows",
    'SELECT * FROM accounts ORDER BY "customerNumber" LIMIT 100',
    uses="accounts",
)
def _(t: Tables):
    return filters.first_rows(t.accounts(), 100, "customerNumber")


# --- Joins --------------------------------------------------------------------------

_JOIN_COLUMNS = """"customerNumber", "customerName", "creditLimit", "customerSegment",
              "orderNumber", "orderDate", status, "totalAmount\""""


def _join_orders(t: Tables):
    return t.orders().select(
        "customerNumber", "orderNumber", "orderDate", "status", "totalAmount"
    )


@query(
    "join_inner",
    f"""SELECT {_JOIN_COLUMNS} FROM renumbered JOIN ordered USING ("customerNumber")""",
    uses="renumbered ordered",
)
def _(t: Tables):
    return joins.inner(t.renumbered(), _join_orders(t), "customerNumber")


@query(
    "join_left",
    f"""SELECT {_JOIN_COLUMNS}
        FROM renumbered LEFT JOIN ordered USING ("customerNumber")""",
    uses="renumbered ordered",
)
def _(t: Tables):
    return joins.left_outer(t.renumbered(), _join_orders(t), "customerNumber")


@query(
    "join_right",
    f"""SELECT {_JOIN_COLUMNS}
        FROM ordered RIGHT JOIN renumbered USING ("customerNumber")""",
    uses="renumbered ordered",
)
def _(t: Tables):
    return joins.right_outer(_join_orders(t), t.renumbered(), "customerNumber")


@query(
    "customers_without_orders",
    """SELECT * FROM renumbered c WHERE NOT EXISTS
         (SELECT 1 FROM ordered o WHERE o."customerNumber" = c."customerNumber")""",
    uses="renumbered ordered",
)
def _(t: Tables):
    return joins.without_match(t.renumbered(), t.orders(), "customerNumber")


@query(
    "orphaned_orders",
    f"""SELECT * FROM ordered WHERE "customerNumber" IN
          (SELECT c_custkey FROM customer WHERE c_mktsegment = '{UNMATCHED_SEGMENT}')""",
    uses="ordered",
)
def _(t: Tables):
    return joins.without_match(t.orders(), t.renumbered(), "customerNumber").select(
        *t.orders().columns
    )


@query(
    "join_full_classified",
    """SELECT CASE WHEN o.k IS NULL THEN 'only_left'
                   WHEN c.k IS NULL THEN 'only_right' ELSE 'both' END AS presence,
              COUNT(*) AS rows
       FROM (SELECT "customerNumber" AS k FROM renumbered) c
       FULL JOIN (SELECT "customerNumber" AS k FROM ordered) o ON c.k = o.k
       GROUP BY 1""",
    uses="renumbered ordered",
)
def _(t: Tables):
    return joins.match_classes(t.renumbered(), t.orders(), "customerNumber")


@query(
    "broadcast_lookup",
    """SELECT "orderNumber", status,
              CASE status WHEN 'Shipped' THEN 'Order has been shipped to customer'
                          WHEN 'Processing' THEN 'Order is being processed'
                          WHEN 'On Hold' THEN 'Order is temporarily on hold'
                          ELSE 'Unknown' END AS status_desc
       FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    # One status is left out of the lookup, so that the default is seen too.
    known = status_descriptions(t.spark).where(F.col("status") != "Cancelled")
    described = joins.with_description(t.orders(), F.broadcast(known))
    return described.select("orderNumber", "status", "status_desc")


@query(
    "inline_table",
    """SELECT label AS method, COUNT(*) AS n
       FROM orders JOIN (VALUES ('1-URGENT', 'Credit Card'), ('2-HIGH', 'PayPal'),
              ('3-MEDIUM', 'Bank Transfer'), ('4-NOT SPECIFIED', 'Debit Card'),
              ('5-LOW', 'Cash')) AS v(priority, label) ON o_orderpriority = priority
       GROUP BY label""",
)
def _(t: Tables):
    methods = inline_table(t.spark, PAYMENTS, PAYMENT_METHODS)
    counts = aggregates.count_by(t.raw("orders"), "o_orderpriority")
    named = counts.join(F.broadcast(methods), "o_orderpriority")
    return named.select("method", "n")


_FULL_COLUMNS = (
    "orderNumber",
    "productCode",
    "customerNumber",
    "lineNumber",
    "priceEach",
    "productName",
    "productCategory",
    "orderDate",
    "status",
    "customerName",
    "country",
)
_FULL_SQL = ", ".join(f'"{name}"' for name in _FULL_COLUMNS)


def full_orders(t: Tables):
    return joins.orders_full(t.details(), t.products(), t.orders(), t.customers())


@query(
    "orders_full",
    f"SELECT {_FULL_SQL} FROM orders_full",
    uses="details products ordered customers orders_full",
)
def _(t: Tables):
    return full_orders(t).select(*_FULL_COLUMNS)


@query(
    "orders_customers",
    'SELECT * FROM ordered JOIN customers USING ("customerNumber")',
    uses="ordered customers",
)
def _(t: Tables):
    return joins.orders_customers(t.orders(), t.customers())


@query(
    "optional_enrichment",
    f"""SELECT 'with details' AS branch, COUNT(*) AS n, {money('"priceEach"')} AS amount
        FROM orders_full
        UNION ALL
        SELECT 'without details', COUNT(*), {money('"totalAmount"')}
        FROM ordered JOIN customers USING ("customerNumber")""",
    uses="details products ordered customers orders_full",
)
def _(t: Tables):
    def branch(name, details, column):
        full = joins.orders_full(details, t.products(), t.orders(), t.customers())
        totals = full.agg(
            F.count("*").alias("n"), aggregates.money_sum(column).alias("amount")
        )
        return totals.select(F.lit(name).alias("branch"), "*")

    return branch("with details", t.details(), "priceEach").unionByName(
        branch("without details", None, "totalAmount")
    )


# --- Statistics, counts and sums ------------------------------------------------------


@query(
    "amount_stats",
    f"""SELECT {money('"totalAmount"')} AS total, COUNT(*) AS orders,
               {average('"totalAmount"')} AS average, MIN("totalAmount") AS minimum,
               MAX("totalAmount") AS maximum,
               ROUND(stddev_pop("totalAmount"), 4) AS deviation
        FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.amount_stats(t.orders())


@query(
    "order_amount_stats",
    f"""SELECT COUNT("totalAmount") AS order_count, MIN("totalAmount") AS min_amount,
               MAX("totalAmount") AS max_amount, {average('"totalAmount"')} AS avg_amount,
               {money('"totalAmount"')} AS total_revenue
        FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.order_amount_stats(t.orders())


@query(
    "product_price_stats",
    f"""SELECT ROUND(MIN("buyPrice"), 2) AS "min_buyPrice",
               ROUND(MAX("buyPrice"), 2) AS "max_buyPrice",
               {average('"buyPrice"')} AS "avg_buyPrice",
               ROUND(MIN("MSRP"), 2) AS "min_MSRP", ROUND(MAX("MSRP"), 2) AS "max_MSRP",
               {average('"MSRP"')} AS "avg_MSRP"
        FROM products""",
    uses="products",
)
def _(t: Tables):
    return aggregates.product_price_stats(t.products())


@query(
    "product_price_totals",
    f"""SELECT {money('"buyPrice"')} AS "totalBuyPrice",
               {average('"buyPrice"')} AS "avgBuyPrice",
               {money('"MSRP"')} AS "totalMSRP", {average('"MSRP"')} AS "avgMSRP"
        FROM products""",
    uses="products",
)
def _(t: Tables):
    return aggregates.product_price_totals(t.products())


@query(
    "credit_by_segment",
    f"""SELECT "customerSegment", COUNT("creditLimit") AS customers,
               {average('"creditLimit"')} AS avg_credit,
               ROUND(MAX("creditLimit"), 2) AS max_credit
        FROM accounts GROUP BY "customerSegment" """,
    uses="accounts",
)
def _(t: Tables):
    return aggregates.credit_by_segment(t.accounts())


@query(
    "avg_credit_by_segment",
    f"""SELECT "customerSegment", {average('"creditLimit"')} AS avg_credit
        FROM accounts GROUP BY "customerSegment" """,
    uses="accounts",
)
def _(t: Tables):
    return aggregates.avg_credit_by_segment(t.accounts())


def _count_sql(table: str, key: str) -> str:
    return f'SELECT "{key}", COUNT(*) AS n FROM {table} GROUP BY "{key}"'


@query("customers_by_segment", _count_sql("accounts", "customerSegment"), uses="accounts")
def _(t: Tables):
    return aggregates.ranked_counts(t.accounts(), "customerSegment")


@query(
    "top_countries",
    _count_sql("customers", "country") + " ORDER BY n DESC, country LIMIT 10",
    uses="customers",
)
def _(t: Tables):
    return aggregates.top_counts(t.customers(), "country")


@query("orders_by_status", _count_sql("ordered", "status"), uses="ordered")
def _(t: Tables):
    return aggregates.ranked_counts(t.orders(), "status")


@query("orders_by_payment", _count_sql("ordered", "paymentMethod"), uses="ordered")
def _(t: Tables):
    return aggregates.ranked_counts(t.orders(), "paymentMethod")


@query("products_by_category", _count_sql("products", "productCategory"), uses="products")
def _(t: Tables):
    return aggregates.ranked_counts(t.products(), "productCategory")


@query(
    "order_size_distribution",
    """SELECT CASE WHEN "totalAmount" < 50000 THEN 'Small'
                   WHEN "totalAmount" < 250000 THEN 'Medium'
                   ELSE 'Large' END AS "orderSize", COUNT(*) AS n
       FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.order_size_distribution(t.orders(), 50000, 250000)


@query(
    "monthly_revenue",
    f"""SELECT strftime("orderDate", '%Y-%m') AS month,
               {money('"totalAmount"')} AS revenue
        FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.monthly_revenue(t.orders())


@query(
    "orders_by_month",
    """SELECT CAST(month("orderDate") AS INTEGER) AS order_month, COUNT(*) AS n
       FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.orders_by_month(t.orders())


@query(
    "total_per_customer",
    f"""SELECT "customerNumber", {money('"totalAmount"')} AS total
        FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.total_per_customer(t.orders())


@query(
    "largest_totals",
    f"""SELECT "customerNumber", {money('"totalAmount"')} AS total
        FROM ordered GROUP BY 1 ORDER BY total DESC, "customerNumber" LIMIT 5""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.largest_totals(t.orders())


@query(
    "grouped_orders",
    """SELECT "customerNumber", piece,
              string_agg(printf('%.2f', "totalAmount"), ',' ORDER BY "orderNumber")
                AS amounts
       FROM (SELECT *, "orderNumber" // 100000 AS piece FROM ordered)
       GROUP BY "customerNumber", piece""",
    uses="ordered",
)
def _(t: Tables):
    grouped = aggregates.grouped_values(
        t.orders(), "customerNumber", "orderNumber", "totalAmount"
    )
    texts = F.transform("grouped", lambda amount: F.format_string("%.2f", amount))
    return grouped.select(
        "customerNumber", "piece", F.array_join(texts, ",").alias("amounts")
    )


@query(
    "customer_order_stats",
    f"""SELECT "customerNumber", {money('"totalAmount"')} AS total,
               COUNT("totalAmount") AS orders, MIN("totalAmount") AS smallest,
               MAX("totalAmount") AS largest
        FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.customer_order_stats(t.orders())


@query(
    "avg_per_customer",
    f"""SELECT "customerNumber", {average('"totalAmount"')} AS average
        FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.avg_per_customer(t.orders())


@query(
    "revenue_by_status",
    f"""SELECT status, {money('"totalAmount"')} AS revenue FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.revenue_by_status(t.orders())


def _rfm_sql(reference: str) -> str:
    return f"""SELECT "customerNumber",
               CAST(DATE '{reference}' - MAX("orderDate") AS INTEGER) AS recency_days,
               COUNT(*) AS frequency, {money('"totalAmount"')} AS monetary
        FROM ordered GROUP BY 1"""


@query("rfm", _rfm_sql("2001-08-02"), uses="ordered")
def _(t: Tables):
    return aggregates.rfm(t.orders(), REFERENCE_DATE)


@query("rfm_negative_recency", _rfm_sql("2000-01-01"), uses="ordered")
def _(t: Tables):
    return aggregates.rfm(t.orders(), dt.date(2000, 1, 1))


@query(
    "customer_ltv",
    f"""SELECT "customerNumber", {money("revenue")} AS ltv FROM enriched GROUP BY 1""",
    uses="enriched",
)
def _(t: Tables):
    return aggregates.customer_ltv(aggregates.revenue_enrich(t.sales(), t.products()))


@query(
    "top_customers",
    f"""SELECT "customerNumber", {money("revenue")} AS ltv FROM enriched GROUP BY 1
        ORDER BY ltv DESC, "customerNumber" LIMIT 10""",
    uses="enriched",
)
def _(t: Tables):
    return aggregates.top_customers(aggregates.revenue_enrich(t.sales(), t.products()))


@query(
    "product_popularity",
    """SELECT "productCode", CAST(SUM(quantity) AS BIGINT) AS units
       FROM details GROUP BY 1""",
    uses="details",
)
def _(t: Tables):
    return aggregates.product_popularity(t.details())


_CATEGORY_SQL = f"""SELECT p_type AS "productCategory",
        {money("p_retailprice * l_quantity")} AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""


@query("category_revenue", _CATEGORY_SQL)
def _(t: Tables):
    lines = t.details().select("productCode", "quantity")
    return aggregates.category_revenue(aggregates.revenue_enrich(lines, t.products()))


@query("category_revenue_shuffle", _CATEGORY_SQL)
def _(t: Tables):
    return aggregates.category_revenue_shuffle(t.details(), t.products())


@query(
    "revenue_by_product",
    f"""SELECT "productName", {money('"priceEach"')} AS revenue
        FROM orders_full GROUP BY 1""",
    uses="details products ordered customers orders_full",
)
def _(t: Tables):
    return aggregates.revenue_by_product(
        t.details(), t.products(), t.orders(), t.customers()
    )


@query(
    "avg_order_value",
    f"""SELECT {average("v")} AS avg_order_value
        FROM (SELECT {money('"priceEach"')} AS v FROM orders_full GROUP BY "orderNumber")""",
    uses="details products ordered customers orders_full",
)
def _(t: Tables):
    return aggregates.avg_order_value(full_orders(t))


@query(
    "count_by_key",
    """SELECT key, COUNT(*) AS n,
              ROUND(COUNT(*) * 100 / (SELECT COUNT(*) FROM pairs), 4) AS share
       FROM pairs GROUP BY key""",
    uses="pairs",
)
def _(t: Tables):
    return aggregates.count_shares(t.pairs(), "key")


@query(
    "global_reduce",
    """SELECT COUNT(*) AS n, CAST(SUM(value * 2) AS BIGINT) AS total,
              MAX(value * 2) AS largest FROM pairs""",
    uses="pairs",
)
def _(t: Tables):
    doubled = t.pairs().select((F.col("value") * 2).alias("doubled"))
    return aggregates.number_totals(doubled, "doubled")


@query(
    "distinct_values",
    """SELECT DISTINCT 'status' AS column_name, status AS value FROM ordered
       UNION ALL
       SELECT DISTINCT 'paymentMethod', "paymentMethod" FROM ordered""",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.distinct_values(t.orders(), "status", "paymentMethod")


# --- Business questions ---------------------------------------------------------------


@query(
    "top_country_credit",
    f"""SELECT country, {money('"creditLimit"')} AS total_credit_limit
        FROM customers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    uses="customers",
)
def _(t: Tables):
    return aggregates.top_country_credit(t.customers())


@query(
    "most_common_status",
    _count_sql("ordered", "status") + " ORDER BY n DESC, status LIMIT 1",
    uses="ordered",
)
def _(t: Tables):
    return aggregates.most_common(t.orders(), "status")


@query(
    "category_most_stock",
    """SELECT "productCategory", CAST(SUM("quantityInStock") AS BIGINT) AS total_stock
       FROM products GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
    uses="products",
)
def _(t: Tables):
    return aggregates.category_most_stock(t.products())


@query(
    "enterprise_share",
    f"""WITH c AS (SELECT COUNT(*) AS everyone,
                 COUNT(*) FILTER (c_mktsegment = '{SEGMENT}') AS inside FROM customer)
        SELECT 'Total Customers' AS "Metric", CAST(everyone AS DOUBLE) AS "Value" FROM c
        UNION ALL SELECT '{SEGMENT} Customers', CAST(inside AS DOUBLE) FROM c
        UNION ALL SELECT '{SEGMENT} Percentage', ROUND(inside * 100 / everyone, 2) FROM c""",
)
def _(t: Tables):
    return aggregates.segment_share(t.accounts(), SEGMENT)


_SIZES = """SELECT 'Total Customers' AS "Metric", CAST(COUNT(*) AS DOUBLE) AS "Value"
            FROM customer
            UNION ALL SELECT 'Total Products', COUNT(*) FROM part
            UNION ALL SELECT 'Total Orders', COUNT(*) FROM orders"""


@query(
    "business_summary",
    f"""{_SIZES}
        UNION ALL SELECT 'Total Revenue', {money("o_totalprice")} FROM orders
        UNION ALL SELECT 'Average Order Value', {average("o_totalprice")} FROM orders""",
)
def _(t: Tables):
    return aggregates.business_summary(t.accounts(), t.products(), t.orders())


@query(
    "order_line_summary",
    f"""{_SIZES}
        UNION ALL SELECT 'Total Revenue', {money('"priceEach"')} FROM orders_full
        UNION ALL SELECT 'Average Order Value', {average("v")}
        FROM (SELECT {money('"priceEach"')} AS v FROM orders_full GROUP BY "orderNumber")""",
    uses="details products ordered customers orders_full",
)
def _(t: Tables):
    return aggregates.order_line_summary(
        t.details(), t.products(), t.orders(), t.customers()
    )


# --- Data quality ---------------------------------------------------------------------


@query(
    "null_profile",
    """SELECT 'customerNumber' AS column_name, COUNT(*) FILTER (c_custkey IS NULL) AS nulls
       FROM customer
       UNION ALL SELECT 'customerName', COUNT(*) FILTER (c_name IS NULL) FROM customer
       UNION ALL SELECT 'creditLimit', COUNT(*) FILTER (c_acctbal IS NULL) FROM customer
       UNION ALL SELECT 'customerSegment',
                 COUNT(*) FILTER (nullif(c_mktsegment, 'BUILDING') IS NULL)
                 FROM customer""",
)
def _(t: Tables):
    segment = F.nullif(F.col("customerSegment"), F.lit("BUILDING"))
    return quality.null_profile(t.accounts().withColumn("customerSegment", segment))


@query(
    "duplicate_keys",
    """SELECT *, total_rows - distinct_keys AS duplicates FROM (
         SELECT 'customers' AS table_name, 'customerNumber' AS key_name,
                COUNT(*) AS total_rows, COUNT(DISTINCT c_custkey) AS distinct_keys
         FROM customer
         UNION ALL
         SELECT 'orders', 'orderNumber', COUNT(*), COUNT(DISTINCT o_orderkey)
         FROM orders
         UNION ALL
         SELECT 'orderdetails', 'orderNumber', COUNT(*), COUNT(DISTINCT l_orderkey)
         FROM lineitem)""",
)
def _(t: Tables):
    return quality.duplicate_report(
        {
            "customers": (t.accounts(), "customerNumber"),
            "orders": (t.orders(), "orderNumber"),
            "orderdetails": (t.details(), "orderNumber"),
        }
    )


@query(
    "table_counts",
    """SELECT 'customers' AS table_name, COUNT(*) AS total_rows FROM customer
       UNION ALL SELECT 'products', COUNT(*) FROM part
       UNION ALL SELECT 'orders', COUNT(*) FROM orders""",
)
def _(t: Tables):
    return quality.table_counts(
        {"customers": t.accounts(), "products": t.products(), "orders": t.orders()}
    )


def _schema_sql(name: str, view: str) -> str:
    return f"""SELECT '{name}' AS table_name,
               (SELECT COUNT(*) FROM ({view})) AS total_rows,
               CAST(row_number() OVER () AS INTEGER) AS position, column_name,
               CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
                                WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date'
                                ELSE 'string' END AS column_type
        FROM (DESCRIBE {view})"""


@query(
    "schema_profile",
    " UNION ALL ".join(
        [
            _schema_sql("customers", TABLE_SQL["accounts"]),
            _schema_sql("products", TABLE_SQL["products"]),
            _schema_sql("orders", TABLE_SQL["ordered"]),
        ]
    ),
)
def _(t: Tables):
    return quality.schema_profile(
        {"customers": t.accounts(), "products": t.products(), "orders": t.orders()}
    )


# --- Rollups and differences of tables -------------------------------------------------


@query(
    "revenue_rollup",
    """, dated AS (SELECT status, "paymentMethod", strftime("orderDate", '%Y-%m') AS month,
                             CAST(round("totalAmount" * 100) AS BIGINT) AS cents FROM ordered)
       SELECT status, "paymentMethod", month,
              CAST(3 - bit_count(GROUPING(status, "paymentMethod", month)) AS INTEGER) AS level,
              COUNT(*) AS rows, CAST(SUM(cents) AS DOUBLE) / 100 AS revenue,
              CAST((2 * SUM(cents) + COUNT(cents)) // (2 * COUNT(cents)) AS DOUBLE) / 100 AS average
       FROM dated GROUP BY ROLLUP (status, "paymentMethod", month)""",
    uses="ordered",
)
def _(t: Tables):
    dated = t.orders().withColumn("month", F.date_format("orderDate", "yyyy-MM"))
    return aggregates.revenue_rollup(dated, ["status", "paymentMethod", "month"], "totalAmount")


@query(
    "order_snapshot_difference",
    """, first AS (SELECT "customerNumber", status FROM ordered),
            second AS (SELECT "customerNumber", CASE WHEN "orderNumber" % 5 = 0 THEN 'Shipped' ELSE status END
                              AS status FROM ordered WHERE "orderNumber" % 7 <> 0),
            gone AS (SELECT *, COUNT(*) AS n FROM (SELECT * FROM first EXCEPT ALL SELECT * FROM second) GROUP BY ALL),
            came AS (SELECT *, COUNT(*) AS n FROM (SELECT * FROM second EXCEPT ALL SELECT * FROM first) GROUP BY ALL)
       SELECT "customerNumber", status, n AS extra_left, 0::BIGINT AS extra_right FROM gone
       UNION ALL SELECT "customerNumber", status, 0::BIGINT, n FROM came""",
    uses="ordered",
)
def _(t: Tables):
    """What changed between two states of the orders: some gone, some shipped since."""
    first = t.orders().select("customerNumber", "status")
    later = t.orders().where("orderNumber % 7 <> 0").selectExpr(
        "customerNumber", "IF(orderNumber % 5 = 0, 'Shipped', status) AS status"
    )
    return quality.multiset_difference(first, later)
