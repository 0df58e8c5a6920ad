"""Aggregations over customers, products, orders and order lines.

Money is summed exactly (see ``functions.money``). Ties are broken by the key, so
that every run ranks alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyworks.functions.classify import order_size
from tallyworks.functions.money import money_avg, money_sum
from tallyworks.operators.joins import orders_customers, orders_full

# --- Whole-table statistics ---------------------------------------------------


def amount_stats(orders: DataFrame) -> DataFrame:
    """Sum, count, mean, extremes and population deviation of the order amounts."""
    amount = F.col("totalAmount")
    return orders.agg(
        money_sum(amount).alias("total"),
        F.count(amount).alias("orders"),
        money_avg(amount).alias("average"),
        F.min(amount).alias("minimum"),
        F.max(amount).alias("maximum"),
        F.round(F.stddev_pop(amount), 4).alias("deviation"),
    )


def order_amount_stats(orders: DataFrame) -> DataFrame:
    amount = F.col("totalAmount")
    return orders.agg(
        F.count(amount).alias("order_count"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        money_avg(amount).alias("avg_amount"),
        money_sum(amount).alias("total_revenue"),
    )


def product_price_stats(products: DataFrame) -> DataFrame:
    columns: list[Column] = []
    for price in ("buyPrice", "MSRP"):
        columns += [
            F.round(F.min(price), 2).alias(f"min_{price}"),
            F.round(F.max(price), 2).alias(f"max_{price}"),
            money_avg(price).alias(f"avg_{price}"),
        ]
    return products.agg(*columns)


def product_price_totals(products: DataFrame) -> DataFrame:
    return products.agg(
        money_sum("buyPrice").alias("totalBuyPrice"),
        money_avg("buyPrice").alias("avgBuyPrice"),
        money_sum("MSRP").alias("totalMSRP"),
        money_avg("MSRP").alias("avgMSRP"),
    )


def number_totals(df: DataFrame, value: str) -> DataFrame:
    """Count, sum and largest of a whole-number column."""
    return df.agg(
        F.count(value).alias("n"),
        F.sum(value).alias("total"),
        F.max(value).alias("largest"),
    )


# --- Counts and sums by group ---------------------------------------------------


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def ranked_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Group counts, largest first."""
    return count_by(df, *keys).orderBy(F.desc("n"), *keys)


def top_counts(df: DataFrame, key: str, count: int = 10) -> DataFrame:
    return ranked_counts(df, key).limit(count)


def count_shares(df: DataFrame, key: str) -> DataFrame:
    """Rows per key with their share of all rows in percent, largest first.

    The total is taken from the counts, whose shuffle Spark makes only once.
    """
    counts = count_by(df, key)
    total = counts.agg(F.sum("n")).scalar()
    share = F.round(F.col("n") * 100 / total, 4)
    return counts.withColumn("share", share).orderBy(F.desc("n"), key)


def credit_by_segment(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("customerSegment")
        .agg(
            F.count("creditLimit").alias("customers"),
            money_avg("creditLimit").alias("avg_credit"),
            F.round(F.max("creditLimit"), 2).alias("max_credit"),
        )
        .orderBy(F.desc("avg_credit"), "customerSegment")
    )


def avg_credit_by_segment(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customerSegment").agg(
        money_avg("creditLimit").alias("avg_credit")
    )


def order_size_distribution(
    orders: DataFrame, small: float = 1000, medium: float = 5000
) -> DataFrame:
    size = order_size(F.col("totalAmount"), small, medium)
    return count_by(orders.select(size.alias("orderSize")), "orderSize").orderBy(
        "orderSize"
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    """Revenue by year and month; the label is formatted once per group."""
    return (
        orders.groupBy(F.trunc("orderDate", "MM").alias("first_day"))
        .agg(money_sum("totalAmount").alias("revenue"))
        .select(F.date_format("first_day", "yyyy-MM").alias("month"), "revenue")
        .orderBy("month")
    )


def orders_by_month(orders: DataFrame) -> DataFrame:
    """Orders by month number, all years together."""
    return (
        orders.groupBy(F.month("orderDate").alias("order_month"))
        .agg(F.count("*").alias("n"))
        .orderBy("order_month")
    )


def total_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customerNumber").agg(money_sum("totalAmount").alias("total"))


def largest_totals(orders: DataFrame, count: int = 5) -> DataFrame:
    return (
        total_per_customer(orders)
        .orderBy(F.desc("total"), "customerNumber")
        .limit(count)
    )


def grouped_values(
    df: DataFrame,
    key: str,
    position: str,
    value: str,
    *,
    span: int = 100_000,
) -> DataFrame:
    """The values of each key as lists, ordered by ``position``.

    ``position`` is a whole number. A list covers ``span`` consecutive positions, numbered by
    ``piece``, whatever the size of the key. Rows of a key that share a position go into further
    ``layer``s, one of them in each; rows without a position share a layer by ``span``. So no list
    ever holds more than ``span`` values.
    """
    alike = Window.partitionBy(key, position).orderBy(value)
    number = F.row_number().over(alike) - 1
    layer = F.when(F.col(position).isNull(), F.floor(number / span)).otherwise(number)
    piece = F.floor(F.col(position) / span)
    return (
        df.select(key, position, value)
        .withColumn("layer", layer.cast("bigint"))
        .groupBy(key, piece.cast("bigint").alias("piece"), "layer")
        .agg(F.array_sort(F.collect_list(F.struct(position, value))).alias("pairs"))
        .select(key, "piece", "layer", F.col(f"pairs.{value}").alias("grouped"))
    )


def customer_order_stats(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customerNumber").agg(
        money_sum("totalAmount").alias("total"),
        F.count("totalAmount").alias("orders"),
        F.min("totalAmount").alias("smallest"),
        F.max("totalAmount").alias("largest"),
    )


def avg_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customerNumber").agg(
        money_avg("totalAmount").alias("average")
    )


def revenue_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(money_sum("totalAmount").alias("revenue"))


def rfm(orders: DataFrame, reference: dt.date = dt.date(2024, 12, 1)) -> DataFrame:
    """Recency, frequency and monetary value of each customer.

    Recency is negative for a customer whose last order is after the reference date.
    """
    last = F.max("orderDate")
    return orders.groupBy("customerNumber").agg(
        F.datediff(F.lit(reference), last).alias("recency_days"),
        F.count("*").alias("frequency"),
        money_sum("totalAmount").alias("monetary"),
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of each column, from one scan."""
    texts = df.select(*[F.col(name).cast("string").alias(name) for name in columns])
    return texts.unpivot([], list(columns), "column_name", "value").distinct()


# --- Sales: order lines and products ---------------------------------------------


def revenue_enrich(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Add category and revenue (catalogue price times quantity) to every line."""
    catalogue = products.select("productCode", "productCategory", "buyPrice")
    return (
        sales.join(catalogue, "productCode")
        .withColumn("revenue", F.col("buyPrice") * F.col("quantity"))
        .drop("buyPrice")
    )


def category_revenue(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("productCategory").agg(money_sum("revenue").alias("revenue"))


def category_revenue_shuffle(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue by category with both sides shuffled, for any size of catalogue.

    Quantities, which may have fractions, are added up by product first, on the map side
    too: a hot product reaches the join as one row.
    """
    quantities = sales.groupBy("productCode").agg(money_sum("quantity").alias("quantity"))
    catalogue = products.select("productCode", "productCategory", "buyPrice")
    priced = quantities.hint("merge").join(catalogue, "productCode")
    revenue = F.col("buyPrice") * F.col("quantity")
    return priced.groupBy("productCategory").agg(money_sum(revenue).alias("revenue"))


def customer_ltv(enriched: DataFrame) -> DataFrame:
    """Lifetime value: revenue by customer."""
    return enriched.groupBy("customerNumber").agg(money_sum("revenue").alias("ltv"))


def top_customers(enriched: DataFrame, count: int = 10) -> DataFrame:
    return (
        customer_ltv(enriched).orderBy(F.desc("ltv"), "customerNumber").limit(count)
    )


def product_popularity(sales: DataFrame) -> DataFrame:
    return sales.groupBy("productCode").agg(
        F.sum("quantity").cast("bigint").alias("units")
    )


def revenue_by_product(
    details: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    price: str = "priceEach",
) -> DataFrame:
    """Revenue by product name over complete orders, largest first.

    Sums ``price`` alone; quantity plays no part. The lines are added up by product
    code before the products join, so a hot product arrives there as one row.
    """
    complete = orders_customers(orders, customers).select("orderNumber")
    by_code = (
        details.select("orderNumber", "productCode", price)
        .join(complete, "orderNumber")
        .groupBy("productCode")
        .agg(money_sum(price).alias("revenue"))
    )
    return (
        by_code.join(products.select("productCode", "productName"), "productCode")
        .groupBy("productName")
        .agg(money_sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "productName")
    )


def order_values(full: DataFrame, price: str = "priceEach") -> DataFrame:
    return full.groupBy("orderNumber").agg(money_sum(price).alias("value"))


def avg_order_value(full: DataFrame, price: str = "priceEach") -> DataFrame:
    """Mean over orders of the sum of their lines."""
    return order_values(full, price).agg(money_avg("value").alias("avg_order_value"))


# --- Business questions -----------------------------------------------------------


def top_country_credit(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("country")
        .agg(money_sum("creditLimit").alias("total_credit_limit"))
        .orderBy(F.desc("total_credit_limit"), "country")
        .limit(1)
    )


def most_common(df: DataFrame, key: str) -> DataFrame:
    return top_counts(df, key, 1)


def category_most_stock(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("productCategory")
        .agg(F.sum("quantityInStock").alias("total_stock"))
        .orderBy(F.desc("total_stock"), "productCategory")
        .limit(1)
    )


def _metrics(totals: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row of totals turned into Metric / Value rows."""
    doubles = totals.select(
        *[F.col(column).cast("double").alias(label) for column, label in names.items()]
    )
    return doubles.unpivot([], list(names.values()), "Metric", "Value")


def segment_share(customers: DataFrame, segment: str = "Enterprise") -> DataFrame:
    """Customers in all, customers of the segment, and their percentage."""
    inside = F.count_if(F.col("customerSegment") == segment)
    everyone = F.count("*")
    totals = customers.agg(
        everyone.alias("everyone"),
        inside.alias("inside"),
        F.round(F.try_divide(inside * 100, everyone), 2).alias("percentage"),
    )
    return _metrics(
        totals,
        {
            "everyone": "Total Customers",
            "inside": f"{segment} Customers",
            "percentage": f"{segment} Percentage",
        },
    )


def _row_metric(df: DataFrame, name: str) -> DataFrame:
    return _metrics(df.agg(F.count("*").alias("n")), {"n": name})


def business_summary(
    customers: DataFrame, products: DataFrame, orders: DataFrame
) -> DataFrame:
    """Table sizes, revenue and average order, as Metric / Value rows."""
    order_totals = orders.agg(
        F.count("*").alias("n"),
        money_sum("totalAmount").alias("revenue"),
        money_avg("totalAmount").alias("average"),
    )
    names = {
        "n": "Total Orders",
        "revenue": "Total Revenue",
        "average": "Average Order Value",
    }
    return (
        _row_metric(customers, "Total Customers")
        .unionByName(_row_metric(products, "Total Products"))
        .unionByName(_metrics(order_totals, names))
    )


def order_line_summary(
    details: DataFrame | None,
    products: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Table sizes, with revenue and average order value where there are order lines."""
    summary = (
        _row_metric(customers, "Total Customers")
        .unionByName(_row_metric(products, "Total Products"))
        .unionByName(_row_metric(orders, "Total Orders"))
    )
    if details is None:
        return summary
    full = orders_full(details, products, orders, customers)
    totals = order_values(full).agg(
        money_sum("value").alias("revenue"), money_avg("value").alias("average")
    )
    names = {"revenue": "Total Revenue", "average": "Average Order Value"}
    return summary.unionByName(_metrics(totals, names))


def revenue_rollup(df: DataFrame, levels: Sequence[str], amount: str) -> DataFrame:
    """Rows, revenue and average by ``levels`` and by each shorter run of them, down to the total.

    The table is grouped once by all levels, as whole cents; the coarser results are sums of that
    small result. ``level`` is the number of levels a row is grouped by, which tells a total from a
    group whose value is NULL. The average is to the cent. Amounts are taken to the cent, halves away from zero;
    NaN and infinities count as rows, not as amounts of money.
    """
    cents = F.round(F.col(amount) * 100).try_cast("decimal(38,0)")
    finest = df.groupBy(*levels).agg(
        F.count("*").alias("_rows"), F.sum(cents).alias("_cents"), F.count(cents).alias("_amounts")
    )
    # Every level that is rolled up sets one bit.
    grouped = F.lit(len(levels)) - F.bit_count(F.grouping_id())
    rolled = finest.rollup(*levels).agg(
        grouped.cast("int").alias("level"),
        F.sum("_rows").alias("rows"),
        F.sum("_cents").alias("_total"),
        F.sum("_amounts").alias("_all"),
    )
    count = F.when(F.col("_all") > 0, F.col("_all"))
    nearest = F.call_function("div", F.abs("_total") * 2 + count, count * 2)
    return rolled.select(
        *levels,
        "level",
        "rows",
        (F.col("_total").cast("double") / 100).alias("revenue"),
        (F.signum("_total") * nearest / 100).alias("average"),
    )
