"""Queries on partition placement, skewed keys and shared frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.functions.buckets import (
    key_prefix,
    md5_bucket,
    modulo_bucket,
    named_bucket,
    range_bucket,
    suffix_number,
)
from tallyworks.operators import caching, placement, skew
from tallyworks.operators.aggregates import total_per_customer
from tallyworks.plans.registry import query
from tallyworks.plans.retail_queries import money
from tallyworks.plans.tables import Tables

# Named buckets of these queries; a name that is missing here goes to the default.
SEGMENT_BUCKETS = {"AUTOMOBILE": 0, "BUILDING": 1, "HOUSEHOLD": 2, "MACHINERY": 3}
PRIORITY_BUCKETS = {"HIGH": 0, "MED": 1, "LOW": 2}

_MD5_SQL = """CAST(((((('0x' || substr(md5(k), 1, 8))::BIGINT % 4
        * 4294967296 + ('0x' || substr(md5(k), 9, 8))::BIGINT) % 4)
        * 4294967296 + ('0x' || substr(md5(k), 17, 8))::BIGINT) % 4
        * 4294967296 + ('0x' || substr(md5(k), 25, 8))::BIGINT) % 4 AS INTEGER)"""


def _amounts(t: Tables) -> DataFrame:
    return t.orders().select("orderNumber", "customerNumber", "totalAmount")


def _by_number(df: DataFrame, partitions: int) -> placement.Placed:
    bucket = modulo_bucket(F.col("orderNumber"), partitions)
    return placement.place(df, bucket, partitions)


@query(
    "partition_profile",
    """SELECT CAST("orderNumber" % 4 AS INTEGER) AS "partition", COUNT(*) AS n
       FROM ordered GROUP BY 1""",
    uses="ordered",
)
def _(t: Tables):
    return placement.partition_rows(_by_number(_amounts(t), 4))


@query(
    "partition_sums",
    """SELECT CAST("orderNumber" % 3 AS INTEGER) AS "partition",
              CAST(SUM(value) AS BIGINT) AS total
       FROM pairs GROUP BY 1""",
    uses="pairs",
)
def _(t: Tables):
    placed = _by_number(t.pairs().drop("key"), 3)
    return placement.partition_sums(placed, "value")


@query(
    "partition_contents",
    """SELECT CAST("orderNumber" % 3 AS INTEGER) AS "partition",
              "orderNumber" // 100000 AS piece,
              string_agg(CAST("orderNumber" AS VARCHAR), ',' ORDER BY "orderNumber")
                AS items
       FROM ordered GROUP BY 1, 2""",
    uses="ordered",
)
def _(t: Tables):
    placed = _by_number(t.orders().select("orderNumber"), 3)
    contents = placement.partition_contents(placed, "orderNumber")
    texts = F.col("items").cast("array<string>")
    return contents.withColumn("items", F.array_join(texts, ","))


@query(
    "partition_top_key",
    """SELECT "partition", CAST(SUM(n) AS BIGINT) AS n,
              arg_min(k, (-n, k)) AS top_key, MAX(n) AS top_n
       FROM (SELECT CAST("orderNumber" % 8 AS INTEGER) AS "partition", key AS k,
                    COUNT(*) AS n FROM pairs GROUP BY 1, 2)
       GROUP BY 1""",
    uses="pairs",
)
def _(t: Tables):
    placed = _by_number(t.pairs().drop("value"), 8)
    return placement.partition_top_key(placed, "key")


# Up to eight partitions and down to two.
@query(
    "repartition_coalesce",
    f"""SELECT step, CAST(partitions AS BIGINT) AS partitions, n, total FROM
          (SELECT COUNT(*) AS n, {money('"totalAmount"')} AS total FROM ordered),
          (VALUES ('up', 8), ('down', 2)) AS s(step, partitions)""",
    uses="ordered",
)
def _(t: Tables):
    orders = _amounts(t)
    more = orders.repartition(8, "orderNumber")
    fewer = more.coalesce(2)
    return placement.partition_count(more, "up", "totalAmount").unionByName(
        placement.partition_count(fewer, "down", "totalAmount")
    )


def _bucket_sql(bucket: str, key: str, value: str, table: str) -> str:
    return f"""SELECT {bucket} AS "partition", COUNT(*) AS n,
               COUNT(DISTINCT {key}) AS keys, {money(value)} AS total
        FROM {table} GROUP BY 1"""


def _totals(t: Tables, bucket, partitions: int) -> DataFrame:
    placed = placement.place(_amounts(t), bucket, partitions)
    return placement.partition_totals(placed, F.col("customerNumber"), "totalAmount")


@query(
    "range_partition",
    _bucket_sql(
        """CASE WHEN "customerNumber" <= 500 THEN 0
                WHEN "customerNumber" <= 1000 THEN 1 ELSE 2 END""",
        '"customerNumber"',
        '"totalAmount"',
        "ordered",
    ),
    uses="ordered",
)
def _(t: Tables):
    return _totals(t, range_bucket(F.col("customerNumber"), [500, 1000]), 3)


@query(
    "modulo_partition",
    _bucket_sql(
        'CAST("customerNumber" % 4 AS INTEGER)',
        '"customerNumber"',
        '"totalAmount"',
        "ordered",
    ),
    uses="ordered",
)
def _(t: Tables):
    return _totals(t, modulo_bucket(F.col("customerNumber"), 4), 4)


@query(
    "md5_partition",
    _bucket_sql(
        _MD5_SQL,
        "k",
        '"totalAmount"',
        '(SELECT CAST("customerNumber" AS VARCHAR) AS k, "totalAmount" FROM ordered)',
    ),
    uses="ordered",
)
def _(t: Tables):
    return _totals(t, md5_bucket(F.col("customerNumber"), 4), 4)


# Keys such as HOUSEHOLD_17. One segment is not named and goes to partition 0.
@query(
    "geo_partition",
    _bucket_sql(
        """CASE "customerSegment" WHEN 'BUILDING' THEN 1 WHEN 'HOUSEHOLD' THEN 2
                                  WHEN 'MACHINERY' THEN 3 ELSE 0 END""",
        '"customerSegment"',
        '"creditLimit"',
        "accounts",
    ),
    uses="accounts",
)
def _(t: Tables):
    key = F.concat_ws("_", "customerSegment", F.col("customerNumber").cast("string"))
    keyed = t.accounts().select(key.alias("key"), "creditLimit")
    bucket = named_bucket(key_prefix(F.col("key")), SEGMENT_BUCKETS, 0)
    placed = placement.place(keyed, bucket, 4)
    return placement.partition_totals(placed, key_prefix(F.col("key")), "creditLimit")


@query(
    "suffix_partition",
    _bucket_sql(
        'CAST("customerNumber" % 4 AS INTEGER)',
        '"customerSegment"',
        '"creditLimit"',
        "accounts",
    ),
    uses="accounts",
)
def _(t: Tables):
    key = F.concat_ws("_", "customerSegment", F.col("customerNumber").cast("string"))
    keyed = t.accounts().select(key.alias("key"), "creditLimit")
    bucket = modulo_bucket(suffix_number(F.col("key")), 4)
    placed = placement.place(keyed, bucket, 4)
    return placement.partition_totals(placed, key_prefix(F.col("key")), "creditLimit")


@query(
    "priority_partition",
    f"""SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0
                    WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 2 END AS "partition",
               COUNT(*) AS n,
               COUNT(DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH'
                              WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END) AS keys,
               {money("o_totalprice")} AS total
        FROM orders GROUP BY 1""",
)
def _(t: Tables):
    priority = F.col("o_orderpriority")
    name = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "HIGH")
        .when(priority == "3-MEDIUM", "MED")
        .when(priority == "4-NOT SPECIFIED", "LOW")
        .otherwise("NONE")
    )
    key = F.concat_ws("_", name, F.col("o_orderkey").cast("string"))
    keyed = t.raw("orders").select(key.alias("key"), F.col("o_totalprice").alias("value"))
    bucket = named_bucket(key_prefix(F.col("key")), PRIORITY_BUCKETS, 2)
    placed = placement.place(keyed, bucket, 3)
    return placement.partition_totals(placed, key_prefix(F.col("key")), "value")


@query(
    "agg_after_partition",
    f"""SELECT scheme, "customerNumber", total FROM
          (SELECT "customerNumber", {money('"totalAmount"')} AS total
           FROM ordered GROUP BY 1),
          (VALUES ('default'), ('range'), ('modulo'), ('md5')) AS s(scheme)""",
    uses="ordered",
)
def _(t: Tables):
    customer = F.col("customerNumber")
    buckets = {
        "range": (range_bucket(customer, [500, 1000]), 3),
        "modulo": (modulo_bucket(customer, 4), 4),
        "md5": (md5_bucket(customer, 4), 4),
    }
    frames = {"default": _amounts(t)}
    for name, (bucket, partitions) in buckets.items():
        placed = placement.place(_amounts(t), bucket, partitions)
        frames[name] = placed.rows
    return reduce(
        DataFrame.unionByName,
        [
            total_per_customer(frame).select(F.lit(name).alias("scheme"), "*")
            for name, frame in frames.items()
        ],
    )


# --- Skewed keys ----------------------------------------------------------------------


@query(
    "salt_keys",
    """SELECT CASE WHEN key = 'popular_key'
                   THEN key || '_salt_' || CAST(("orderNumber" // 10 + "lineNumber") % 10
                                                AS VARCHAR)
                   ELSE key END AS salted_key, COUNT(*) AS n
       FROM pairs GROUP BY 1""",
    uses="pairs",
)
def _(t: Tables):
    salt = F.floor(F.col("orderNumber") / 10) + F.col("lineNumber")
    salted = skew.salt_keys(t.pairs(), "key", ("popular_key",), 10, salt)
    return skew.salted_key_counts(salted, "key")


_DOUBLED_SQL = """SELECT key, CAST(SUM(value * 2) AS BIGINT) AS total
                  FROM pairs GROUP BY key"""


@query("salted_sum", _DOUBLED_SQL, uses="pairs")
def _(t: Tables):
    row_id = ("orderNumber", "lineNumber")
    return skew.salted_sum(t.pairs(), "key", F.col("value") * 2, row_id)


@query("skew_sum", _DOUBLED_SQL, uses="pairs")
def _(t: Tables):
    return skew.key_sum(t.pairs(), "key", F.col("value") * 2)


@query(
    "skew_report",
    """SELECT key, COUNT(*) AS n, COUNT(*) / (SELECT COUNT(*) FROM pairs) AS share
       FROM pairs GROUP BY key HAVING share >= 0.01""",
    uses="pairs",
)
def _(t: Tables):
    return skew.hot_keys(t.pairs(), "key", 0.01)


# --- Shared frames --------------------------------------------------------------------


@query(
    "cached_multi_agg",
    """SELECT 'count' AS measure, COUNT(*) AS value FROM pairs
       UNION ALL SELECT 'sum', CAST(SUM(value) AS BIGINT) FROM pairs
       UNION ALL SELECT 'max', MAX(value) FROM pairs""",
    uses="pairs",
)
def _(t: Tables):
    return caching.cached_totals(t.pairs(), "value")


@query(
    "persist_levels",
    """SELECT level, n, total, largest FROM
         (SELECT COUNT(*) AS n, CAST(SUM(value) AS BIGINT) AS total,
                 MAX(value) AS largest FROM pairs),
         (VALUES ('MEMORY_ONLY'), ('MEMORY_AND_DISK'), ('MEMORY_AND_DISK_DESER'),
                 ('DISK_ONLY')) AS l(level)""",
    uses="pairs",
)
def _(t: Tables):
    return caching.totals_by_level(t.pairs(), "value")


@query(
    "shared_enrichment",
    f"""SELECT 'customer_ltv' AS metric, CAST("customerNumber" AS VARCHAR) AS key,
               {money("revenue")} AS value FROM enriched GROUP BY 2
        UNION ALL
        SELECT 'product_popularity', CAST("productCode" AS VARCHAR), SUM(quantity)
        FROM enriched GROUP BY 2
        UNION ALL
        SELECT 'category_revenue', "productCategory", {money("revenue")}
        FROM enriched GROUP BY 2""",
    uses="enriched",
)
def _(t: Tables):
    return caching.shared_enrichment(t.sales(), t.products())


# The numbers grow to about 1e24, so their logarithms are compared.
@query(
    "clean_enrich",
    """WITH e AS (
         SELECT list_reduce(
                  list_prepend(CAST(x AS DOUBLE),
                               list_transform(range(1000), lambda i: CAST(0 AS DOUBLE))),
                  lambda a, z: (a * CAST(1.1 AS DOUBLE) + CAST(0.5 AS DOUBLE))
                               / CAST(1.05 AS DOUBLE) + z) AS y
         FROM (SELECT c_custkey * 2 AS x FROM customer) WHERE x % 3 <> 0)
       SELECT point AS cache_point, COUNT(*) AS n, ROUND(log10(SUM(y)), 9) AS log10_total,
              ROUND(log10(MAX(y)), 9) AS log10_largest
       FROM e, (VALUES ('none'), ('cleaned'), ('enriched'), ('both')) AS p(point)
       GROUP BY point""",
)
def _(t: Tables):
    parts = []
    for point in caching.CACHE_POINTS:
        totals = caching.clean_enrich(t.accounts(), "customerNumber", point)
        parts.append(
            totals.select(
                F.lit(point).alias("cache_point"),
                "n",
                F.round(F.log10("total"), 9).alias("log10_total"),
                F.round(F.log10("largest"), 9).alias("log10_largest"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
