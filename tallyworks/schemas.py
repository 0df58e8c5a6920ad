"""Explicit schemas of the input tables; nothing is inferred unless asked for."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


CUSTOMERS = _schema(
    customerNumber=IntegerType,
    customerName=StringType,
    contactFirstName=StringType,
    contactLastName=StringType,
    phone=StringType,
    addressLine1=StringType,
    city=StringType,
    state=StringType,
    country=StringType,
    creditLimit=DoubleType,
    customerSegment=StringType,
)

PRODUCTS = _schema(
    productCode=StringType,
    productName=StringType,
    productCategory=StringType,
    quantityInStock=IntegerType,
    buyPrice=DoubleType,
    MSRP=DoubleType,
)

ORDERS = _schema(
    orderNumber=LongType,
    orderDate=DateType,
    requiredDate=DateType,
    status=StringType,
    customerNumber=LongType,
    totalAmount=DoubleType,
    paymentMethod=StringType,
)

METRICS = _schema(Metric=StringType, Value=DoubleType)

STATUS_DESCRIPTIONS = _schema(status=StringType, status_desc=StringType)

PAYMENT_METHODS = _schema(o_orderpriority=StringType, method=StringType)

# The given tables that the queries read.
GIVEN = {
    "nation": _schema(n_nationkey=IntegerType, n_name=StringType, n_regionkey=IntegerType),
    "customer": _schema(
        c_custkey=LongType,
        c_name=StringType,
        c_nationkey=IntegerType,
        c_acctbal=DoubleType,
        c_mktsegment=StringType,
    ),
    "part": _schema(
        p_partkey=LongType,
        p_name=StringType,
        p_brand=StringType,
        p_type=StringType,
        p_size=IntegerType,
        p_retailprice=DoubleType,
    ),
    "orders": _schema(
        o_orderkey=LongType,
        o_custkey=LongType,
        o_orderstatus=StringType,
        o_totalprice=DoubleType,
        o_orderdate=TimestampNTZType,
        o_orderpriority=StringType,
    ),
    "lineitem": _schema(
        l_orderkey=LongType,
        l_partkey=LongType,
        l_suppkey=LongType,
        l_linenumber=IntegerType,
        l_quantity=DoubleType,
        l_extendedprice=DoubleType,
        l_discount=DoubleType,
        l_tax=DoubleType,
        l_returnflag=StringType,
        l_linestatus=StringType,
        l_shipdate=TimestampNTZType,
    ),
    "events": _schema(
        event_id=LongType,
        ts=TimestampNTZType,
        user_id=LongType,
        event_type=StringType,
        value=DoubleType,
        props=StringType,
    ),
    "documents": _schema(
        doc_id=LongType,
        text=StringType,
        lang=StringType,
        source=StringType,
        n_chars=LongType,
    ),
}
