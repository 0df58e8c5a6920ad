"""CSV in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyworks.functions.once import once

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    header: bool = True,
    mode: str = "PERMISSIVE",
    date_format: str | None = None,
) -> DataFrame:
    """Typed CSV scan. Without a schema the types are inferred, at the cost of a pass.

    ``date_format`` is the pattern of dates; one that does not fit it is malformed. ``mode`` says what a malformed line does: NULL fields, a dropped line
    (``DROPMALFORMED``) or a failed job (``FAILFAST``). ``parse_checked`` keeps them.
    """
    reader = spark.read.option("header", header).option("mode", mode)
    if date_format is not None:
        reader = reader.option("dateFormat", date_format)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def canonical_orders(orders: DataFrame) -> DataFrame:
    """Some writers call the order total ``amount``; here it is ``totalAmount``."""
    return orders.withColumnRenamed("amount", "totalAmount")


def parse_checked(
    lines: DataFrame,
    schema: StructType,
    *,
    header: str | None = None,
    date_format: str | None = None,
) -> DataFrame:
    """CSV lines (column ``value``) as typed fields, malformed lines kept whole.

    Lines equal to the header are dropped wherever they stand. A malformed line has
    NULL in every field and its text in ``_corrupt_record``.
    """
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if date_format is not None:
        options["dateFormat"] = date_format
    if header is not None:
        lines = lines.where(F.col("value") != header)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide)
    parsed = F.from_csv(F.col("value"), columns, options)
    rows = lines.select(once(parsed).alias("row")).select("row.*")
    good = F.col(CORRUPT).isNull()
    return rows.select(
        *[F.when(good, F.col(name)).alias(name) for name in schema.names], CORRUPT
    )


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the text of the bad lines."""
    good = checked.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = checked.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def write_csv(df: DataFrame, path: str, *, header: bool = True) -> None:
    """One file per partition of ``df``; suited to any size."""
    df.write.mode("overwrite").option("header", header).csv(path)


def write_report(df: DataFrame, path: str, *, header: bool = True) -> None:
    """Write few files: one for a report, even if empty, and more as the rows grow.

    The rebalance hint sizes the files at run time, and unlike ``coalesce`` it leaves
    the work before the write as parallel as it was.
    """
    write_csv(df.hint("rebalance"), path, header=header)


def merge_parts(
    spark: SparkSession,
    parts: str,
    path: str,
    schema: StructType,
    *,
    header: bool = False,
) -> None:
    """Merge a folder of part files into few files; empty parts add nothing."""
    write_report(read_csv(spark, parts, schema, header=header), path, header=header)
