"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules["tallyworks.llm"])

# Rows handed to a Python worker at once; a batch of ordinary texts is a few megabytes,
# one of long texts ends where it has so many bytes.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

# A longer text is worked on in pieces of about this many bytes.
PIECE_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def documents(spark: SparkSession, data_dir: str, *columns: str) -> DataFrame:
    """Columns of the documents table, with settings fit for whole texts in Arrow batches."""
    return table(spark, data_dir, "documents", *columns)


def table(spark: SparkSession, data_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, with the settings that the operators expect."""
    text_settings(spark)
    found = spark.read.parquet(f"{data_dir}/{name}.parquet")
    return found.select(*columns) if columns else found


def text_settings(spark: SparkSession) -> None:
    """Settings fit for whole texts: small Arrow batches, splitting of hot keys, UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """An object that this Python worker keeps for its later tasks: a cache, a tokenizer.

    A worker keeps one object; when it is asked for another, the one before goes.
    """
    kept = sys.modules.setdefault("_tallyworks_kept", types.ModuleType("_tallyworks_kept"))
    store = kept.__dict__
    if store.get("key") != key:
        if store.pop("value", None) is not None:
            return_memory()
        store["value"] = make()
        store["key"] = key
        # What was read and parsed to make it.
        return_memory()
    return store["value"]


def return_memory() -> None:
    """Give memory that this process has freed back to the system, where it can be."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def utf8_texts(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; NULL as an empty text."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text cut at white space into pieces of about ``size`` bytes; no word is cut."""
    start = 0
    while len(text) - start > size:
        gap = _SPACE.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.end()
    yield text[start:] if start else text


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of a value as text, modulo ``divisor``; NULL counts as an empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(divisor))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def with_fields(schema: StructType, fields: str) -> StructType:
    """A schema with more fields, written as in DDL, at its end."""
    return StructType([*schema.fields, *StructType.fromDDL(fields).fields])
