"""Bucket numbers for placing rows, and salts for splitting hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_prefix(key: Column) -> Column:
    return F.split_part(key, F.lit("_"), F.lit(1))


def range_bucket(key: Column, upper_bounds: Sequence[int]) -> Column:
    """0 for keys up to the first bound, 1 up to the second, ...; the rest go last."""
    bounds = F.lit(list(upper_bounds)) if upper_bounds else F.array().cast("array<bigint>")
    size = len(upper_bounds)
    # A binary search: how many bounds are below the key.
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(max(1, size.bit_length()))),
        F.struct(F.lit(0).alias("low"), F.lit(size).alias("high")),
        lambda range_, _: _halved(range_, bounds, key),
        lambda range_: range_["low"],
    )
    return F.when(key.isNull(), size).otherwise(found)


def _halved(range_: Column, bounds: Column, key: Column) -> Column:
    low, high = range_["low"], range_["high"]
    middle = F.floor((low + high) / 2).cast("int")
    above = F.get(bounds, middle) < key
    return F.when(low >= high, range_).otherwise(
        F.struct(
            F.when(above, middle + 1).otherwise(low).alias("low"),
            F.when(above, high).otherwise(middle).alias("high"),
        )
    )


def named_bucket(name: Column, numbers: Mapping[str, int], default: int) -> Column:
    """Bucket looked up by name; unknown and NULL names get ``default``."""
    if not numbers:
        return F.lit(default)
    table = F.create_map(*(F.lit(part) for pair in numbers.items() for part in pair))
    return F.coalesce(F.try_element_at(table, name), F.lit(default))


def modulo_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(key, F.lit(buckets)).cast("int")


def suffix_number(key: Column) -> Column:
    """Number after the last underscore of a text key; NULL if there is none."""
    return F.try_element_at(F.split(key, "_"), F.lit(-1)).try_cast("bigint")


def md5_bucket(key: Column, buckets: int) -> Column:
    """The 128-bit MD5 of the key, taken as one number, modulo ``buckets``.

    The digest is read as four 32-bit digits and reduced digit by digit, so that
    every intermediate value fits a long.
    """
    digest = F.md5(key.cast("string"))
    remainder = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        digit = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        remainder = F.pmod(remainder * (1 << 32) + digit, F.lit(buckets))
    return remainder.cast("int")


def row_salt(salts: int | Column, *row_id: Column | str) -> Column:
    """A salt that follows from the row itself, so a rerun task gives the same one."""
    count = F.lit(salts) if isinstance(salts, int) else salts
    return F.pmod(F.xxhash64(*row_id), count).cast("int")
