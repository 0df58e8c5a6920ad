"""Sums of money held in double columns that lose nothing.

A plain double sum depends on the order in which rows arrive. Casting every row to a decimal is
exact but costs about ten times as much. Here amounts of whole cents, in reach of a long, are
added up as two long sums, of the high and the low bits: exact, order-free, and too wide to
overflow. All other amounts (fractions of a cent, very large ones, NaN, infinities) go into a
double sum beside it, so they count as Spark's own sum would count them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 20
# Largest amount taken as whole cents, and how far (in cents) a double may be off them: the
# rounding of a product or two, never a real fraction.
_LARGEST = float(2**52) / 100
_SLACK, _RELATIVE_SLACK = 1e-7, 1e-13


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _whole_cents(amount: Column) -> Column:
    """Whole cents as a long; NULL for any other amount."""
    scaled = amount.cast("double") * 100
    nearest = F.rint(scaled)
    slack = F.abs(amount) * _RELATIVE_SLACK + _SLACK
    # NaN is larger than every number, so it fails the first test.
    whole = (F.abs(amount) <= _LARGEST) & (F.abs(scaled - nearest) <= slack)
    return F.when(whole, nearest.cast("bigint"))


def _cent_total(value: Column) -> Column:
    high = F.sum(F.shiftright(value, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(value.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    return high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low


def _rest(amount: Column, value: Column) -> Column:
    """Sum of the amounts that are not whole cents; NULL if there are none."""
    return F.sum(F.when(value.isNull(), amount.cast("double")))


def money_sum(amount: Column | str) -> Column:
    """Sum of amounts; for whole cents the same double whatever the row order.

    NULL if there is no amount; NaN and infinities as in a sum of doubles.
    """
    amount = _column(amount)
    value = _whole_cents(amount)
    whole = _cent_total(value).cast("double") / 100
    rest = _rest(amount, value)
    return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)


def money_avg(amount: Column | str) -> Column:
    """Average of the non-NULL amounts to the cent, halves rounded away from zero.

    Divided in whole numbers where all are whole cents: rounding a double quotient goes either
    way at a half.
    """
    amount = _column(amount)
    value = _whole_cents(amount)
    total = _cent_total(value)
    rest = _rest(amount, value)
    rows = F.count(amount)
    rows = F.when(rows > 0, rows)
    nearest = F.call_function("div", F.abs(total) * 2 + rows, rows * 2)
    exact = F.signum(total) * nearest / 100
    mixed = F.coalesce(total.cast("double") / 100, F.lit(0.0)) + rest
    return F.when(rest.isNull(), exact).otherwise(F.round(mixed / rows, 2))
