"""Repeated affine steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of one step: (x * 1.1 + 0.5) / 1.05
GAIN, SHIFT, DIVISOR = 1.1, 0.5, 1.05

# Steps that one call of the lambda takes; a call costs more than a step.
_UNROLLED = 20


def _steps(value: Column, count: int) -> Column:
    for _ in range(count):
        value = (value * GAIN + SHIFT) / DIVISOR
    return value


def affine_steps(x: Column, steps: int = 1000) -> Column:
    """Apply ``(x * 1.1 + 0.5) / 1.05`` to every row ``steps`` times, step by step."""
    calls, rest = divmod(steps, _UNROLLED)
    value = x.cast("double")
    if calls:
        value = F.aggregate(
            F.sequence(F.lit(1), F.lit(calls)),
            value,
            lambda value, _: _steps(value, _UNROLLED),
        )
    return _steps(value, rest)
