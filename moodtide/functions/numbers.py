"""Rounding as in numpy: scale, round half to even, scale back."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_even(c: Column | str, places: int) -> Column:
    """Ties go to the even digit; the added zero keeps -0.0 out of results."""
    value = F.col(c) if isinstance(c, str) else c
    factor = F.lit(float(10**places))
    return F.rint(value * factor) / factor + F.lit(0.0)
