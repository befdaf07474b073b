"""Rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_to(c: Column | str, digits: int) -> Column:
    """Scale, round half to even, scale back: what array libraries do.

    ``F.round`` rounds half up on the decimal text of the value instead. Adding
    zero turns a negative zero into zero.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.rint(x * 10.0**digits) / 10.0**digits + 0.0
