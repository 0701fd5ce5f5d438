"""Order-independent sums of two-decimal amounts.

Sums of doubles depend on the order tasks finish in. Whole cents add up exactly, in plain long arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """A two-decimal amount as whole cents."""
    return F.floor(amount * F.lit(100) + F.lit(0.5)).cast("long")


def from_cents(total: Column) -> Column:
    return total.cast("double") / F.lit(100.0)


def money_sum(amount: Column) -> Column:
    """Exact sum of two-decimal amounts, as a double."""
    return from_cents(F.sum(cents(amount)))
