"""Money helpers: exact, order-independent sums.

A double sum depends on the order in which partitions arrive. Amounts are therefore summed as integer
millionths of a euro: exact, associative, and as cheap as a long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000


def micros(amount: Column) -> Column:
    """Amount in millionths; NULL stays NULL. Beyond what a long can hold the value is NULL."""
    return F.bround(amount * F.lit(float(MICRO))).try_cast("bigint")


def euros(total: Column) -> Column:
    return total.cast("double") / F.lit(float(MICRO))


def cents(amount: Column) -> Column:
    return F.bround(amount * F.lit(100.0)).try_cast("bigint")


def money(value: Column) -> Column:
    """Two-decimal display value."""
    return F.round(value, 2)


def eur_text(value: Column) -> Column:
    return F.concat(F.lit("EUR "), F.format_number(F.coalesce(value, F.lit(0.0)), 2))
