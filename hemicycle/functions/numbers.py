"""Number helpers that round alike on every engine: through decimals, half up."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def r2(c: Column) -> Column:
    return F.round(c.cast("decimal(20,8)"), 2).cast("double")


def term(c: Column) -> Column:
    """A summand whose sum doesn't depend on the order of addition."""
    return F.round(c.cast("decimal(20,8)"), 6).cast("decimal(18,6)")


def micros(c: Column) -> Column:
    """``term`` of a double in whole millionths, whose sums are of longs. Decimals, which are slow, are asked only
    where the eighth place is too near a half, or the number too large, for a double to tell."""
    y = c * 1e8
    eighth = F.floor(y + 0.5)
    sure = (F.abs(y) < 2.0**40) & (F.abs(y - F.floor(y) - 0.5) > 1e-3)
    up = F.when(eighth < 0, -F.floor((50 - eighth) / 100)).otherwise(F.floor((eighth + 50) / 100))
    return F.when(sure, up).otherwise((term(c) * 1_000_000).cast("long"))


def of_micros(total: Column) -> Column:
    return (total.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast("decimal(28,6)")
