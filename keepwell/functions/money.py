"""Money arrives as double and is summed as whole cents.

Long addition is exact, independent of row order and stays in generated code,
where a wide decimal buffer would not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("long")


def from_cents(total: Column) -> Column:
    return total / F.lit(100.0)


def guarded_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def money_text(amount: Column) -> Column:
    """Two decimals, never in scientific notation."""
    return amount.cast("decimal(18,2)").cast("string")
