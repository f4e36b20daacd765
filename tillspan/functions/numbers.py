"""Money and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(12, 2)
WIDE = DecimalType(38, 10)


def money(value: Column) -> Column:
    return value.cast(MONEY)


def rounded(value: Column, digits: int) -> Column:
    """Round half away from zero. Rounding is done on decimals, never on doubles."""
    return F.round(value.cast(WIDE), digits).cast(DecimalType(18, digits))


def ratio(num: Column, den: Column, digits: int, times: int = 1) -> Column:
    """num / den * times, NULL where den is 0 or NULL."""
    quotient = num.cast("double") / F.nullif(den, F.lit(0)).cast("double")
    if times != 1:
        quotient = quotient * F.lit(float(times))
    return rounded(quotient, digits)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
