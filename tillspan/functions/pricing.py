"""Price, freight and coupon rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillspan.functions.numbers import money, ratio

# Base freight by first postcode digit, the fallback, the price per kilogram,
# and the order value from which freight is free.
FREIGHT_BASE = {
    "0": "25.00",
    "1": "25.00",
    "2": "30.00",
    "3": "30.00",
    "4": "35.00",
    "5": "40.00",
    "6": "45.00",
    "7": "50.00",
    "8": "35.00",
    "9": "40.00",
}
FREIGHT_OTHER = "40.00"
FREIGHT_PER_KG = 2
FREE_FREIGHT_FROM = "299.00"

PERCENT = "PERCENT"
FIXED = "FIXED"


def final_price(price: Column, promo_price: Column) -> Column:
    return F.coalesce(promo_price, price)


def discount_pct(price: Column, promo_price: Column) -> Column:
    no_discount = promo_price.isNull() | (price == 0)
    return F.when(no_discount, F.lit(0).cast(DecimalType(18, 2))).otherwise(
        ratio(price - promo_price, price, 2, times=100)
    )


def freight(postcode: Column, value: Column, weight_kg: Column) -> Column:
    digit = F.substring(postcode, 1, 1)
    base = F.lit(FREIGHT_OTHER)
    for key, amount in FREIGHT_BASE.items():
        base = F.when(digit == key, F.lit(amount)).otherwise(base)
    charged = money(F.round(base.cast(DecimalType(12, 2)) + weight_kg * FREIGHT_PER_KG, 2))
    return F.when(value >= F.lit(FREE_FREIGHT_FROM).cast(DecimalType(12, 2)), money(F.lit(0))).otherwise(charged)


def coupon_amount(kind: Column, amount: Column, min_order: Column, value: Column) -> Column:
    """What a usable coupon takes off an order value; 0 below the minimum, never more than the value.

    A missing minimum turns nothing away, as an unknown comparison does not.
    """
    percent = F.round(value * amount / 100, 2)
    cut = money(F.when(kind == PERCENT, percent).otherwise(amount))
    below = F.coalesce(value < min_order, F.lit(False))
    return F.when(below, money(F.lit(0))).otherwise(F.least(cut, value))
