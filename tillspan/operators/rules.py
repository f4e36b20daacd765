"""Row rules as jobs over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspan.functions.dates import DateLike, age_on, date_lit
from tillspan.functions.numbers import money, zero_if_null
from tillspan.functions.pricing import coupon_amount, discount_pct, final_price, freight
from tillspan.functions.text import clean_email, fold_accents, format_tax_id, is_email
from tillspan.plans.joins import left_lookup


def clean_customers(customers: DataFrame, as_of: DateLike) -> DataFrame:
    """Customers with a tidy e-mail, its validity, the formatted tax id, an accent-free name and the age."""
    email = clean_email(F.col("email"))
    return customers.select(
        "customer_id", "name",
        fold_accents(F.col("name")).alias("plain_name"),
        email.alias("email"),
        is_email(email).alias("email_valid"),
        format_tax_id(F.col("tax_id")).alias("tax_id"),
        age_on(F.col("birth_date"), as_of).alias("age"),
    )


def price_list(products: DataFrame) -> DataFrame:
    """What each product costs now, and the discount that is."""
    price, promo = F.col("price"), F.col("promo_price")
    return products.select(
        "product_id", "sku", "name", "price", "promo_price",
        final_price(price, promo).alias("final_price"),
        discount_pct(price, promo).alias("discount_pct"),
    )


def check_availability(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Whether the stock of an active product covers the quantity of each line; false for unknown products."""
    stocks = products.filter("active").select("product_id", "stock")
    return (
        lines.join(stocks, "product_id", "left")
        .withColumn("available", F.coalesce(F.col("stock") >= F.col("qty"), F.lit(False)))
        .select(*lines.columns, "available")
    )


def quote_freight(requests: DataFrame) -> DataFrame:
    """Freight by postcode, value and weight; a missing weight counts as one kilogram."""
    weight = F.coalesce(F.col("weight_kg"), F.lit(1))
    return requests.withColumn("freight", freight(F.col("postcode"), F.col("value"), weight))


def usable_coupons(coupons: DataFrame, as_of: DateLike) -> DataFrame:
    """Active coupons in their dates and below their cap."""
    below_cap = F.col("max_uses").isNull() | (zero_if_null(F.col("used")) < F.col("max_uses"))
    in_dates = date_lit(as_of).between(F.col("starts"), F.col("ends"))
    return coupons.filter(F.col("active") & in_dates & below_cap)


def apply_coupons(orders: DataFrame, coupons: DataFrame, as_of: DateLike) -> DataFrame:
    """The discount each order's coupon gives on its subtotal, 0 without a usable coupon.

    The franchise and category limits a coupon may carry are not enforced.
    """
    usable = usable_coupons(coupons, as_of).select(
        F.col("code").alias("_code"), "kind", F.col("value").alias("_amount"), "min_order"
    )
    coded = orders.withColumn("_code", F.upper("coupon_code"))
    joined = left_lookup(coded, "_code", usable, spread_by="order_id")
    cut = coupon_amount(F.col("kind"), F.col("_amount"), F.col("min_order"), F.col("subtotal"))
    return joined.select(
        *orders.columns, F.when(F.col("kind").isNull(), money(F.lit(0))).otherwise(cut).alias("coupon_discount")
    )
