"""The three standing views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillspan.functions.dates import month_of
from tillspan.functions.numbers import ratio, zero_if_null
from tillspan.functions.pricing import discount_pct, final_price
from tillspan.operators.common import add_place, category_names, not_void
from tillspan.sources.statuses import VOID
from tillspan.sources.tables import Retail


def product_summary(t: Retail) -> DataFrame:
    """Every product with final price, stock label and approved ratings."""
    ratings = t.reviews.filter("approved").groupBy("product_id").agg(
        F.sum("rating").alias("rated"), F.count(F.lit(1)).alias("n")
    )
    price, promo, stock = F.col("price"), F.col("promo_price"), F.col("stock")
    return (
        t.products.join(category_names(t), "category_id")
        .join(ratings, "product_id", "left")
        .select(
            "product_id", "sku", "name", "category", "price", "promo_price",
            discount_pct(price, promo).alias("discount_pct"),
            final_price(price, promo).alias("final_price"),
            "stock", "stock_min",
            F.when(stock == 0, "Out of stock")
            .when(stock <= F.col("stock_min"), "Low stock")
            .otherwise("Available")
            .alias("stock_status"),
            "active", "featured",
            zero_if_null(ratio(F.col("rated"), F.col("n"), 2)).alias("avg_rating"),
            zero_if_null(F.col("n")).alias("n_reviews"),
        )
    )


def order_summary(t: Retail) -> DataFrame:
    """Every order with buyer, state, payment method, place of delivery and number of items."""
    counts = t.order_items.groupBy("order_id").agg(F.count("item_id").alias("n"))
    buyers = t.customers.select(
        "customer_id", F.col("name").alias("customer"), F.col("email").alias("customer_email")
    )
    statuses = t.order_status.select("status_id", F.col("name").alias("status"))
    methods = t.payment_methods.select("method_id", F.col("name").alias("payment_method"))
    addresses = t.addresses.select("address_id", "city_id")
    placed = add_place(
        t.orders.join(statuses, "status_id").join(methods, "method_id").join(addresses, "address_id"), t
    )
    return (
        placed.join(buyers, "customer_id")
        .join(counts, "order_id", "left")
        .select(
            "order_id", "order_no", "customer", "customer_email", "status", "payment_method", "subtotal",
            "discount", "freight", "total", "instalments", "order_ts", "delivery_ts",
            zero_if_null(F.col("n")).alias("n_items"),
            F.concat("city", F.lit("/"), "state").alias("delivery_city"),
        )
    )


def monthly_sales(t: Retail) -> DataFrame:
    """Orders, buyers and amounts per month, without cancelled and refunded orders."""
    sums = ("total", "discount", "freight")
    return (
        not_void(t.orders, t, VOID)
        .groupBy(month_of(F.col("order_ts")).alias("month"), "customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), *[F.sum(c).alias(c) for c in sums])
        .groupBy("month")
        .agg(
            F.sum("orders").alias("orders"),
            F.count("customer_id").alias("customers"),
            *[F.sum(c).cast(DecimalType(30, 2)).alias(c) for c in sums],
        )
        .select(
            "month", "orders", "customers",
            F.col("total").alias("revenue"),
            ratio(F.col("total"), F.col("orders"), 2).alias("avg_order"),
            F.col("discount").alias("discounts"),
            "freight",
        )
        .orderBy(F.col("month").desc())
    )
