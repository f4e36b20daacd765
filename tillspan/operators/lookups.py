"""Parameterised tables: customer statistics, top products, daily revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillspan.functions.dates import DateLike, day_after
from tillspan.functions.numbers import ratio, zero_if_null
from tillspan.operators.common import category_names, most_frequent, status_ids
from tillspan.sources.statuses import VOID
from tillspan.sources.tables import Retail, in_period


def customer_stats(t: Retail) -> DataFrame:
    """One row per customer with orders: totals, most frequent state, favourite franchise (ties by name)."""
    by_status = t.orders.groupBy("customer_id", "status_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total").alias("spent"),
        F.min("order_ts").alias("first"),
        F.max("order_ts").alias("last"),
    )
    names = t.order_status.select("status_id", F.col("name").alias("status"))
    totals = by_status.join(names, "status_id", "left").groupBy("customer_id").agg(
        F.sum("n").alias("orders"),
        F.sum("spent").cast(DecimalType(28, 2)).alias("spent"),
        F.min("first").cast("date").alias("first_order"),
        F.max("last").cast("date").alias("last_order"),
        most_frequent("n", "status").alias("usual_status"),
    )
    favourite = (
        t.order_items.select("order_id", "product_id")
        .join(t.orders.select("order_id", "customer_id"), "order_id")
        .join(t.products.filter("franchise is not null").select("product_id", "franchise"), "product_id")
        .groupBy("customer_id", "franchise")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("customer_id")
        .agg(most_frequent("n", "franchise").alias("favourite_franchise"))
    )
    return (
        totals.join(t.customers.select("customer_id", "level", "xp"), "customer_id")
        .join(favourite, "customer_id", "left")
        .select(
            "customer_id", "orders", F.col("spent").alias("total_spent"),
            ratio(F.col("spent"), F.col("orders"), 2).alias("avg_order"),
            "first_order", "last_order", "usual_status", "level", "xp", "favourite_franchise",
        )
    )


def top_products(
    t: Retail, category_id: int | None = None, franchise: str | None = None, limit: int = 10
) -> DataFrame:
    """Active products by units sold, unsold ones last; a parameter left out does not filter."""
    goods = t.products.filter("active")
    if category_id is not None:
        goods = goods.filter(F.col("category_id") == category_id)
    if franchise is not None:
        goods = goods.filter(F.col("franchise") == franchise)
    sales = t.order_items.groupBy("product_id").agg(
        F.sum("qty").alias("units"), F.sum("subtotal").alias("sales")
    )
    return (
        goods.select("product_id", F.col("name").alias("product"), "category_id", "franchise")
        .join(category_names(t), "category_id")
        .join(sales, "product_id", "left")
        .orderBy(F.col("units").desc_nulls_last(), "product_id")
        .limit(limit)
        .select(
            "product_id", "product", "category", "franchise",
            zero_if_null(F.col("units")).alias("units_sold"),
            zero_if_null(F.col("sales")).alias("revenue"),
        )
    )


def daily_revenue(t: Retail, start: DateLike, end: DateLike) -> DataFrame:
    """Amounts per day from `start` to `end`, both included, without cancelled and refunded orders."""
    kept = in_period(t.orders, "order_ts", start, day_after(end)).join(
        status_ids(t, *VOID), "status_id", "left_anti"
    )
    return (
        kept.groupBy(F.col("order_ts").cast("date").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("subtotal").alias("gross"),
            F.sum("discount").alias("discounts"),
            F.sum("freight").alias("freight"),
            F.sum("total").alias("net"),
        )
        .orderBy("day")
    )
