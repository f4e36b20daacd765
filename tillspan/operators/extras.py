"""Reports the documents name but no script defines; the definitions are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillspan.functions.numbers import ratio, zero_if_null
from tillspan.operators.common import add_place, category_names, count_when, status_ids
from tillspan.sources.statuses import AWAITING
from tillspan.sources.tables import Retail


def stock_by_category_franchise(t: Retail) -> DataFrame:
    """Active products: how many, how many low or out of stock, units and value in stock."""
    stock = F.col("stock")
    return (
        t.products.filter("active")
        .groupBy("category_id", "franchise")
        .agg(
            F.count(F.lit(1)).alias("products"),
            count_when(stock <= F.col("stock_min")).alias("low_stock"),
            count_when(stock == 0).alias("out_of_stock"),
            F.sum("stock").alias("units"),
            F.sum(stock * F.col("price")).cast(DecimalType(28, 2)).alias("stock_value"),
        )
        .join(category_names(t), "category_id")
        .select("category", "franchise", "products", "low_stock", "out_of_stock", "units", "stock_value")
    )


def pending_orders_by_region(t: Retail) -> DataFrame:
    """Orders awaiting payment per region and state. Orders are counted per address before they are placed."""
    waiting = (
        t.orders.join(status_ids(t, AWAITING), "status_id", "left_semi")
        .groupBy("address_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("value"), F.min("order_ts").alias("oldest"))
    )
    placed = add_place(waiting.join(t.addresses.select("address_id", "city_id"), "address_id"), t)
    return placed.groupBy("region", "state").agg(
        F.sum("n").alias("orders"),
        F.sum("value").cast(DecimalType(28, 2)).alias("value"),
        F.min("oldest").alias("oldest_order"),
    )


def _sales_by_product(t: Retail) -> DataFrame:
    return t.order_items.groupBy("product_id").agg(
        F.sum("qty").alias("units"), F.sum("subtotal").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )


def category_performance(t: Retail) -> DataFrame:
    """Units, revenue and margin per category; cost is the present cost of the product."""
    sales = (
        t.products.select("product_id", "category_id", "cost")
        .join(_sales_by_product(t), "product_id")
        .groupBy("category_id")
        .agg(
            F.sum("units").alias("units"),
            F.sum("revenue").cast(DecimalType(28, 2)).alias("revenue"),
            F.sum(F.col("units") * zero_if_null(F.col("cost"))).cast(DecimalType(28, 2)).alias("cost"),
        )
    )
    margin = F.col("revenue") - F.col("cost")
    return sales.join(category_names(t), "category_id").select(
        "category", "units", "revenue", "cost",
        margin.alias("margin"),
        ratio(margin, F.col("revenue"), 2, times=100).alias("margin_pct"),
    )


def top_rated_products(t: Retail, min_reviews: int = 1, limit: int = 20) -> DataFrame:
    """Products by mean approved rating, then number of reviews."""
    ratings = (
        t.reviews.filter("approved")
        .groupBy("product_id")
        .agg(F.sum("rating").alias("rated"), F.count(F.lit(1)).alias("n_reviews"))
        .filter(F.col("n_reviews") >= min_reviews)
        .withColumn("avg_rating", ratio(F.col("rated"), F.col("n_reviews"), 2))
    )
    best = [F.col("avg_rating").desc(), F.col("n_reviews").desc()]
    # Ties need the rank of the whole list; it is taken after the cut, which keeps the leading rows.
    listed = (
        t.products.select("product_id", F.col("name").alias("product"), "category_id")
        .join(ratings, "product_id")
        .orderBy(*best, "product_id")
        .limit(limit)
        .withColumn("rating_rank", F.rank().over(Window.orderBy(*best)))
    )
    return listed.join(category_names(t), "category_id").select(
        "product_id", "product", "category", "avg_rating", "n_reviews", "rating_rank"
    )


def product_rank_in_category(t: Retail) -> DataFrame:
    """Rank of every sold product by revenue inside its category.

    A category may hold most of the catalogue, so no window runs over a whole category. Products are counted
    per (category, revenue), then per band of revenue; the bands above and the values above inside the band
    add up to the rank.
    """
    sold = t.products.select("product_id", F.col("name").alias("product"), "category_id").join(
        _sales_by_product(t), "product_id"
    )
    band = F.floor(F.log2(F.greatest(F.col("revenue"), F.lit(1)).cast("double")) * 64)
    values = (
        # Units are never NULL here; counting them keeps the sums per product one shuffle for both uses of `sold`.
        sold.groupBy("category_id", "revenue").agg(F.count("units").alias("n")).withColumn("_band", band)
    )
    bands = values.groupBy("category_id", "_band").agg(F.sum("n").alias("n"))
    higher_bands = Window.partitionBy("category_id").orderBy(F.col("_band").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    higher_values = Window.partitionBy("category_id", "_band").orderBy(F.col("revenue").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    above = bands.select("category_id", "_band", zero_if_null(F.sum("n").over(higher_bands)).alias("_above"))
    ranks = (
        values.withColumn("_inside", zero_if_null(F.sum("n").over(higher_values)))
        .join(above, ["category_id", "_band"])
        .select("category_id", "revenue", (F.col("_above") + F.col("_inside") + 1).alias("category_rank"))
    )
    return (
        sold.join(ranks, ["category_id", "revenue"])
        .join(category_names(t), "category_id")
        .select(
            "category", "product_id", "product", F.col("units").alias("units_sold"), "revenue", "category_rank"
        )
    )


def franchise_sales(t: Retail, min_total: float = 0) -> DataFrame:
    """Sales per franchise that reach a total."""
    return (
        t.products.filter("franchise is not null")
        .select("product_id", "franchise")
        .join(_sales_by_product(t), "product_id")
        .groupBy("franchise")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.sum("units").alias("units"),
            F.sum("revenue").cast(DecimalType(28, 2)).alias("revenue"),
        )
        .filter(F.col("revenue") >= min_total)
    )


def reviews_per_product(t: Retail) -> DataFrame:
    """Every review with the number of reviews of its product; counted by aggregate, not by a window per product."""
    counts = t.reviews.groupBy("product_id").agg(F.count(F.lit(1)).alias("product_reviews"))
    return t.reviews.select("review_id", "product_id", "customer_id", "rating").join(counts, "product_id").select(
        "review_id", "product_id", "customer_id", "rating", "product_reviews"
    )


def customers_by_level(t: Retail) -> DataFrame:
    """Active customers per level with their orders and spending."""
    spent = t.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("spent"))
    return (
        t.customers.filter("active")
        .select("customer_id", "level", "xp")
        .join(spent, "customer_id", "left")
        .groupBy("level")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("xp").alias("xp"),
            zero_if_null(F.sum("n")).alias("orders"),
            zero_if_null(F.sum("spent")).cast(DecimalType(28, 2)).alias("spent"),
        )
        .withColumn("avg_spent", ratio(F.col("spent"), F.col("customers"), 2))
    )
