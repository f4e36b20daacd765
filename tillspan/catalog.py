"""Every operator as a named query over one set of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, ShortType, TimestampNTZType, TimestampType

from tillspan.operators import extras, jobs, lookups, matching, quality, reports, rules, views
from tillspan.operators.checkout import Checkout, checkout
from tillspan.operators.common import order_keys
from tillspan.functions.dates import instant
from tillspan.plans.lineage import run_dir
from tillspan.plans.session import size_merging
from tillspan.sources.star import AS_OF, star_retail, star_streams
from tillspan.sources.tables import (
    MONTH,
    Retail,
    analyze_table,
    bucketed_tables,
    column_statistics,
    in_period,
    load_tables,
    replace_folders,
    with_month,
    write_table,
)
from tillspan.streaming.changes import ChangeLog, stream_change_log
from tillspan.streaming.revenue import stream_daily_revenue
from tillspan.streaming.run import drained, state_partitions
from tillspan.streaming.stock import state_store, stream_low_stock

SINCE = "1998-01-01"
COHORTS_SINCE = "1996-01-01"
ARCHIVED_BEFORE = "2000-06-01"
CORRECTED_MONTH = "1998-02"
BUCKETS = 8


def present(df: DataFrame) -> DataFrame:
    """Plain result types for comparison with another engine: bigint, double, string, boolean."""

    def plain(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, IntegerType | ShortType):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, TimestampNTZType | TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema.fields])


def _checkout(t: Retail) -> Checkout:
    return checkout(t.checkout_requests, t.carts, t.products, t.addresses, t.coupons, t.order_status)


def _status_changes(t: Retail) -> jobs.StatusChanges:
    return jobs.apply_status_changes(t.status_requests, t.orders, t.order_items, t.order_status)


def _deletes(t: Retail) -> jobs.DeletePlan:
    return jobs.plan_deletes(
        t.customers.select("customer_id"), t.customers, t.orders, t.addresses, t.reviews, t.carts
    )


def _archived(t: Retail) -> jobs.DeletePlan:
    """Who could go if everything before a day were archived."""
    recent = {name: in_period(getattr(t, name), ts, ARCHIVED_BEFORE) for name, ts in (("orders", "order_ts"), ("reviews", "created_at"), ("carts", "created_at"))}
    return jobs.plan_deletes(t.customers.select("customer_id"), t.customers, recent["orders"], t.addresses, recent["reviews"], recent["carts"])


# Nullable columns the derived tables leave empty in part; checked as if they were required.
ALSO_REQUIRED = {
    "customers": ["tax_id"],
    "products": ["franchise"],
    "orders": ["coupon_code", "payment_ts"],
    "order_items": ["unit_discount"],
    "carts": ["customer_id"],
    "coupons": ["max_uses"],
}

COUNTED = (
    "customers", "products", "addresses", "orders", "order_items", "reviews", "categories", "states", "cities",
    "carts", "coupons", "payment_methods", "order_status",
)

ITEM_SEQUENCE = ("item_id", "qty", "unit_price", "unit_discount", "subtotal")

# Queries over one set of tables.
ON_TABLES: dict[str, Callable[[Retail], DataFrame]] = {
    "r01_sales_detail": lambda t: reports.sales_detail(t, "1997-01-01", "1998-01-01"),
    "r02_best_sellers": lambda t: reports.best_sellers(t),
    "r03_vip_customers": lambda t: reports.vip_customers(t, AS_OF),
    "r04_region_category_revenue": lambda t: reports.region_category_revenue(t),
    "r04b_region_category_rollup": lambda t: reports.region_category_rollup(t),
    "r05_cart_conversion": lambda t: reports.cart_conversion(t),
    "r06_monthly_trend": lambda t: reports.monthly_trend(t, SINCE),
    "r06b_monthly_trend_order_grain": lambda t: reports.monthly_trend_order_grain(t, SINCE),
    "r07_payment_performance": lambda t: reports.payment_performance(t),
    "r08_cohort_retention": lambda t: reports.cohort_retention(t, COHORTS_SINCE),
    "r08b_cohort_matrix": lambda t: reports.cohort_matrix(t, COHORTS_SINCE),
    "r09_stockout_forecast": lambda t: reports.stockout_forecast(t, AS_OF),
    "r10_executive_dashboard": lambda t: reports.executive_dashboard(t, AS_OF),
    "r10b_dashboard_long": lambda t: reports.dashboard_long(t, AS_OF),
    "v01_product_summary": lambda t: views.product_summary(t),
    "v02_order_summary": lambda t: views.order_summary(t),
    "v03_monthly_sales": lambda t: views.monthly_sales(t),
    "t01_customer_stats": lambda t: lookups.customer_stats(t),
    "t02_top_products": lambda t: lookups.top_products(t),
    "t02_top_products_franchise": lambda t: lookups.top_products(t, franchise="Brand#12"),
    "t03_daily_revenue": lambda t: lookups.daily_revenue(t, "1995-01-01", AS_OF),
    "c01_clean_customers": lambda t: rules.clean_customers(t.customers, AS_OF),
    "c02_price_list": lambda t: rules.price_list(t.products),
    "c03_check_availability": lambda t: rules.check_availability(t.carts, t.products),
    "c04_quote_freight": lambda t: rules.quote_freight(t.freight_requests),
    "c05_apply_coupons": lambda t: rules.apply_coupons(t.orders, t.coupons, AS_OF).select(
        "order_id", "coupon_code", "subtotal", "coupon_discount"
    ),
    "j01_checkout_orders": lambda t: _checkout(t).orders,
    "j01_checkout_items": lambda t: _checkout(t).items,
    "j01_checkout_stock_deltas": lambda t: _checkout(t).stock_deltas,
    "j01_checkout_coupon_use": lambda t: _checkout(t).coupon_use,
    "j01_checkout_history": lambda t: _checkout(t).history,
    "j01_checkout_carts": lambda t: _checkout(t).carts,
    "j01_checkout_rejects": lambda t: _checkout(t).rejects,
    "j02_status_orders": lambda t: _status_changes(t).orders.select(
        "order_id", "status_id", "payment_ts", "shipping_ts", "delivery_ts"
    ),
    "j02_status_history": lambda t: _status_changes(t).history,
    "j02_status_restock": lambda t: _status_changes(t).restock,
    "j02_status_rejects": lambda t: _status_changes(t).rejects,
    "j03_upsert_cart_lines": lambda t: jobs.upsert_cart(t.cart_adds, t.carts, t.products).carts,
    "j03_upsert_cart_rejects": lambda t: jobs.upsert_cart(t.cart_adds, t.carts, t.products).rejects,
    "j04_replenish_products": lambda t: jobs.replenish(t.replenish_requests, t.products).products.select(
        "product_id", "stock", "updated_at"
    ),
    "j04_replenish_audit": lambda t: jobs.replenish(t.replenish_requests, t.products).audit,
    "j04_replenish_rejects": lambda t: jobs.replenish(t.replenish_requests, t.products).rejects,
    "j05_change_log": lambda t: jobs.change_log(
        t.products_old, t.products_new, "product_id", "products", ignore=("updated_at",)
    ),
    "j06_low_stock_alerts": lambda t: jobs.low_stock_alerts(t.products_old, t.products_new),
    "j07_item_subtotals": lambda t: jobs.item_subtotals(t.order_items),
    "j08_plan_deletes_customers": lambda t: _deletes(t).customers.select("customer_id", "name"),
    "j08_plan_deletes_addresses": lambda t: _deletes(t).addresses.select("address_id", "customer_id"),
    "j08_plan_deletes_refusals": lambda t: _deletes(t).refusals,
    "j08_archived_customers": lambda t: _archived(t).customers.select("customer_id", "name"),
    "j08_archived_addresses": lambda t: _archived(t).addresses.select("address_id", "customer_id"),
    "j08_archived_refusals": lambda t: _archived(t).refusals,
    "j09_stamp_updates": lambda t: jobs.stamp_updates(t.products_old, t.products_new, "product_id", instant(AS_OF)),
    "j10_merge_items": lambda t: jobs.merge_items(t.order_items, ITEM_SEQUENCE),
    "j11_dedupe_reviews": lambda t: jobs.dedupe_reviews(t.review_submissions).select(
        "review_id", "product_id", "customer_id", "rating", "approved", "created_at"
    ),
    "j12_backfill_status_history": lambda t: jobs.backfill_status_history(t.orders),
    "j13_assign_delivery_address": lambda t: jobs.assign_delivery_address(t.orders, t.addresses).select(
        "order_id", "customer_id", "address_id"
    ),
    "d01_check_unique": lambda t: quality.all_unique(t),
    "d02_check_references": lambda t: quality.all_references(t),
    "d03_check_rules": lambda t: quality.all_rules(t),
    "d04_check_required": lambda t: quality.all_required(t, ALSO_REQUIRED),
    "d05_table_counts": lambda t: quality.table_counts(t, COUNTED),
    "l04_name_matches": lambda t: matching.name_matches(t.products, t.products, 0.4),
    "l04_name_matches_customers": lambda t: matching.name_matches(t.customers, t.customers, 0.9),
    "x01_stock_by_category_franchise": lambda t: extras.stock_by_category_franchise(t),
    "x02_pending_orders_by_region": lambda t: extras.pending_orders_by_region(t),
    "x03_category_performance": lambda t: extras.category_performance(t),
    "x04_top_rated_products": lambda t: extras.top_rated_products(t),
    "x05_product_rank_in_category": lambda t: extras.product_rank_in_category(t),
    "x06_franchise_sales": lambda t: extras.franchise_sales(t, 1_000_000),
    "x07_reviews_per_product": lambda t: extras.reviews_per_product(t),
    "x08_customers_by_level": lambda t: extras.customers_by_level(t),
}


# Streaming queries, and the round trip through files, need the session and the folder, not only the tables.
def _stream_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "daily-revenue")
    stream = stream_daily_revenue(star_streams(spark, sf_dir).orders, star_retail(spark, sf_dir).order_status)
    with state_partitions(spark, spark.sparkContext.defaultParallelism):
        return drained(stream, f"{out}/result", f"{out}/checkpoint")


def _stream_low_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "low-stock")
    stream = stream_low_stock(star_streams(spark, sf_dir).stock_deltas, star_retail(spark, sf_dir).products)
    with state_store(spark), state_partitions(spark, spark.sparkContext.defaultParallelism):
        return drained(stream, f"{out}/result", f"{out}/checkpoint")


def _stream_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "change-log")
    old = star_retail(spark, sf_dir).products_old
    log = ChangeLog(out, old.schema, "product_id", "products", ignore=("updated_at",))
    log.start(old)
    entries = stream_change_log(star_streams(spark, sf_dir).product_feed, log, f"{out}/checkpoint")
    return entries.drop("batch")


def _write_and_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = run_dir(spark, "shop")
    write_table(star_retail(spark, sf_dir).orders, out, "orders")
    stored = load_tables(spark, out, ["orders"]).orders
    return in_period(stored, "order_ts", "1996-01-15", "2001-01-15").select(
        "order_id", "order_no", "customer_id", "status_id", "total", "coupon_code", "order_ts", "payment_ts", MONTH
    )


def _items_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by month: written, one month corrected in place, and read for a period of their orders."""
    out, star = run_dir(spark, "shop"), star_retail(spark, sf_dir)
    write_table(star.orders, out, "orders")
    write_table(with_month(star.order_items, star.orders), out, "order_items")
    written = load_tables(spark, out, ["order_items"]).order_items
    replace_folders(written.filter((F.col(MONTH) == CORRECTED_MONTH) & (F.col("qty") > 10)), out, "order_items")
    t = load_tables(spark, out, ["orders", "order_items"])
    sold = in_period(t.orders, "order_ts", "1997-12-10", "1998-04-20").select(*order_keys(t), "order_ts")
    return t.order_items.join(sold, order_keys(t)).select("item_id", "order_id", "product_id", "qty", "subtotal", MONTH, "order_ts")


def _bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value of the items of every order beside its total, from tables in buckets of the order."""
    star = star_retail(spark, sf_dir)
    t = bucketed_tables(spark, {"orders": star.orders, "order_items": star.order_items}, "order_id", BUCKETS)
    items = t.order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("qty").alias("units"), F.sum("subtotal").alias("items_value")
    )
    return t.orders.select("order_id", "customer_id", "total").join(items, "order_id")


def _column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the planner knows of some columns once the stored table is analysed; without its estimate of distinct values."""
    columns = ["product_id", "category_id", "stock", "price", "promo_price"]
    table = f"products_{uuid.uuid4().hex}"
    star_retail(spark, sf_dir).products.select(*columns).write.option("path", run_dir(spark, "analysed")).saveAsTable(table)
    analyze_table(spark, table, columns)
    return column_statistics(spark, table, columns).drop("distinct_count")


def _checkout_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored products after a batch of checkouts took its units."""
    out, star = run_dir(spark, "shop"), star_retail(spark, sf_dir)
    write_table(star.products, out, "products")
    jobs.update_stock(spark, out, _checkout(star).stock_deltas, "checkout-1", instant(AS_OF))
    return load_tables(spark, out, ["products"]).products.select("product_id", "stock", "updated_at")


def _status_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored products after cancelled orders put their units back."""
    out, star = run_dir(spark, "shop"), star_retail(spark, sf_dir)
    write_table(star.products, out, "products")
    jobs.update_stock(spark, out, _status_changes(star).restock, "status-1", instant(AS_OF))
    return load_tables(spark, out, ["products"]).products.select("product_id", "stock", "updated_at")


def _stamped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored orders after a batch of status changes, with the time of their last change."""
    out, star = run_dir(spark, "shop"), star_retail(spark, sf_dir)
    write_table(star.orders, out, "orders")
    jobs.update_orders(spark, out, _status_changes(star).changes, "status-1")
    return load_tables(spark, out, ["orders"]).orders.select("order_id", "status_id", "payment_ts", "created_at", "updated_at")


ON_FOLDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "j01_checkout_products": _checkout_products,
    "j02_status_products": _status_products,
    "j09_stamp_orders": _stamped_orders,
    "l02_write_and_load": _write_and_load,
    "l02_items_round_trip": _items_round_trip,
    "l02_bucketed_join": _bucketed_join,
    "l03_column_statistics": _column_statistics,
    "s01_stream_daily_revenue": _stream_daily_revenue,
    "s02_stream_low_stock": _stream_low_stock,
    "s03_stream_change_log": _stream_change_log,
}


# Given tables whose size tells how many partitions a shuffle needs.
GROWING = ("customer", "part", "orders", "lineitem", "events")


def _on_tables(build: Callable[[Retail], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        size_merging(spark, [f"{sf_dir}/{name}.parquet" for name in GROWING])
        return present(build(star_retail(spark, sf_dir)))

    return run


def _on_streams(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(build(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{name: _on_tables(build) for name, build in ON_TABLES.items()},
    **{name: _on_streams(build) for name, build in ON_FOLDERS.items()},
}
