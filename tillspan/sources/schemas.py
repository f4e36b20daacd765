"""Schemas of the retail tables and of the star-schema tables they can be derived from."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Retail tables: DDL text per table.
RETAIL_DDL = {
    "categories": (
        "category_id bigint, name string, description string, parent_id bigint, active boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "states": "state_id bigint, name string, code string, region string",
    "cities": "city_id bigint, name string, state_id bigint, ibge_code string",
    "payment_methods": (
        "method_id bigint, name string, fee_pct decimal(5,2), max_instalments int, active boolean"
    ),
    "order_status": "status_id bigint, name string, flow int",
    "customers": (
        "customer_id bigint, name string, email string, tax_id string, phone string, birth_date date, "
        "gender string, nickname string, level int, xp int, active boolean, newsletter boolean, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, last_seen timestamp_ntz"
    ),
    "products": (
        "product_id bigint, sku string, name string, category_id bigint, franchise string, maker string, "
        "price decimal(12,2), promo_price decimal(12,2), cost decimal(12,2), weight_kg decimal(8,3), "
        "stock int, stock_min int, active boolean, featured boolean, is_new boolean, exclusive boolean, "
        "presale boolean, release_date date, age_rating string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "addresses": (
        "address_id bigint, customer_id bigint, kind string, postcode string, street string, number string, "
        "district string, city_id bigint, principal boolean, created_at timestamp_ntz"
    ),
    "orders": (
        "order_id bigint, order_no string, customer_id bigint, address_id bigint, status_id bigint, "
        "method_id bigint, subtotal decimal(12,2), discount decimal(12,2), freight decimal(12,2), "
        "total decimal(12,2), instalments int, coupon_code string, order_ts timestamp_ntz, "
        "payment_ts timestamp_ntz, shipping_ts timestamp_ntz, delivery_ts timestamp_ntz, notes string, client_ip string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "order_items": (
        "item_id bigint, order_id bigint, product_id bigint, qty int, unit_price decimal(12,2), "
        "unit_discount decimal(12,2), subtotal decimal(12,2)"
    ),
    "reviews": (
        "review_id bigint, product_id bigint, customer_id bigint, rating int, title string, comment string, "
        "recommends boolean, approved boolean, created_at timestamp_ntz, pros string, cons string"
    ),
    "carts": (
        "cart_id bigint, customer_id bigint, session_id string, product_id bigint, qty int, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "status_history": (
        "history_id bigint, order_id bigint, old_status_id bigint, new_status_id bigint, note string, "
        "actor string, created_at timestamp_ntz"
    ),
    "coupons": (
        "coupon_id bigint, code string, kind string, value decimal(12,2), min_order decimal(12,2), "
        "max_uses int, used int, starts date, ends date, franchise string, category_id bigint, active boolean"
    ),
    "audit_log": (
        "log_id bigint, table_name string, op string, row_id bigint, old_row string, new_row string, "
        "actor string, created_at timestamp_ntz"
    ),
}

# Inputs of the batch jobs.
REQUEST_DDL = {
    "checkout_requests": (
        "request_id bigint, ts timestamp_ntz, customer_id bigint, address_id bigint, method_id bigint, "
        "coupon_code string, instalments int"
    ),
    "status_requests": (
        "request_id bigint, ts timestamp_ntz, order_id bigint, new_status_id bigint, note string, actor string"
    ),
    "cart_adds": "request_id bigint, ts timestamp_ntz, customer_id bigint, product_id bigint, qty int",
    "replenish_requests": (
        "request_id bigint, ts timestamp_ntz, product_id bigint, qty int, actor string"
    ),
    "freight_requests": "request_id bigint, postcode string, value decimal(12,2), weight_kg decimal(8,3)",
    "stock_deltas": "event_id bigint, ts timestamp_ntz, product_id bigint, delta int",
}

# Star-schema input tables.
STAR_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

# Column to partition a fact table by month on, and column to sort it by inside a file. Order items carry no time; they
# lie in the month of their order.
FACT_LAYOUT = {
    "orders": ("order_ts", "customer_id"),
    "order_items": (None, "order_id"),
    "reviews": ("created_at", "product_id"),
    "carts": ("created_at", "product_id"),
    "status_history": ("created_at", "order_id"),
    "audit_log": ("created_at", "row_id"),
}

# Tables stored in folders by a hash of their key, so that an update rewrites the folders of its keys alone.
KEYED_LAYOUT = {"products": "product_id", "customers": "customer_id"}


def schema_of(name: str) -> StructType:
    ddl = RETAIL_DDL.get(name) or REQUEST_DDL.get(name)
    if ddl is None:
        raise KeyError(f"unknown table {name!r}")
    return StructType.fromDDL(ddl)


def star_schema_of(name: str) -> StructType:
    return StructType.fromDDL(STAR_DDL[name])
