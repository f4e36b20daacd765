"""Retail tables and job requests derived from the star-schema tables.

The rules are integer arithmetic on the given keys, so every row can be recomputed by any SQL engine.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.sources.schemas import star_schema_of
from tillspan.sources.statuses import ORDER_STATUS
from tillspan.sources.tables import Retail, literal_rows, literal_table

AS_OF = "2001-07-31"
CITIES_PER_STATE = 10


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(star_schema_of(name)).parquet(f"{sf_dir}/{name}.parquet")


def stream_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of files: `<name>.parquet`, and further files `<name>-*.parquet`."""
    reader = spark.readStream.schema(star_schema_of(name)).option("pathGlobFilter", f"{name}{{,-*}}.parquet")
    return reader.parquet(sf_dir)


def star_streams(spark: SparkSession, sf_dir: str) -> Retail:
    raw = partial(stream_star, spark, sf_dir)
    return Retail(
        {
            "orders": lambda: _orders(raw),
            "stock_deltas": lambda: _stock_deltas(raw),
            "product_feed": lambda: _product_feed(raw),
        }
    )


def star_retail(spark: SparkSession, sf_dir: str) -> Retail:
    raw = partial(read_star, spark, sf_dir)
    return Retail(
        {
            "states": lambda: _states(raw),
            "cities": lambda: _cities(raw),
            "categories": lambda: _categories(spark, raw),
            "payment_methods": lambda: _payment_methods(spark, raw),
            "order_status": lambda: literal_table(spark, "order_status", ORDER_STATUS),
            "products": lambda: _products(raw),
            "customers": lambda: _customers(raw),
            "addresses": lambda: _addresses(raw),
            "orders": lambda: _orders(raw),
            "order_items": lambda: _order_items(raw),
            "carts": lambda: _carts(raw),
            "reviews": lambda: _reviews(raw),
            "review_submissions": lambda: _review_submissions(raw),
            "coupons": lambda: _coupons(raw),
            "status_history": lambda: _status_history(raw),
            "audit_log": lambda: _audit_log(raw),
            "products_old": lambda: _products_old(raw),
            "products_new": lambda: _products_new(raw),
            "product_feed": lambda: _product_feed(raw),
            "checkout_requests": lambda: _checkout_requests(raw),
            "status_requests": lambda: _status_requests(raw),
            "cart_adds": lambda: _cart_adds(raw),
            "replenish_requests": lambda: _replenish_requests(raw),
            "freight_requests": lambda: _freight_requests(raw),
            "stock_deltas": lambda: _stock_deltas(raw),
        }
    )


CATEGORY_ID = "ascii(p_type) * 100000 + ascii(substring(p_type, 2, 1)) * 100 + length(p_type)"



def _states(raw) -> DataFrame:
    joined = raw("nation").join(raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.selectExpr(
        "cast(n_nationkey as bigint) as state_id",
        "n_name as name",
        "concat('N', lpad(cast(n_nationkey as string), 2, '0')) as code",
        "r_name as region",
    )


def _cities(raw) -> DataFrame:
    per_state = raw("nation").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(CITIES_PER_STATE - 1))))
    return per_state.selectExpr(
        "cast(n_nationkey * 10 + j as bigint) as city_id",
        "concat(n_name, ' City ', j) as name",
        "cast(n_nationkey as bigint) as state_id",
        "lpad(cast(n_nationkey * 10 + j as string), 7, '0') as ibge_code",
    )


def _categories(spark: SparkSession, raw) -> DataFrame:
    names = _values(spark, raw("part"), CATEGORY_ID, "p_type", "category_id")
    return names.selectExpr(
        "cast(category_id as bigint) as category_id",
        "name",
        "cast(null as string) as description",
        "cast(null as bigint) as parent_id",
        "true as active",
        "timestamp_ntz'1995-01-01 00:00:00' as created_at",
        "timestamp_ntz'1995-01-01 00:00:00' as updated_at",
    )


def _values(spark: SparkSession, df: DataFrame, key: str, column: str, key_name: str) -> DataFrame:
    """The distinct values of a column that names the rows of a small table, with their keys.

    They are looked up when the table is asked for and become literals, so reports don't scan a fact for them. Of
    several values with one key the first counts, so that no fact is multiplied.
    """
    found = df.where(f"{column} is not null").groupBy(F.expr(key).alias("key")).agg(F.min(column).alias("value"))
    rows = sorted((row["key"], row["value"]) for row in found.collect())
    return literal_rows(spark, rows or [(None, None)], [key_name, "name"]).where("name is not null")


def _payment_methods(spark: SparkSession, raw) -> DataFrame:
    names = _values(spark, raw("orders"), "cast(substring(o_orderpriority, 1, 1) as int)", "o_orderpriority", "method_id")
    return names.selectExpr(
        "cast(method_id as bigint) as method_id",
        "name",
        "cast(method_id as decimal(5,2)) as fee_pct",
        "cast(method_id * 2 as int) as max_instalments",
        "method_id <> 3 as active",
    )


def _products(raw) -> DataFrame:
    return (
        raw("part")
        .withColumn("price", F.col("p_retailprice").cast("decimal(12,2)"))
        .selectExpr(
            "p_partkey as product_id",
            "concat('SKU-', lpad(cast(p_partkey as string), 9, '0')) as sku",
            "p_name as name",
            f"cast({CATEGORY_ID} as bigint) as category_id",
            "case when p_partkey % 10 <> 9 then p_brand end as franchise",
            "concat('Maker ', p_size % 7) as maker",
            "price",
            "case when p_partkey % 10 < 3 then cast(price * 0.8 as decimal(12,2)) end as promo_price",
            "cast(price * 0.6 as decimal(12,2)) as cost",
            "cast((1 + p_partkey % 50) * 0.1 as decimal(8,3)) as weight_kg",
            "cast(p_partkey * 7 % 200 as int) as stock",
            "cast(3 + p_partkey % 10 as int) as stock_min",
            "p_partkey % 33 <> 0 as active",
            "p_partkey % 11 = 0 as featured",
            "p_partkey % 13 = 0 as is_new",
            "p_partkey % 17 = 0 as exclusive",
            "p_partkey % 19 = 0 as presale",
            "date_add(date'1995-01-01', cast(p_partkey % 2000 as int)) as release_date",
            "cast(null as string) as age_rating",
            "timestamp_ntz'1995-01-01 00:00:00' as created_at",
            "timestamp_ntz'1995-01-01 00:00:00' as updated_at",
        )
    )


def _customers(raw) -> DataFrame:
    return (
        raw("customer")
        .withColumn("created", F.expr("date_add(date'1995-01-01', cast(c_custkey * 37 % 2400 as int))"))
        .selectExpr(
            "c_custkey as customer_id",
            "c_name as name",
            """case when c_custkey % 7 = 0 then concat('  ', upper(replace(c_name, '#', '.')), '@SHOP.EXAMPLE ')
                    when c_custkey % 11 = 0 then concat(lower(c_name), '.at.example')
                    else concat(lower(replace(c_name, '#', '.')), '@mail.example') end as email""",
            """case when c_custkey % 13 = 0 then null
                    when c_custkey % 17 = 0 then lpad(cast(c_custkey as string), 10, '0')
                    else lpad(cast(c_custkey * 7919 as string), 11, '0') end as tax_id""",
            "cast(null as string) as phone",
            "date_add(date'1960-01-01', cast(c_custkey * 97 % 16000 as int)) as birth_date",
            "case c_custkey % 3 when 0 then 'M' when 1 then 'F' else 'O' end as gender",
            "concat('nick', c_custkey) as nickname",
            "cast(1 + c_custkey % 10 as int) as level",
            "cast((1 + c_custkey % 10) * 100 + c_custkey % 500 as int) as xp",
            "c_custkey % 20 <> 0 as active",
            "c_custkey % 2 = 0 as newsletter",
            "cast(created as timestamp_ntz) as created_at",
            "cast(created as timestamp_ntz) as updated_at",
            "cast(null as timestamp_ntz) as last_seen",
        )
    )


def _addresses(raw) -> DataFrame:
    # One row per customer, two where the key is a multiple of three.
    numbered = raw("customer").withColumn(
        "second", F.expr("explode(case when c_custkey % 3 = 0 then array(0, 1) else array(0) end)")
    )
    return numbered.selectExpr(
        "c_custkey * 2 + second as address_id",
        "c_custkey as customer_id",
        "case when second = 0 then 'DELIVERY' else 'BOTH' end as kind",
        "lpad(cast(c_custkey * 12345679 % 100000000 as string), 8, '0') as postcode",
        "concat('Street ', c_custkey % 997) as street",
        "cast(1 + c_custkey % 500 as string) as number",
        "concat('District ', c_custkey % 13) as district",
        "cast((c_nationkey + second) % 25 * 10 + c_custkey % 10 as bigint) as city_id",
        "second = 1 or c_custkey % 4 <> 0 as principal",
        "timestamp_ntz'1995-01-01 00:00:00' as created_at",
    )


def _orders(raw) -> DataFrame:
    return (
        raw("orders")
        .selectExpr(
            "o_orderkey",
            "o_custkey",
            "cast(substring(o_orderpriority, 1, 1) as bigint) as method_id",
            "cast(o_totalprice as decimal(12,2)) as total",
            """case when o_orderkey % 5 = 0
                    then cast(cast(o_totalprice as decimal(12,2)) * 0.1 as decimal(12,2))
                    else cast(0 as decimal(12,2)) end as discount""",
            """cast(case when o_orderkey % 2 = 0 then 0 else 15 + o_orderkey % 45 end
                    as decimal(12,2)) as freight""",
            "o_orderdate + cast(o_orderkey % 86400 as int) * interval '1' second as order_ts",
        )
        .selectExpr(
            "o_orderkey as order_id",
            "concat('ORD', lpad(cast(o_orderkey as string), 12, '0')) as order_no",
            "o_custkey as customer_id",
            "o_custkey * 2 as address_id",
            "1 + o_orderkey % 10 as status_id",
            "method_id",
            "cast(total + discount - freight as decimal(12,2)) as subtotal",
            "discount",
            "freight",
            "total",
            "cast(1 + o_orderkey % 12 as int) as instalments",
            "case when o_orderkey % 5 = 0 then concat('brand', 1 + o_orderkey div 5 % 30) end as coupon_code",
            "order_ts",
            """case when o_orderkey % 10 <> 3
                    then order_ts + cast(1 + o_orderkey % 48 as int) * interval '1' hour end as payment_ts""",
            """case when o_orderkey % 10 between 3 and 6
                    then order_ts + cast(1 + o_orderkey % 3 as int) * interval '1' day end as shipping_ts""",
            """case when o_orderkey % 10 = 6
                    then order_ts + cast(3 + o_orderkey % 10 as int) * interval '1' day end as delivery_ts""",
            "cast(null as string) as notes",
            "cast(null as string) as client_ip",
            "order_ts as created_at",
            "order_ts as updated_at",
        )
    )


def _order_items(raw) -> DataFrame:
    return (
        raw("lineitem")
        .selectExpr(
            "l_orderkey",
            "l_partkey",
            "l_linenumber",
            "cast(l_quantity as int) as qty",
            "cast(l_extendedprice as decimal(12,2)) as subtotal",
            "cast(l_discount as decimal(4,2)) as rate",
        )
        .selectExpr(
            "*", "cast((cast(subtotal * 100 as bigint) div qty) * 0.01 as decimal(12,2)) as unit_price"
        )
        .selectExpr(
            "l_orderkey * 8 + l_linenumber as item_id",
            "l_orderkey as order_id",
            "l_partkey as product_id",
            "qty",
            "unit_price",
            "case when rate > 0 then cast(unit_price * rate as decimal(12,2)) end as unit_discount",
            "subtotal",
        )
    )


def _events(raw, kind: str) -> DataFrame:
    return raw("events").filter(F.col("event_type") == kind).withColumn(
        "k", F.get_json_object("props", "$.k").cast("bigint")
    )


def _carts(raw) -> DataFrame:
    return _events(raw, "click").selectExpr(
        "event_id as cart_id",
        "case when event_id % 5 <> 0 then user_id end as customer_id",
        "concat('s', user_id) as session_id",
        "k as product_id",
        "cast(1 + event_id % 3 as int) as qty",
        "ts as created_at",
        "ts as updated_at",
    )


REVIEW_COLUMNS = (
    "review_id",
    "k as product_id",
    "user_id as customer_id",
    "cast(1 + review_id % 5 as int) as rating",
    "cast(null as string) as title",
    "cast(null as string) as comment",
    "review_id % 10 <> 0 as recommends",
    "review_id % 7 <> 0 as approved",
    "created_at",
    "cast(null as string) as pros",
    "cast(null as string) as cons",
)


def _review_submissions(raw) -> DataFrame:
    sent = _events(raw, "view").withColumnsRenamed({"event_id": "review_id", "ts": "created_at"})
    return sent.selectExpr(*REVIEW_COLUMNS)


def _reviews(raw) -> DataFrame:
    firsts = _events(raw, "view").groupBy("k", "user_id").agg(
        F.min("event_id").alias("review_id"), F.min_by("ts", "event_id").alias("created_at")
    )
    return firsts.selectExpr(*REVIEW_COLUMNS)


def _coupons(raw) -> DataFrame:
    brands = raw("part").select("p_brand").distinct().selectExpr(
        "p_brand", "cast(substring(p_brand, 7) as bigint) as n"
    )
    return brands.selectExpr(
        "n as coupon_id",
        "upper(replace(p_brand, '#', '')) as code",
        "case when n % 2 = 0 then 'PERCENT' else 'FIXED' end as kind",
        "cast(case when n % 2 = 0 then 5 + n else n * 50 end as decimal(12,2)) as value",
        "cast(n * 40 as decimal(12,2)) as min_order",
        "cast(case when n % 3 <> 0 then n end as int) as max_uses",
        "cast(case when n % 5 = 0 then n else n % 4 end as int) as used",
        """case n % 4 when 2 then date'2001-01-01' when 3 then date'2024-01-10'
                      else date'1995-01-01' end as starts""",
        """case n % 4 when 0 then date'2000-12-31' when 1 then date'2030-12-31'
                      when 2 then date'2001-12-31' else date'2024-01-25' end as ends""",
        "cast(null as string) as franchise",
        "cast(null as bigint) as category_id",
        "n % 11 <> 0 as active",
    )


# Two catalogue snapshots: in the newer one some products have left, others took new keys, and some changed.
RENUMBERED = 1_000_000_000
SNAPSHOT_COLUMNS = (
    "product_id", "name", "franchise", "price", "promo_price", "stock", "stock_min", "active", "updated_at",
)


def _products_old(raw) -> DataFrame:
    return _products(raw).select(*SNAPSHOT_COLUMNS)


def _products_new(raw) -> DataFrame:
    return (
        _products(raw)
        .select(*SNAPSHOT_COLUMNS)
        .selectExpr(
            f"case when product_id % 50 = 7 then product_id + {RENUMBERED} else product_id end as product_id",
            "name",
            "case when product_id % 30 = 19 then 'Brand#0' else franchise end as franchise",
            "case when product_id % 23 = 0 then cast(price + 10 as decimal(12,2)) else price end as price",
            "case when product_id % 30 = 1 then null else promo_price end as promo_price",
            "case when product_id % 2 = 0 then greatest(stock - 60, 0) else stock end as stock",
            "stock_min",
            "active",
            "updated_at",
        )
    )


def _product_feed(raw) -> DataFrame:
    """The newer snapshot as row versions; a product that took a new key also sends a deletion of the old one."""
    versions = _products_new(raw).withColumn(
        "gone",
        F.expr(f"explode(case when product_id >= {RENUMBERED} then array(false, true) else array(false) end)"),
    )
    key = f"case when gone then product_id - {RENUMBERED} else product_id end as product_id"
    return versions.selectExpr(key, *SNAPSHOT_COLUMNS[1:], "gone as deleted", "cast(0 as bigint) as seq")


def _checkout_requests(raw) -> DataFrame:
    return _events(raw, "purchase").selectExpr(
        "event_id as request_id",
        "ts",
        "user_id as customer_id",
        "case when event_id % 40 = 0 then -1 else user_id * 2 end as address_id",
        "1 + event_id % 5 as method_id",
        "case when event_id % 3 <> 0 then concat('brand', 1 + event_id % 30) end as coupon_code",
        "cast(1 + event_id % 12 as int) as instalments",
    )


def _status_requests(raw) -> DataFrame:
    return raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).selectExpr(
        "event_id as request_id",
        "ts",
        "user_id * 5 + k % 5 + case when k = 99 then 1000000000 else 0 end as order_id",
        "1 + (event_id + k) % 11 as new_status_id",
        "cast(null as string) as note",
        "concat('clerk', user_id % 4) as actor",
    )


def _status_history(raw) -> DataFrame:
    # The step to the present state of every order.
    return _orders(raw).selectExpr(
        "order_id as history_id",
        "order_id",
        "case when status_id > 1 then status_id - 1 end as old_status_id",
        "status_id as new_status_id",
        "cast(null as string) as note",
        "concat('clerk', order_id % 4) as actor",
        "order_ts as created_at",
    )


def _audit_log(raw) -> DataFrame:
    # What clerks did to products; every hundredth entry lost the kind of change.
    return _events(raw, "signup").selectExpr(
        "event_id as log_id",
        "'products' as table_name",
        "case when event_id % 100 = 0 then null when event_id % 3 = 0 then 'INSERT' when event_id % 3 = 1 then 'UPDATE' else 'REMOVE' end as op",
        "k * 25 as row_id",
        "cast(null as string) as old_row",
        "cast(null as string) as new_row",
        "concat('clerk', user_id % 4) as actor",
        "ts as created_at",
    )


def _cart_adds(raw) -> DataFrame:
    return _events(raw, "view").selectExpr(
        "event_id as request_id",
        "ts",
        "user_id as customer_id",
        "k * 3 as product_id",
        "cast(1 + event_id % 60 as int) as qty",
    )


def _replenish_requests(raw) -> DataFrame:
    return _events(raw, "signup").selectExpr(
        "event_id as request_id",
        "ts",
        "k * 25 as product_id",
        "cast(1 + event_id % 20 as int) as qty",
        "concat('clerk', user_id % 4) as actor",
    )


def _freight_requests(raw) -> DataFrame:
    return (
        _orders(raw)
        .join(_addresses(raw).select("address_id", "postcode"), "address_id")
        .selectExpr(
            "order_id as request_id",
            "postcode",
            "cast((cast(total * 100 as bigint) % 60000) * 0.01 as decimal(12,2)) as value",
            "cast((1 + order_id % 50) * 0.1 as decimal(8,3)) as weight_kg",
        )
    )


def _stock_deltas(raw) -> DataFrame:
    return raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint")).selectExpr(
        "event_id",
        "ts",
        "k as product_id",
        "cast(case when event_type = 'signup' then 12 else -(1 + event_id % 4) end as int) as delta",
    )
