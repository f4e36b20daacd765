"""The retail tables as DuckDB common table expressions over the star-schema views."""

STATUS_ROWS = """(1, 'Awaiting Payment', 1), (2, 'Payment Confirmed', 2), (3, 'Picking', 3), (4, 'Shipped', 4),
 (5, 'In Transit', 5), (6, 'Out for Delivery', 6), (7, 'Delivered', 7), (8, 'Cancelled', 8), (9, 'Returned', 9),
 (10, 'Refunded', 10)"""

CATEGORY_ID = "ascii(p_type) * 100000 + ascii(substr(p_type, 2, 1)) * 100 + length(p_type)"

# Table name -> (query, tables it is built from).
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "m_states": (
        """SELECT n_nationkey::BIGINT AS state_id, n_name AS name,
                  'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS code, r_name AS region
           FROM nation, region WHERE n_regionkey = r_regionkey""",
        (),
    ),
    "m_cities": (
        """SELECT (n_nationkey * 10 + j)::BIGINT AS city_id, n_name || ' City ' || j AS name,
                  n_nationkey::BIGINT AS state_id
           FROM nation, range(10) AS r(j)""",
        (),
    ),
    "m_categories": (
        f"SELECT DISTINCT ({CATEGORY_ID})::BIGINT AS category_id, p_type AS name, TRUE AS active FROM part",
        (),
    ),
    "m_payment_methods": (
        """SELECT DISTINCT substr(o_orderpriority, 1, 1)::BIGINT AS method_id, o_orderpriority AS name,
                  substr(o_orderpriority, 1, 1)::DECIMAL(5,2) AS fee_pct,
                  (substr(o_orderpriority, 1, 1)::BIGINT * 2) AS max_instalments,
                  substr(o_orderpriority, 1, 1) <> '3' AS active
           FROM orders""",
        (),
    ),
    "m_order_status": (f"SELECT * FROM (VALUES {STATUS_ROWS}) AS s(status_id, name, flow)", ()),
    "m_products": (
        f"""SELECT p_partkey AS product_id, 'SKU-' || lpad(p_partkey::VARCHAR, 9, '0') AS sku, p_name AS name,
                   ({CATEGORY_ID})::BIGINT AS category_id,
                   CASE WHEN p_partkey % 10 <> 9 THEN p_brand END AS franchise,
                   p_retailprice::DECIMAL(12,2) AS price,
                   CASE WHEN p_partkey % 10 < 3
                        THEN (p_retailprice::DECIMAL(12,2) * 0.8::DECIMAL(2,1))::DECIMAL(12,2) END AS promo_price,
                   (p_retailprice::DECIMAL(12,2) * 0.6::DECIMAL(2,1))::DECIMAL(12,2) AS cost,
                   ((1 + p_partkey % 50)::DECIMAL(8,3) * 0.1::DECIMAL(2,1))::DECIMAL(8,3) AS weight_kg,
                   p_partkey * 7 % 200 AS stock, 3 + p_partkey % 10 AS stock_min,
                   p_partkey % 33 <> 0 AS active, p_partkey % 11 = 0 AS featured
            FROM part""",
        (),
    ),
    "m_customers": (
        """SELECT c_custkey AS customer_id, c_name AS name,
                  CASE WHEN c_custkey % 7 = 0 THEN '  ' || upper(replace(c_name, '#', '.')) || '@SHOP.EXAMPLE '
                       WHEN c_custkey % 11 = 0 THEN lower(c_name) || '.at.example'
                       ELSE lower(replace(c_name, '#', '.')) || '@mail.example' END AS email,
                  CASE WHEN c_custkey % 13 = 0 THEN NULL
                       WHEN c_custkey % 17 = 0 THEN lpad(c_custkey::VARCHAR, 10, '0')
                       ELSE lpad((c_custkey * 7919)::VARCHAR, 11, '0') END AS tax_id,
                  DATE '1960-01-01' + (c_custkey * 97 % 16000)::INT AS birth_date,
                  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'O' END AS gender,
                  'nick' || c_custkey AS nickname, 1 + c_custkey % 10 AS level,
                  (1 + c_custkey % 10) * 100 + c_custkey % 500 AS xp, c_custkey % 20 <> 0 AS active,
                  (DATE '1995-01-01' + (c_custkey * 37 % 2400)::INT)::TIMESTAMP AS created_at
           FROM customer""",
        (),
    ),
    "m_addresses": (
        """SELECT c_custkey * 2 + s AS address_id, c_custkey AS customer_id,
                  CASE WHEN s = 0 THEN 'DELIVERY' ELSE 'BOTH' END AS kind,
                  lpad((c_custkey * 12345679 % 100000000)::VARCHAR, 8, '0') AS postcode,
                  'Street ' || (c_custkey % 997) AS street, (1 + c_custkey % 500)::VARCHAR AS number,
                  'District ' || (c_custkey % 13) AS district, (c_nationkey + s) % 25 * 10 + c_custkey % 10 AS city_id,
                  s = 1 OR c_custkey % 4 <> 0 AS principal
           FROM customer, range(2) AS r(s) WHERE s = 0 OR c_custkey % 3 = 0""",
        (),
    ),
    "m_orders": (
        """SELECT *, (total + discount - freight)::DECIMAL(12,2) AS subtotal,
                  CASE WHEN order_id % 10 <> 3 THEN order_ts + to_hours((1 + order_id % 48)::INT) END AS payment_ts,
                  CASE WHEN order_id % 10 BETWEEN 3 AND 6
                       THEN order_ts + to_days((1 + order_id % 3)::INT) END AS shipping_ts,
                  CASE WHEN order_id % 10 = 6
                       THEN order_ts + to_days((3 + order_id % 10)::INT) END AS delivery_ts
           FROM (SELECT o_orderkey AS order_id, 'ORD' || lpad(o_orderkey::VARCHAR, 12, '0') AS order_no,
                        o_custkey AS customer_id, o_custkey * 2 AS address_id, 1 + o_orderkey % 10 AS status_id,
                        substr(o_orderpriority, 1, 1)::BIGINT AS method_id,
                        o_totalprice::DECIMAL(12,2) AS total,
                        CASE WHEN o_orderkey % 5 = 0
                             THEN (o_totalprice::DECIMAL(12,2) * 0.1::DECIMAL(2,1))::DECIMAL(12,2)
                             ELSE 0::DECIMAL(12,2) END AS discount,
                        (CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 15 + o_orderkey % 45 END)::DECIMAL(12,2) AS freight,
                        1 + o_orderkey % 12 AS instalments,
                        CASE WHEN o_orderkey % 5 = 0 THEN 'brand' || (1 + o_orderkey // 5 % 30) END AS coupon_code,
                        o_orderdate + to_seconds(o_orderkey % 86400) AS order_ts
                 FROM orders)""",
        (),
    ),
    "m_order_items": (
        """SELECT item_id, order_id, product_id, qty, unit_price,
                  CASE WHEN rate > 0 THEN (unit_price * rate)::DECIMAL(12,2) END AS unit_discount, subtotal
           FROM (SELECT l_orderkey * 8 + l_linenumber AS item_id, l_orderkey AS order_id,
                        l_partkey AS product_id, l_quantity::BIGINT AS qty, l_discount::DECIMAL(4,2) AS rate,
                        l_extendedprice::DECIMAL(12,2) AS subtotal,
                        (((l_extendedprice::DECIMAL(12,2) * 100)::BIGINT // l_quantity::BIGINT)::DECIMAL(12,0)
                          * 0.01::DECIMAL(3,2))::DECIMAL(12,2) AS unit_price
                 FROM lineitem)""",
        (),
    ),
    "m_events": (
        "SELECT event_id, ts, user_id, event_type, json_extract_string(props, '$.k')::BIGINT AS k FROM events",
        (),
    ),
    "m_carts": (
        """SELECT event_id AS cart_id, CASE WHEN event_id % 5 <> 0 THEN user_id END AS customer_id,
                  's' || user_id AS session_id, k AS product_id, 1 + event_id % 3 AS qty, ts AS created_at
           FROM m_events WHERE event_type = 'click'""",
        ("m_events",),
    ),
    "m_reviews": (
        """SELECT event_id AS review_id, k AS product_id, user_id AS customer_id, 1 + event_id % 5 AS rating,
                  event_id % 7 <> 0 AS approved, ts AS created_at
           FROM m_events AS e WHERE event_type = 'view'
           AND NOT EXISTS (SELECT 1 FROM m_events AS x WHERE x.event_type = 'view' AND x.k = e.k
                           AND x.user_id = e.user_id AND x.event_id < e.event_id)""",
        ("m_events",),
    ),
    "m_coupons": (
        """SELECT n AS coupon_id, upper(replace(p_brand, '#', '')) AS code,
                  CASE WHEN n % 2 = 0 THEN 'PERCENT' ELSE 'FIXED' END AS kind,
                  (CASE WHEN n % 2 = 0 THEN 5 + n ELSE n * 50 END)::DECIMAL(12,2) AS value,
                  (n * 40)::DECIMAL(12,2) AS min_order, CASE WHEN n % 3 <> 0 THEN n END AS max_uses,
                  CASE WHEN n % 5 = 0 THEN n ELSE n % 4 END AS used,
                  CASE n % 4 WHEN 2 THEN DATE '2001-01-01' WHEN 3 THEN DATE '2024-01-10'
                             ELSE DATE '1995-01-01' END AS starts,
                  CASE n % 4 WHEN 0 THEN DATE '2000-12-31' WHEN 1 THEN DATE '2030-12-31'
                             WHEN 2 THEN DATE '2001-12-31' ELSE DATE '2024-01-25' END AS ends,
                  n % 11 <> 0 AS active
           FROM (SELECT DISTINCT p_brand, substr(p_brand, 7)::BIGINT AS n FROM part)""",
        (),
    ),
    "m_old": (
        """SELECT product_id, name, franchise, price, promo_price, stock, stock_min, active,
                  TIMESTAMP '1995-01-01' AS updated_at FROM m_products""",
        ("m_products",),
    ),
    "m_new": (
        """SELECT CASE WHEN product_id % 50 = 7 THEN product_id + 1000000000 ELSE product_id END AS product_id, name,
                  CASE WHEN product_id % 30 = 19 THEN 'Brand#0' ELSE franchise END AS franchise,
                  CASE WHEN product_id % 23 = 0 THEN (price + 10)::DECIMAL(12,2) ELSE price END AS price,
                  CASE WHEN product_id % 30 = 1 THEN NULL ELSE promo_price END AS promo_price,
                  CASE WHEN product_id % 2 = 0 THEN greatest(stock - 60, 0) ELSE stock END AS stock,
                  stock_min, active, TIMESTAMP '1995-01-01' AS updated_at FROM m_products""",
        ("m_products",),
    ),
    "m_checkout_requests": (
        """SELECT event_id AS request_id, ts, user_id AS customer_id,
                  CASE WHEN event_id % 40 = 0 THEN -1 ELSE user_id * 2 END AS address_id,
                  1 + event_id % 5 AS method_id,
                  CASE WHEN event_id % 3 <> 0 THEN 'brand' || (1 + event_id % 30) END AS coupon_code,
                  1 + event_id % 12 AS instalments
           FROM m_events WHERE event_type = 'purchase'""",
        ("m_events",),
    ),
    "m_status_requests": (
        """SELECT event_id AS request_id, ts,
                  user_id * 5 + k % 5 + CASE WHEN k = 99 THEN 1000000000 ELSE 0 END AS order_id,
                  1 + (event_id + k) % 11 AS new_status_id, 'clerk' || (user_id % 4) AS actor
           FROM m_events""",
        ("m_events",),
    ),
    "m_status_history": (
        """SELECT order_id AS history_id, order_id, CASE WHEN status_id > 1 THEN status_id - 1 END AS old_status_id,
                  status_id AS new_status_id FROM m_orders""",
        ("m_orders",),
    ),
    "m_audit_log": (
        """SELECT event_id AS log_id, 'products' AS table_name,
                  CASE WHEN event_id % 100 = 0 THEN NULL ELSE ['INSERT', 'UPDATE', 'REMOVE'][event_id % 3 + 1] END AS op
           FROM m_events WHERE event_type = 'signup'""",
        ("m_events",),
    ),
    "m_cart_adds": (
        """SELECT event_id AS request_id, ts, user_id AS customer_id, k * 3 AS product_id,
                  1 + event_id % 60 AS qty FROM m_events WHERE event_type = 'view'""",
        ("m_events",),
    ),
    "m_replenish_requests": (
        """SELECT event_id AS request_id, ts, k * 25 AS product_id, 1 + event_id % 20 AS qty,
                  'clerk' || (user_id % 4) AS actor FROM m_events WHERE event_type = 'signup'""",
        ("m_events",),
    ),
    "m_freight_requests": (
        """SELECT order_id AS request_id, postcode,
                  ((total * 100)::BIGINT % 60000)::DECIMAL(12,0) * 0.01::DECIMAL(3,2) AS value,
                  (1 + order_id % 50)::DECIMAL(8,3) * 0.1::DECIMAL(2,1) AS weight_kg
           FROM m_orders JOIN m_addresses USING (address_id)""",
        ("m_orders", "m_addresses"),
    ),
    "m_stock_deltas": (
        """SELECT event_id, ts, k AS product_id,
                  CASE WHEN event_type = 'signup' THEN 12 ELSE -(1 + event_id % 4) END AS delta FROM m_events""",
        ("m_events",),
    ),
}

# The rounding rule of the comparison: divide as doubles, round as decimals.
MACROS = {
    "ratio": "CAST(round(CAST(CAST({0} AS DOUBLE) / CAST(nullif({1}, 0) AS DOUBLE) AS DECIMAL(38,10)), {2}) AS DOUBLE)",
    "pct": (
        "CAST(round(CAST(CAST({0} AS DOUBLE) / CAST(nullif({1}, 0) AS DOUBLE) * 100.0::DOUBLE AS DECIMAL(38,10)), {2})"
        " AS DOUBLE)"
    ),
}


def ratio(num: str, den: str, digits: int = 2) -> str:
    return MACROS["ratio"].format(num, den, digits)


def pct(num: str, den: str, digits: int = 2) -> str:
    return MACROS["pct"].format(num, den, digits)


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def stamp(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def with_model(sql: str) -> str:
    """Put the tables a query names in front of it, in order of dependency."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name in needed:
            return
        for parent in TABLES[name][1]:
            need(parent)
        needed.append(name)

    import re

    for name in TABLES:
        if re.search(rf"\b{name}\b", sql):
            need(name)
    ctes = ",\n".join(f"{name} AS ({TABLES[name][0]})" for name in needed)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[14:]}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[4:]}"
    return f"WITH {ctes}\n{body}"
