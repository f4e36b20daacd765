"""Row rules, quality checks, extra reports and name matching for DuckDB."""

from oracle.model import pct, ratio, stamp

C01 = f"""
SELECT customer_id, name, strip_accents(name) AS plain_name, lower(trim(email)) AS email,
  regexp_full_match(lower(trim(email)), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{{2,}}') AS email_valid,
  CASE WHEN length(tax_id) = 11 THEN tax_id[1:3] || '.' || tax_id[4:6] || '.' || tax_id[7:9] || '-' || tax_id[10:11] END
    AS tax_id,
  date_part('year', age(DATE '2001-07-31', birth_date)) AS age
FROM m_customers
"""

C02 = f"""
SELECT product_id, sku, name, price::DOUBLE AS price, promo_price::DOUBLE AS promo_price,
  coalesce(promo_price, price)::DOUBLE AS final_price,
  CASE WHEN promo_price IS NULL OR price = 0 THEN 0 ELSE {pct('price - promo_price', 'price')} END AS discount_pct
FROM m_products
"""

C03 = f"""
SELECT cart_id, customer_id, session_id, product_id, qty, {stamp('created_at')} AS created_at, {stamp('created_at')} AS updated_at,
  EXISTS (SELECT 1 FROM m_products p WHERE p.product_id = c.product_id AND p.active AND p.stock >= c.qty) AS available
FROM m_carts c
"""

FREIGHT = """CASE WHEN {value} >= 299 THEN 0 ELSE
  (CASE WHEN substr({postcode}, 1, 1) IN ('0', '1') THEN 25 WHEN substr({postcode}, 1, 1) IN ('2', '3') THEN 30
        WHEN substr({postcode}, 1, 1) IN ('4', '8') THEN 35 WHEN substr({postcode}, 1, 1) = '6' THEN 45
        WHEN substr({postcode}, 1, 1) = '7' THEN 50 ELSE 40 END + 2 * {weight})::DECIMAL(12,2) END"""

C04 = f"""
SELECT request_id, postcode, value::DOUBLE AS value, weight_kg::DOUBLE AS weight_kg,
  ({FREIGHT.format(value='value', postcode='postcode', weight='weight_kg')})::DOUBLE AS freight
FROM m_freight_requests
"""

CUT = """CASE WHEN {value} < c.min_order THEN 0::DECIMAL(12,2) ELSE least({value},
  CASE WHEN c.kind = 'PERCENT' THEN CAST(round(CAST({value} * c.value AS DECIMAL(28,4)) * 0.01::DECIMAL(3,2), 2) AS DECIMAL(12,2))
       ELSE c.value END) END"""

C05 = f"""
SELECT order_id, coupon_code, subtotal::DOUBLE AS subtotal,
  coalesce((SELECT {CUT.format(value='o.subtotal')} FROM m_coupons c WHERE c.code = upper(o.coupon_code) AND c.active
            AND DATE '2001-07-31' BETWEEN c.starts AND c.ends AND (c.max_uses IS NULL OR c.used < c.max_uses)), 0)::DOUBLE
    AS coupon_discount
FROM m_orders o
"""

UNIQUE = [
    ("categories(category_id)", "m_categories", "category_id"), ("categories(name)", "m_categories", "name"),
    ("states(state_id)", "m_states", "state_id"), ("states(code)", "m_states", "code"),
    ("cities(city_id)", "m_cities", "city_id"), ("cities(name, state_id)", "m_cities", "name, state_id"),
    ("payment_methods(method_id)", "m_payment_methods", "method_id"),
    ("payment_methods(name)", "m_payment_methods", "name"),
    ("order_status(status_id)", "m_order_status", "status_id"), ("order_status(name)", "m_order_status", "name"),
    ("customers(customer_id)", "m_customers", "customer_id"), ("customers(email)", "m_customers", "email"),
    ("customers(tax_id)", "m_customers", "tax_id"),
    ("products(product_id)", "m_products", "product_id"), ("products(sku)", "m_products", "sku"),
    ("addresses(address_id)", "m_addresses", "address_id"),
    ("orders(order_id)", "m_orders", "order_id"), ("orders(order_no)", "m_orders", "order_no"),
    ("order_items(item_id)", "m_order_items", "item_id"),
    ("order_items(order_id, product_id)", "m_order_items", "order_id, product_id"),
    ("reviews(review_id)", "m_reviews", "review_id"),
    ("reviews(product_id, customer_id)", "m_reviews", "product_id, customer_id"),
    ("carts(cart_id)", "m_carts", "cart_id"), ("status_history(history_id)", "m_status_history", "history_id"),
    ("audit_log(log_id)", "m_audit_log", "log_id"),
    ("coupons(coupon_id)", "m_coupons", "coupon_id"), ("coupons(code)", "m_coupons", "code"),
]
D01 = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, (SELECT count(*) FROM (SELECT {keys} FROM {table} "
    f"WHERE {' AND '.join(k + ' IS NOT NULL' for k in keys.split(', '))} GROUP BY {keys} HAVING count(*) > 1)) AS violations"
    for rule, table, keys in UNIQUE
)

REFERENCES = [
    ("cities.state_id", "states.state_id"), ("products.category_id", "categories.category_id"),
    ("addresses.customer_id", "customers.customer_id"), ("addresses.city_id", "cities.city_id"),
    ("orders.customer_id", "customers.customer_id"), ("orders.address_id", "addresses.address_id"),
    ("orders.status_id", "order_status.status_id"), ("orders.method_id", "payment_methods.method_id"),
    ("order_items.order_id", "orders.order_id"), ("order_items.product_id", "products.product_id"),
    ("reviews.product_id", "products.product_id"), ("reviews.customer_id", "customers.customer_id"),
    ("carts.customer_id", "customers.customer_id"), ("carts.product_id", "products.product_id"),
    ("orders.coupon_code", "coupons.code"), ("status_history.order_id", "orders.order_id"),
    ("status_history.old_status_id", "order_status.status_id"), ("status_history.new_status_id", "order_status.status_id"),
]


def _reference(child: str, parent: str) -> str:
    (c, c_col), (p, p_col) = child.split("."), parent.split(".")
    return (
        f"SELECT '{child} -> {parent}' AS rule, (SELECT count(*) FROM m_{c} x WHERE {c_col} IS NOT NULL "
        f"AND {c_col} NOT IN (SELECT {p_col} FROM m_{p})) AS violations"
    )


# Two references lead to columns the derived tables hold as constant NULL.
D02 = " UNION ALL ".join(_reference(c, p) for c, p in REFERENCES) + """
UNION ALL SELECT 'categories.parent_id -> categories.category_id', 0
UNION ALL SELECT 'coupons.category_id -> categories.category_id', 0
"""

RULES = [
    ("customers.gender", "m_customers", "gender NOT IN ('M', 'F', 'O')"),
    ("customers.level", "m_customers", "level < 1 OR level > 10"),
    ("customers.email", "m_customers", "NOT regexp_full_match(lower(email), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}')"),
    ("products.price", "m_products", "price < 0"), ("products.promo_price", "m_products", "promo_price < 0"),
    ("products.cost", "m_products", "cost < 0"), ("products.stock", "m_products", "stock < 0"),
    ("products.promo_below_price", "m_products", "promo_price >= price"),
    ("addresses.kind", "m_addresses", "kind NOT IN ('DELIVERY', 'BILLING', 'BOTH')"),
    ("orders.subtotal", "m_orders", "subtotal < 0"), ("orders.discount", "m_orders", "discount < 0"),
    ("orders.freight", "m_orders", "freight < 0"), ("orders.total", "m_orders", "total < 0"),
    ("order_items.qty", "m_order_items", "qty <= 0"), ("order_items.unit_price", "m_order_items", "unit_price < 0"),
    ("order_items.subtotal", "m_order_items", "subtotal < 0"),
    ("reviews.rating", "m_reviews", "rating < 1 OR rating > 5"),
    ("carts.qty", "m_carts", "qty <= 0"), ("carts.owner", "m_carts", "customer_id IS NULL AND session_id IS NULL"),
    ("audit_log.op", "m_audit_log", "op NOT IN ('INSERT', 'UPDATE', 'DELETE')"),
    ("coupons.kind", "m_coupons", "kind NOT IN ('PERCENT', 'FIXED')"), ("coupons.dates", "m_coupons", "ends < starts"),
]
D03 = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, (SELECT count(*) FROM {table} WHERE {broken}) AS violations" for rule, table, broken in RULES
)

REQUIRED = {
    "categories": "category_id name", "states": "state_id name code region", "cities": "city_id name state_id",
    "payment_methods": "method_id name", "order_status": "status_id name flow",
    "customers": "customer_id name email tax_id", "products": "product_id sku name category_id price franchise",
    "addresses": "address_id customer_id postcode street number district city_id",
    "orders": "order_id order_no customer_id address_id status_id method_id subtotal total coupon_code payment_ts",
    "order_items": "item_id order_id product_id qty unit_price unit_discount subtotal",
    "reviews": "review_id product_id customer_id rating", "carts": "cart_id customer_id product_id qty",
    "coupons": "coupon_id code kind value max_uses starts ends",
    "status_history": "history_id order_id new_status_id", "audit_log": "log_id table_name op",
}
D04 = " UNION ALL ".join(
    f"SELECT '{table}.{c}' AS rule, (SELECT count(*) FROM m_{table} WHERE {c} IS NULL) AS violations"
    for table, columns in REQUIRED.items() for c in columns.split()
)

COUNTED = (
    "customers products addresses orders order_items reviews categories states cities carts coupons payment_methods "
    "order_status"
).split()
D05 = " UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM m_{t}) AS n_rows" for t in COUNTED)

X01 = """
SELECT k.name AS category, p.franchise, count(*) AS products,
  count(*) FILTER (WHERE stock <= stock_min) AS low_stock, count(*) FILTER (WHERE stock = 0) AS out_of_stock,
  sum(stock)::BIGINT AS units, sum(stock * price)::DOUBLE AS stock_value
FROM m_products p JOIN m_categories k USING (category_id) WHERE p.active GROUP BY k.name, p.franchise
"""
X02 = f"""
SELECT s.region, s.code AS state, count(*) AS orders, sum(o.total)::DOUBLE AS value, {stamp('min(o.order_ts)')} AS oldest_order
FROM m_orders o JOIN m_addresses a USING (address_id) JOIN m_cities ci USING (city_id) JOIN m_states s USING (state_id)
WHERE o.status_id = (SELECT status_id FROM m_order_status WHERE name = 'Awaiting Payment') GROUP BY 1, 2
"""
X03 = f"""
SELECT category, units::BIGINT AS units, revenue::DOUBLE AS revenue, cost::DOUBLE AS cost, (revenue - cost)::DOUBLE AS margin,
  {pct('revenue - cost', 'revenue')} AS margin_pct
FROM (SELECT k.name AS category, sum(i.qty) AS units, sum(i.subtotal) AS revenue, sum(i.qty * p.cost) AS cost
      FROM m_order_items i JOIN m_products p USING (product_id) JOIN m_categories k USING (category_id) GROUP BY k.name)
"""
X04 = f"""
WITH r AS (SELECT product_id, {ratio('sum(rating)', 'count(*)')} AS avg_rating, count(*) AS n_reviews
           FROM m_reviews WHERE approved GROUP BY product_id),
k AS (SELECT r.*, (SELECT count(*) FROM r o WHERE o.avg_rating > r.avg_rating
                   OR (o.avg_rating = r.avg_rating AND o.n_reviews > r.n_reviews)) + 1 AS rating_rank FROM r)
SELECT product_id, p.name AS product, (SELECT name FROM m_categories c WHERE c.category_id = p.category_id) AS category,
  avg_rating, n_reviews, rating_rank::BIGINT AS rating_rank
FROM k JOIN m_products p USING (product_id) ORDER BY rating_rank, product_id LIMIT 20
"""
X05 = """
WITH s AS (SELECT product_id, sum(qty) AS units, sum(subtotal) AS revenue FROM m_order_items GROUP BY product_id)
SELECT k.name AS category, product_id, p.name AS product, units::BIGINT AS units_sold, revenue::DOUBLE AS revenue,
  rank() OVER (PARTITION BY k.name ORDER BY revenue DESC)::BIGINT AS category_rank
FROM s JOIN m_products p USING (product_id) JOIN m_categories k USING (category_id)
"""
X06 = """
SELECT franchise, count(DISTINCT product_id) AS products, sum(qty)::BIGINT AS units, sum(subtotal)::DOUBLE AS revenue
FROM m_order_items JOIN m_products USING (product_id) WHERE franchise IS NOT NULL
GROUP BY franchise HAVING sum(subtotal) >= 1000000
"""
X07 = """
SELECT review_id, product_id, customer_id, rating, count(*) OVER (PARTITION BY product_id) AS product_reviews FROM m_reviews
"""
X08 = f"""
SELECT level, count(DISTINCT c.customer_id) AS customers,
  (SELECT sum(xp) FROM m_customers x WHERE x.active AND x.level = c.level)::BIGINT AS xp,
  count(o.order_id) AS orders, coalesce(sum(o.total), 0)::DOUBLE AS spent,
  {ratio('coalesce(sum(o.total), 0)', 'count(DISTINCT c.customer_id)')} AS avg_spent
FROM m_customers c LEFT JOIN m_orders o USING (customer_id) WHERE c.active GROUP BY level
"""

L04 = """
WITH names AS (SELECT DISTINCT name FROM m_products),
words AS (SELECT name, unnest(regexp_split_to_array(lower(strip_accents(name)), '[^a-z0-9]+')) AS w FROM names),
grams AS (SELECT DISTINCT name, substr('  ' || w || ' ', i::INT, 3) AS g
          FROM words, range(1, 60) AS r(i) WHERE w <> '' AND i <= length(w) + 1),
sizes AS (SELECT name, count(*) AS n FROM grams GROUP BY name),
shared AS (SELECT a.name AS l, b.name AS r, count(*) AS k FROM grams a JOIN grams b USING (g) GROUP BY 1, 2)
SELECT l AS left_name, r AS right_name, k::DOUBLE / (x.n + y.n - k)::DOUBLE AS similarity
FROM shared JOIN sizes x ON x.name = l JOIN sizes y ON y.name = r WHERE k::DOUBLE / (x.n + y.n - k)::DOUBLE >= {0}
"""

SQL = {
    "c01_clean_customers": C01,
    "c02_price_list": C02,
    "c03_check_availability": C03,
    "c04_quote_freight": C04,
    "c05_apply_coupons": C05,
    "d01_check_unique": D01,
    "d02_check_references": D02,
    "d03_check_rules": D03,
    "d04_check_required": D04,
    "d05_table_counts": D05,
    "x01_stock_by_category_franchise": X01,
    "x02_pending_orders_by_region": X02,
    "x03_category_performance": X03,
    "x04_top_rated_products": X04,
    "x05_product_rank_in_category": X05,
    "x06_franchise_sales": X06,
    "x07_reviews_per_product": X07,
    "x08_customers_by_level": X08,
    "l04_name_matches": L04.format("0.4"),
    "l04_name_matches_customers": L04.replace("m_products", "m_customers").format("0.9"),
}
