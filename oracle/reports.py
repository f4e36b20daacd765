"""The reports written a second time, with subqueries, for DuckDB."""

from oracle.model import day, pct, ratio, stamp

PLACE = "m_addresses a JOIN m_cities ci USING (city_id) JOIN m_states s USING (state_id)"
BAD = "('Cancelled', 'Refunded')"

R01 = f"""
SELECT o.order_no, {stamp('o.order_ts')} AS order_ts, c.name AS customer, c.nickname, c.level, c.email,
  (SELECT name FROM m_cities WHERE city_id = a.city_id) AS city,
  (SELECT st.code FROM m_states st JOIN m_cities ci ON ci.state_id = st.state_id WHERE ci.city_id = a.city_id) AS state,
  p.name AS product, p.franchise, (SELECT name FROM m_categories k WHERE k.category_id = p.category_id) AS category,
  i.qty, i.unit_price::DOUBLE AS unit_price, i.subtotal::DOUBLE AS item_value, m.name AS payment_method, o.instalments,
  o.discount::DOUBLE AS order_discount, o.freight::DOUBLE AS freight, o.total::DOUBLE AS order_total
FROM m_orders o JOIN m_customers c USING (customer_id) JOIN m_addresses a ON a.address_id = o.address_id
JOIN m_order_items i ON i.order_id = o.order_id JOIN m_products p ON p.product_id = i.product_id
JOIN m_payment_methods m ON m.method_id = o.method_id
WHERE o.order_ts >= TIMESTAMP '1997-01-01' AND o.order_ts < TIMESTAMP '1998-01-01'
"""

R02 = f"""
WITH ranked AS (SELECT p.*, (SELECT sum(qty) FROM m_order_items i WHERE i.product_id = p.product_id) AS units
                FROM m_products p WHERE active ORDER BY units DESC NULLS LAST, product_id LIMIT 100)
SELECT product_id, (SELECT name FROM m_categories k WHERE k.category_id = p.category_id) AS category,
  p.name AS product, sku, price::DOUBLE AS price, coalesce(units, 0)::BIGINT AS units_sold,
  coalesce((SELECT sum(subtotal) FROM m_order_items i WHERE i.product_id = p.product_id), 0)::DOUBLE AS revenue,
  (SELECT count(*) FROM m_orders o WHERE o.status_id = 7 AND o.order_id IN
     (SELECT order_id FROM m_order_items i WHERE i.product_id = p.product_id)) AS delivered_orders,
  coalesce((SELECT {ratio('sum(rating)', 'count(*)')} FROM m_reviews r WHERE r.product_id = p.product_id AND approved), 0)
    AS avg_rating,
  (SELECT count(*) FROM m_reviews r WHERE r.product_id = p.product_id AND approved) AS n_reviews, stock
FROM ranked p
"""

R03 = f"""
WITH ranked AS (SELECT c.*, (SELECT sum(total) FROM m_orders o WHERE o.customer_id = c.customer_id) AS spent
                FROM m_customers c WHERE active ORDER BY spent DESC NULLS LAST, customer_id LIMIT 50)
SELECT customer_id, name, email, {day('birth_date')} AS birth_date,
  date_part('year', age(DATE '2001-07-31', birth_date)) AS age,
  (SELECT ci.name || '/' || s.code FROM {PLACE} WHERE a.customer_id = c.customer_id AND principal
   ORDER BY a.address_id LIMIT 1) AS main_city,
  (SELECT count(*) FROM m_orders o WHERE o.customer_id = c.customer_id) AS orders,
  coalesce(spent, 0)::DOUBLE AS total_spent,
  coalesce((SELECT {ratio('sum(total)', 'count(*)')} FROM m_orders o WHERE o.customer_id = c.customer_id), 0) AS avg_order,
  {stamp('(SELECT max(order_ts) FROM m_orders o WHERE o.customer_id = c.customer_id)')} AS last_order,
  {stamp('(SELECT min(order_ts) FROM m_orders o WHERE o.customer_id = c.customer_id)')} AS first_order,
  (SELECT count(DISTINCT i.product_id) FROM m_order_items i JOIN m_orders o USING (order_id)
   WHERE o.customer_id = c.customer_id) AS distinct_products,
  {stamp('created_at')} AS customer_since
FROM ranked c
"""

BASE = f"""SELECT s.region, s.code AS state, ci.name AS city, k.name AS category, o.order_id, i.qty, i.subtotal
  FROM m_orders o JOIN m_order_items i USING (order_id) JOIN m_products p USING (product_id)
  JOIN m_categories k USING (category_id) JOIN {PLACE} ON a.address_id = o.address_id"""

R04 = f"""
WITH base AS ({BASE}),
g AS (SELECT region, state, city, category, count(DISTINCT order_id) AS orders, sum(qty) AS units,
             sum(subtotal) AS revenue, count(*) AS n FROM base GROUP BY ALL),
r AS (SELECT g.*, (SELECT sum(subtotal) FROM base b WHERE b.region = g.region) AS region_revenue,
             (SELECT count(*) FROM g h WHERE h.region = g.region AND h.revenue > g.revenue) + 1 AS region_rank FROM g)
SELECT region, state, city, category, orders, units::BIGINT AS units, revenue::DOUBLE AS revenue,
  {ratio('revenue', 'n')} AS avg_item_value, region_revenue::DOUBLE AS region_revenue,
  {pct('revenue', 'region_revenue')} AS region_pct, region_rank::BIGINT AS region_rank
FROM r
"""

R04B = f"""
WITH base AS ({BASE})
SELECT region, state, category, 0::BIGINT AS level, count(DISTINCT order_id) AS orders, sum(qty)::BIGINT AS units,
  sum(subtotal)::DOUBLE AS revenue FROM base GROUP BY region, state, category
UNION ALL SELECT region, state, NULL, 1, count(DISTINCT order_id), sum(qty)::BIGINT, sum(subtotal)::DOUBLE
  FROM base GROUP BY region, state
UNION ALL SELECT region, NULL, NULL, 3, count(DISTINCT order_id), sum(qty)::BIGINT, sum(subtotal)::DOUBLE
  FROM base GROUP BY region
UNION ALL SELECT NULL, NULL, NULL, 7, count(DISTINCT order_id), sum(qty)::BIGINT, sum(subtotal)::DOUBLE FROM base
"""

R05 = f"""
WITH q AS (
  SELECT p.product_id, p.name AS product, p.sku, (SELECT name FROM m_categories k WHERE k.category_id = p.category_id) AS category,
    p.price::DOUBLE AS price, p.stock,
    (SELECT count(*) FROM m_carts c WHERE c.product_id = p.product_id) AS cart_lines,
    (SELECT sum(qty) FROM m_carts c WHERE c.product_id = p.product_id) AS cart_units,
    (SELECT count(DISTINCT customer_id) FROM m_carts c WHERE c.product_id = p.product_id) AS interested_customers,
    coalesce((SELECT sum(qty) FROM m_order_items i WHERE i.product_id = p.product_id), 0) AS units_sold,
    (SELECT count(DISTINCT o.order_id) FROM m_order_items i JOIN m_orders o USING (order_id)
     JOIN m_order_status st USING (status_id)
     WHERE i.product_id = p.product_id AND st.name NOT IN {BAD}) AS completed_orders
  FROM m_products p WHERE p.active AND EXISTS (SELECT 1 FROM m_carts c WHERE c.product_id = p.product_id))
SELECT product_id, product, sku, category, price, stock, cart_lines, cart_units::BIGINT AS cart_units,
  interested_customers, units_sold::BIGINT AS units_sold, completed_orders,
  {pct('units_sold', 'cart_units')} AS conversion_pct, (cart_units - units_sold)::BIGINT AS abandon_potential
FROM q ORDER BY cart_lines DESC, product_id LIMIT 50
"""

R06 = f"""
WITH f AS (SELECT date_trunc('month', o.order_ts)::DATE AS month, o.order_id, o.customer_id, o.total, i.qty
           FROM m_orders o JOIN m_order_items i USING (order_id) JOIN m_order_status st USING (status_id)
           WHERE st.name NOT IN {BAD} AND o.order_ts >= TIMESTAMP '1998-01-01'),
m AS (SELECT month, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers, sum(total) AS revenue,
             count(*) AS n, sum(qty) AS units FROM f GROUP BY month),
x AS (SELECT m.*, (SELECT arg_max(p.revenue, p.month) FROM m p WHERE p.month < m.month) AS prev,
             (SELECT p.revenue FROM m p WHERE p.month < m.month ORDER BY p.month DESC LIMIT 1 OFFSET 11) AS prev12
      FROM m),
y AS (SELECT x.*, (SELECT count(*) FROM m p WHERE p.revenue > x.revenue) + 1 AS rnk,
        (SELECT {ratio('sum(revenue)', 'count(*)')} FROM
           (SELECT revenue FROM m p WHERE p.month <= x.month ORDER BY p.month DESC LIMIT 3)) AS mavg FROM x)
SELECT {day('month')} AS month, orders, customers, revenue::DOUBLE AS revenue, {ratio('revenue', 'n')} AS avg_order,
  units::BIGINT AS items_sold, prev::DOUBLE AS prev_month_revenue, prev12::DOUBLE AS prev_year_revenue,
  {pct('revenue - prev', 'prev')} AS monthly_growth_pct, {pct('revenue - prev12', 'prev12')} AS yearly_growth_pct,
  mavg AS moving_avg_3m, rnk::BIGINT AS revenue_rank
FROM y
"""

R06B = f"""
WITH f AS (SELECT date_trunc('month', o.order_ts)::DATE AS month, o.customer_id, o.total,
             (SELECT sum(qty) FROM m_order_items i WHERE i.order_id = o.order_id) AS units
           FROM m_orders o JOIN m_order_status st USING (status_id)
           WHERE st.name NOT IN {BAD} AND EXISTS (SELECT 1 FROM m_order_items i WHERE i.order_id = o.order_id)),
m AS (SELECT month, count(*) AS orders, count(DISTINCT customer_id) AS customers, sum(total) AS revenue,
             sum(units) AS units FROM f WHERE month >= DATE '1997-01-01' GROUP BY month),
spine AS (SELECT unnest(generate_series(TIMESTAMP '1998-01-01', (SELECT max(month) FROM m)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month),
x AS (SELECT sp.month, coalesce(orders, 0) AS orders, coalesce(customers, 0) AS customers, coalesce(revenue, 0) AS revenue,
        coalesce({ratio('revenue', 'orders')}, 0) AS avg_order, coalesce(units, 0) AS units,
        (SELECT revenue FROM m p WHERE p.month = sp.month - INTERVAL 1 MONTH) AS prev,
        (SELECT revenue FROM m p WHERE p.month = sp.month - INTERVAL 1 YEAR) AS prev12,
        (SELECT {ratio('sum(revenue)', 'count(*)')} FROM m p
         WHERE p.month <= sp.month AND p.month >= sp.month - INTERVAL 2 MONTH) AS mavg
      FROM spine sp LEFT JOIN m ON m.month = sp.month)
SELECT {day('month')} AS month, orders, customers, revenue::DOUBLE AS revenue, avg_order, units::BIGINT AS items_sold,
  prev::DOUBLE AS prev_month_revenue, prev12::DOUBLE AS prev_year_revenue,
  {pct('revenue - prev', 'prev')} AS monthly_growth_pct, {pct('revenue - prev12', 'prev12')} AS yearly_growth_pct,
  mavg AS moving_avg_3m, ((SELECT count(*) FROM x z WHERE z.revenue > x.revenue) + 1)::BIGINT AS revenue_rank
FROM x
"""

R07 = f"""
WITH q AS (SELECT pm.*, o.n, o.value, o.secs, o.paid, o.confirmed, o.awaiting, o.cancelled FROM m_payment_methods pm LEFT JOIN
  (SELECT method_id, count(*) AS n, sum(total) AS value,
     sum(CASE WHEN status_id = 2 THEN 1 ELSE 0 END) AS confirmed, sum(CASE WHEN status_id = 1 THEN 1 ELSE 0 END) AS awaiting,
     sum(CASE WHEN status_id = 8 THEN 1 ELSE 0 END) AS cancelled, count(payment_ts) AS paid,
     sum(epoch(payment_ts - order_ts))::BIGINT AS secs FROM m_orders GROUP BY method_id) o USING (method_id) WHERE active)
SELECT name AS payment_method, max_instalments::BIGINT AS max_instalments, fee_pct::DOUBLE AS fee_pct,
  coalesce(n, 0) AS orders, coalesce(value, 0)::DOUBLE AS total_value, coalesce({ratio('value', 'n')}, 0) AS avg_order,
  coalesce(confirmed, 0)::BIGINT AS confirmed, coalesce(awaiting, 0)::BIGINT AS awaiting, coalesce(cancelled, 0)::BIGINT AS cancelled,
  {ratio('secs', 'paid * 3600')} AS hours_to_payment,
  (SELECT s.region FROM m_orders o JOIN {PLACE} ON a.address_id = o.address_id WHERE o.method_id = q.method_id
   GROUP BY s.region ORDER BY count(*) DESC, s.region LIMIT 1) AS main_region,
  {pct('confirmed', 'n')} AS success_pct, {pct('cancelled', 'n')} AS cancel_pct
FROM q
"""

ACTIVITY = """
cohorts AS (SELECT customer_id, date_trunc('month', created_at)::DATE AS cohort_month FROM m_customers
            WHERE created_at >= TIMESTAMP '1996-01-01'),
activity AS (SELECT c.cohort_month, c.customer_id, o.order_id, o.total,
               (date_diff('month', c.cohort_month, date_trunc('month', o.order_ts)::DATE)) AS off
             FROM cohorts c LEFT JOIN m_orders o USING (customer_id))"""

R08 = f"""
WITH {ACTIVITY},
m AS (SELECT cohort_month, count(DISTINCT customer_id) AS registered,
        count(DISTINCT CASE WHEN off = 0 THEN customer_id END) AS a0, count(DISTINCT CASE WHEN off = 1 THEN customer_id END) AS a1,
        count(DISTINCT CASE WHEN off = 2 THEN customer_id END) AS a2, count(DISTINCT CASE WHEN off = 3 THEN customer_id END) AS a3,
        count(DISTINCT CASE WHEN off >= 0 AND off <= 3 THEN customer_id END) AS a_any,
        sum(total) AS value, count(total) AS n, count(DISTINCT order_id) AS orders
      FROM activity GROUP BY cohort_month)
SELECT {day('cohort_month')} AS cohort_month, registered, a0 AS bought_month_0, a1 AS bought_month_1,
  a2 AS bought_month_2, a3 AS bought_month_3, {pct('a0', 'registered')} AS conversion_month_0,
  {pct('a1', 'a0')} AS retention_month_1, {pct('a2', 'a0')} AS retention_month_2, {pct('a3', 'a0')} AS retention_month_3,
  value::DOUBLE AS cohort_value, {ratio('value', 'n')} AS avg_order, orders, {ratio('value', 'a_any')} AS ltv_3m
FROM m
"""

R08B = f"""
WITH {ACTIVITY}
SELECT {day('cohort_month')} AS cohort_month,
  {', '.join(f"nullif(count(DISTINCT CASE WHEN off = {n} THEN customer_id END), 0) AS m{n}" for n in range(7))}
FROM activity WHERE off <= 6 GROUP BY cohort_month
"""

SOLD = """(SELECT sum(i.qty) FROM m_order_items i JOIN m_orders o USING (order_id) WHERE i.product_id = p.product_id
   AND o.order_ts >= DATE '2001-07-31' - INTERVAL {0} DAY AND o.order_ts < TIMESTAMP '2001-08-01')"""

R09 = f"""
WITH q AS (SELECT p.*, {SOLD.format(30)} AS s30, {SOLD.format(7)} AS s7, {SOLD.format(90)} AS s90,
    (SELECT count(DISTINCT o.order_ts::DATE) FROM m_order_items i JOIN m_orders o USING (order_id)
     WHERE i.product_id = p.product_id AND o.order_ts >= DATE '2001-07-31' - INTERVAL 30 DAY
     AND o.order_ts < TIMESTAMP '2001-08-01') AS days,
    (SELECT count(*) FROM m_carts c WHERE c.product_id = p.product_id) AS n_carts,
    coalesce((SELECT sum(qty) FROM m_carts c WHERE c.product_id = p.product_id), 0) AS in_carts
  FROM m_products p WHERE active AND stock <= 2 * stock_min)
SELECT product_id, sku, name, (SELECT name FROM m_categories k WHERE k.category_id = q.category_id) AS category,
  price::DOUBLE AS price, stock, stock_min, coalesce(s30, 0)::BIGINT AS sold_30d, coalesce(s7, 0)::BIGINT AS sold_7d,
  coalesce(s90, 0)::BIGINT AS sold_90d, coalesce({ratio('s30', 'days')}, 0) AS avg_per_sale_day,
  CASE WHEN s30 > 0 THEN {ratio('stock * 30', 's30', 1)} END AS days_left, n_carts AS cart_lines,
  in_carts::BIGINT AS cart_units, (stock - in_carts)::BIGINT AS effective_stock,
  CASE WHEN stock = 0 THEN 'RUPTURE' WHEN s30 > 0 AND stock * 30 <= s30 * 7 THEN 'CRITICAL'
       WHEN stock <= stock_min THEN 'LOW' ELSE 'ATTENTION' END AS stock_status,
  CASE WHEN s30 > 0 THEN {pct('s7 * 30 - s30 * 7', 's30 * 7', 1)} ELSE 0 END AS trend_pct
FROM q
"""

MONTH = "order_ts >= TIMESTAMP '2001-07-01' AND order_ts < TIMESTAMP '2001-08-01'"
BEFORE = "order_ts >= TIMESTAMP '2001-06-01' AND order_ts < TIMESTAMP '2001-07-01'"

DASHBOARD = f"""
WITH q AS (SELECT
  (SELECT count(*) FROM m_orders WHERE {MONTH}) AS o1, (SELECT count(*) FROM m_orders WHERE {BEFORE}) AS o0,
  (SELECT sum(total) FROM m_orders WHERE {MONTH}) AS r1, (SELECT sum(total) FROM m_orders WHERE {BEFORE}) AS r0,
  (SELECT count(DISTINCT customer_id) FROM m_orders WHERE {MONTH}) AS buyers,
  (SELECT count(*) FROM m_customers WHERE active) AS act),
d AS (SELECT o1 AS orders_month, o0 AS orders_prev_month, {pct('o1 - o0', 'o0', 1)} AS orders_change_pct,
  r1 AS revenue_month, r0 AS revenue_prev_month, {pct('r1 - r0', 'r0', 1)} AS revenue_change_pct,
  {ratio('r1', 'o1')} AS avg_order_month,
  (SELECT count(*) FROM m_customers WHERE created_at >= TIMESTAMP '2001-07-01' AND created_at < TIMESTAMP '2001-08-01')
    AS new_customers,
  buyers AS active_buyers_month, act AS active_customers, {pct('buyers', 'act', 1)} AS activation_pct,
  (SELECT count(*) FROM m_products WHERE active) AS active_products,
  (SELECT count(*) FROM m_products WHERE active AND stock <= stock_min) AS low_stock_products,
  (SELECT count(*) FROM m_products WHERE active AND stock = 0) AS out_of_stock_products,
  (SELECT sum(stock * price) FROM m_products WHERE active)::DECIMAL(18,2) AS stock_value,
  (SELECT count(*) FROM m_carts) AS cart_lines,
  (SELECT count(DISTINCT coalesce(customer_id::VARCHAR, session_id)) FROM m_carts) AS distinct_carts,
  (SELECT sum(c.qty * coalesce(p.promo_price, p.price)) FROM m_carts c JOIN m_products p USING (product_id))::DECIMAL(18,2)
    AS cart_value,
  (SELECT k.name FROM m_orders o JOIN m_order_items i USING (order_id) JOIN m_products p USING (product_id)
   JOIN m_categories k USING (category_id) WHERE {MONTH} GROUP BY k.name ORDER BY sum(i.subtotal) DESC LIMIT 1) AS top_category,
  (SELECT sum(i.subtotal) FROM m_orders o JOIN m_order_items i USING (order_id) JOIN m_products p USING (product_id)
   WHERE {MONTH} GROUP BY p.category_id ORDER BY sum(i.subtotal) DESC LIMIT 1) AS top_category_revenue,
  (SELECT count(*) FROM m_orders WHERE status_id = 1 AND order_ts < TIMESTAMP '2001-08-01') AS awaiting_payment,
  (SELECT count(*) FROM m_orders WHERE status_id IN (4, 5) AND order_ts < TIMESTAMP '2001-08-01') AS in_transport,
  (SELECT count(*) FROM m_orders WHERE status_id = 7 AND {MONTH}) AS delivered_month
  FROM q)
"""

MONEY_COLUMNS = ("revenue_month", "revenue_prev_month", "stock_value", "cart_value", "top_category_revenue")
R10 = DASHBOARD + "SELECT * REPLACE (" + ", ".join(f"{c}::DOUBLE AS {c}" for c in MONEY_COLUMNS) + ") FROM d"

METRICS = [
    ("orders_month", 0), ("orders_prev_month", 0), ("orders_change_pct", 1), ("revenue_month", 2),
    ("revenue_prev_month", 2), ("revenue_change_pct", 1), ("avg_order_month", 2), ("new_customers", 0),
    ("active_buyers_month", 0), ("active_customers", 0), ("activation_pct", 1), ("active_products", 0),
    ("low_stock_products", 0), ("out_of_stock_products", 0), ("stock_value", 2), ("cart_lines", 0),
    ("distinct_carts", 0), ("cart_value", 2), ("top_category", None), ("top_category_revenue", 2),
    ("awaiting_payment", 0), ("in_transport", 0), ("delivered_month", 0),
]
R10B = DASHBOARD + " UNION ALL ".join(
    f"SELECT {n}::BIGINT AS position, '{c}' AS metric, "
    + (f"{c}" if digits is None else f"{c}::DECIMAL(28,{digits})::VARCHAR")
    + " AS value FROM d"
    for n, (c, digits) in enumerate(METRICS, 1)
)

V01 = f"""
SELECT product_id, sku, name, (SELECT name FROM m_categories k WHERE k.category_id = p.category_id) AS category,
  price::DOUBLE AS price, promo_price::DOUBLE AS promo_price,
  CASE WHEN promo_price IS NULL OR price = 0 THEN 0 ELSE {pct('price - promo_price', 'price')} END AS discount_pct,
  coalesce(promo_price, price)::DOUBLE AS final_price, stock, stock_min,
  CASE WHEN stock = 0 THEN 'Out of stock' WHEN stock <= stock_min THEN 'Low stock' ELSE 'Available' END AS stock_status,
  active, featured,
  coalesce((SELECT {ratio('sum(rating)', 'count(*)')} FROM m_reviews r WHERE r.product_id = p.product_id AND r.approved), 0) AS avg_rating,
  (SELECT count(*) FROM m_reviews r WHERE r.product_id = p.product_id AND r.approved) AS n_reviews
FROM m_products p
"""

V02 = f"""
SELECT o.order_id, order_no, (SELECT name FROM m_customers c WHERE c.customer_id = o.customer_id) AS customer,
  (SELECT email FROM m_customers c WHERE c.customer_id = o.customer_id) AS customer_email,
  (SELECT name FROM m_order_status st WHERE st.status_id = o.status_id) AS status,
  (SELECT name FROM m_payment_methods m WHERE m.method_id = o.method_id) AS payment_method,
  o.subtotal::DOUBLE AS subtotal, o.discount::DOUBLE AS discount, o.freight::DOUBLE AS freight, o.total::DOUBLE AS total,
  instalments, {stamp('order_ts')} AS order_ts, {stamp('delivery_ts')} AS delivery_ts,
  (SELECT count(*) FROM m_order_items i WHERE i.order_id = o.order_id) AS n_items,
  (SELECT ci.name || '/' || s.code FROM {PLACE} WHERE a.address_id = o.address_id) AS delivery_city
FROM m_orders o
"""

V03 = f"""
SELECT {day("date_trunc('month', order_ts)")} AS month, count(DISTINCT order_id) AS orders,
  count(DISTINCT customer_id) AS customers, sum(total)::DOUBLE AS revenue, {ratio('sum(total)', 'count(*)')} AS avg_order,
  sum(discount)::DOUBLE AS discounts, sum(freight)::DOUBLE AS freight
FROM m_orders WHERE status_id NOT IN (8, 10) GROUP BY 1
"""

T01 = f"""
WITH q AS (SELECT customer_id, count(*) AS n, sum(total) AS spent, min(order_ts) AS f, max(order_ts) AS l
           FROM m_orders GROUP BY customer_id),
fav AS (SELECT customer_id, franchise FROM (SELECT o.customer_id, p.franchise,
          row_number() OVER (PARTITION BY o.customer_id ORDER BY count(*) DESC, p.franchise) AS rn
        FROM m_orders o JOIN m_order_items i USING (order_id) JOIN m_products p USING (product_id)
        WHERE p.franchise IS NOT NULL GROUP BY o.customer_id, p.franchise) WHERE rn = 1),
st AS (SELECT customer_id, name FROM (SELECT o.customer_id, s.name,
          row_number() OVER (PARTITION BY o.customer_id ORDER BY count(*) DESC, s.name) AS rn
        FROM m_orders o JOIN m_order_status s USING (status_id) GROUP BY o.customer_id, s.name) WHERE rn = 1)
SELECT q.customer_id, n AS orders, spent::DOUBLE AS total_spent, {ratio('spent', 'n')} AS avg_order,
  {day('f')} AS first_order, {day('l')} AS last_order, st.name AS usual_status, c.level, c.xp,
  fav.franchise AS favourite_franchise
FROM q JOIN m_customers c USING (customer_id) LEFT JOIN st USING (customer_id) LEFT JOIN fav USING (customer_id)
"""

T02 = """
SELECT product_id, name AS product, (SELECT name FROM m_categories k WHERE k.category_id = p.category_id) AS category,
  franchise, coalesce((SELECT sum(qty) FROM m_order_items i WHERE i.product_id = p.product_id), 0)::BIGINT AS units_sold,
  coalesce((SELECT sum(subtotal) FROM m_order_items i WHERE i.product_id = p.product_id), 0)::DOUBLE AS revenue
FROM m_products p WHERE active AND {0}
ORDER BY (SELECT sum(qty) FROM m_order_items i WHERE i.product_id = p.product_id) DESC NULLS LAST, product_id LIMIT 10
"""

T03 = f"""
SELECT {day('order_ts::DATE')} AS day, count(*) AS orders, sum(subtotal)::DOUBLE AS gross, sum(discount)::DOUBLE AS discounts,
  sum(freight)::DOUBLE AS freight, sum(total)::DOUBLE AS net
FROM m_orders WHERE order_ts::DATE BETWEEN DATE '1995-01-01' AND DATE '2001-07-31'
AND status_id NOT IN (SELECT status_id FROM m_order_status WHERE name IN {BAD}) GROUP BY 1
"""

SQL = {
    "r01_sales_detail": R01,
    "r02_best_sellers": R02,
    "r03_vip_customers": R03,
    "r04_region_category_revenue": R04,
    "r04b_region_category_rollup": R04B,
    "r05_cart_conversion": R05,
    "r06_monthly_trend": R06,
    "r06b_monthly_trend_order_grain": R06B,
    "r07_payment_performance": R07,
    "r08_cohort_retention": R08,
    "r08b_cohort_matrix": R08B,
    "r09_stockout_forecast": R09,
    "r10_executive_dashboard": R10,
    "r10b_dashboard_long": R10B,
    "v01_product_summary": V01,
    "v02_order_summary": V02,
    "v03_monthly_sales": V03,
    "t01_customer_stats": T01,
    "t02_top_products": T02.format("TRUE"),
    "t02_top_products_franchise": T02.format("franchise = 'Brand#12'"),
    "t03_daily_revenue": T03,
}
