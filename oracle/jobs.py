"""The batch jobs for DuckDB: folds as recursive queries, everything else as plain SQL."""

from oracle.model import stamp
from oracle.rules import CUT, FREIGHT

# One-by-one checkout. Step n takes the n-th competing request; `used` holds the units taken per product.
CHECKOUT = f"""
WITH RECURSIVE lines AS (
  SELECT customer_id, product_id, sum(qty)::BIGINT AS qty, any_value(coalesce(p.promo_price, p.price)) AS price,
         any_value(CASE WHEN p.active THEN p.stock ELSE 0 END) AS cap
  FROM m_carts c JOIN m_products p USING (product_id) WHERE customer_id IS NOT NULL GROUP BY customer_id, product_id),
totals AS (SELECT customer_id, sum(qty * price)::DECIMAL(12,2) AS subtotal FROM lines GROUP BY customer_id),
judged AS (SELECT r.*, t.subtotal, a.postcode FROM m_checkout_requests r
           LEFT JOIN totals t USING (customer_id) LEFT JOIN m_addresses a ON a.address_id = r.address_id),
firsts AS (SELECT * FROM (SELECT j.*, row_number() OVER (PARTITION BY customer_id ORDER BY ts, request_id) AS k FROM judged j
                          WHERE subtotal > 0 AND postcode IS NOT NULL) WHERE k = 1),
queue AS (SELECT f.*, row_number() OVER (ORDER BY ts, request_id) AS n FROM firsts f),
packed AS (SELECT n, list(product_id ORDER BY product_id) AS ids, list(l.qty ORDER BY product_id) AS qtys,
             list(cap ORDER BY product_id) AS caps
           FROM queue q JOIN lines l ON l.customer_id = q.customer_id GROUP BY n),
sim(n, used, ok) AS (
  SELECT 0::BIGINT, list_transform(range(1000), lambda x: 0::BIGINT), FALSE
  UNION ALL
  SELECT y.n, CASE WHEN y.fits THEN list_transform(y.used, lambda u, i: u + coalesce(y.qtys[list_position(y.ids, i - 1)], 0))
                   ELSE y.used END, y.fits
  FROM (SELECT p.n, s.used, p.ids, p.qtys,
          list_bool_and(list_transform(range(1, len(p.ids) + 1), lambda i: s.used[p.ids[i] + 1] + p.qtys[i] <= p.caps[i])) AS fits
        FROM sim s JOIN packed p ON p.n = s.n + 1) y),
won AS (SELECT q.* FROM queue q JOIN sim s ON s.n = q.n AND s.ok),
offers AS (SELECT w.request_id, w.ts, c.code, c.used, c.max_uses, {CUT.format(value='w.subtotal')} AS cut
           FROM won w JOIN m_coupons c ON c.code = upper(w.coupon_code) AND c.active AND w.ts::DATE BETWEEN c.starts AND c.ends),
granted AS (SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY code ORDER BY ts, request_id) AS k FROM offers o
                           WHERE cut > 0) WHERE max_uses IS NULL OR used + k - 1 < max_uses),
placed AS (SELECT w.*, coalesce(g.cut, 0)::DECIMAL(12,2) AS discount,
             ({FREIGHT.format(value='w.subtotal', postcode='w.postcode', weight='1')})::DECIMAL(12,2) AS freight
           FROM won w LEFT JOIN granted g USING (request_id))
"""

J01_ORDERS = CHECKOUT + f"""
SELECT request_id AS order_id, 'ORD' || strftime(ts, '%Y%m%d%H%M%S') || '-' || request_id AS order_no, customer_id, address_id,
  1::BIGINT AS status_id, method_id, subtotal::DOUBLE AS subtotal, discount::DOUBLE AS discount, freight::DOUBLE AS freight,
  (subtotal - discount + freight)::DOUBLE AS total, instalments, coupon_code, {stamp('ts')} AS order_ts,
  NULL::VARCHAR AS payment_ts, NULL::VARCHAR AS shipping_ts, NULL::VARCHAR AS delivery_ts, NULL::VARCHAR AS notes,
  NULL::VARCHAR AS client_ip, {stamp('ts')} AS created_at, {stamp('ts')} AS updated_at
FROM placed
"""
J01_PRODUCTS = CHECKOUT + """
SELECT product_id, (stock + coalesce(delta, 0))::BIGINT AS stock,
  CASE WHEN delta IS NULL THEN '1995-01-01 00:00:00.000000' ELSE '2001-07-31 00:00:00.000000' END AS updated_at
FROM m_products LEFT JOIN (
  SELECT product_id, -sum(l.qty)::BIGINT AS delta FROM won w JOIN lines l ON l.customer_id = w.customer_id GROUP BY 1) d USING (product_id)
"""
J01_ITEMS = CHECKOUT + """
SELECT request_id AS order_id, product_id, l.qty, price::DOUBLE AS unit_price, (l.qty * price)::DOUBLE AS subtotal
FROM won JOIN lines l USING (customer_id)
"""
J01_DELTAS = CHECKOUT + "SELECT product_id, -sum(l.qty)::BIGINT AS delta FROM won JOIN lines l USING (customer_id) GROUP BY 1"
J01_COUPONS = CHECKOUT + "SELECT code, count(*) AS uses FROM granted GROUP BY code"
J01_HISTORY = CHECKOUT + f"""
SELECT request_id AS order_id, NULL::BIGINT AS old_status_id, 1::BIGINT AS new_status_id, 'Order created' AS note,
  'system' AS actor, {stamp('ts')} AS created_at FROM won
"""
J01_CARTS = CHECKOUT + f"""
SELECT cart_id, customer_id, session_id, product_id, qty, {stamp('created_at')} AS created_at, {stamp('created_at')} AS updated_at
FROM m_carts c
WHERE NOT EXISTS (SELECT 1 FROM won w WHERE w.customer_id = c.customer_id)
"""
J01_REJECTS = CHECKOUT + """
SELECT request_id, CASE WHEN subtotal IS NULL OR subtotal = 0 THEN 'empty cart'
  WHEN EXISTS (SELECT 1 FROM won w WHERE w.customer_id = j.customer_id AND (w.ts, w.request_id) < (j.ts, j.request_id))
    THEN 'empty cart'
  WHEN postcode IS NULL THEN 'unknown address' ELSE 'insufficient stock' END AS reason
FROM judged j WHERE request_id NOT IN (SELECT request_id FROM won)
"""

# Status requests folded one after the other for every order.
STATUS = """
WITH RECURSIVE numbered AS (
  SELECT r.*, s.flow, row_number() OVER (PARTITION BY r.order_id ORDER BY r.ts, r.request_id) AS n
  FROM m_status_requests r JOIN m_order_status s ON s.status_id = r.new_status_id JOIN m_orders o ON o.order_id = r.order_id),
fold(order_id, n, request_id, old_status_id, status_id, flow, ok) AS (
  SELECT o.order_id, 0::BIGINT, NULL::BIGINT, NULL::BIGINT, o.status_id, s.flow, FALSE
  FROM m_orders o JOIN m_order_status s USING (status_id) WHERE o.order_id IN (SELECT order_id FROM numbered)
  UNION ALL
  SELECT f.order_id, r.n, r.request_id, f.status_id,
    CASE WHEN r.flow < f.flow AND r.flow < 8 THEN f.status_id ELSE r.new_status_id END,
    CASE WHEN r.flow < f.flow AND r.flow < 8 THEN f.flow ELSE r.flow END, NOT (r.flow < f.flow AND r.flow < 8)
  FROM fold f JOIN numbered r ON r.order_id = f.order_id AND r.n = f.n + 1),
done AS (SELECT f.*, r.ts, r.actor, r.new_status_id FROM fold f JOIN m_status_requests r USING (request_id) WHERE f.ok)
"""

J02_ORDERS = STATUS + f"""
SELECT order_id, coalesce((SELECT arg_max(d.new_status_id, d.n) FROM done d WHERE d.order_id = o.order_id), status_id) AS status_id,
  {stamp("coalesce((SELECT max(ts) FROM done d WHERE d.order_id = o.order_id AND new_status_id = 2), payment_ts)")} AS payment_ts,
  {stamp("coalesce((SELECT max(ts) FROM done d WHERE d.order_id = o.order_id AND new_status_id = 4), shipping_ts)")} AS shipping_ts,
  {stamp("coalesce((SELECT max(ts) FROM done d WHERE d.order_id = o.order_id AND new_status_id = 7), delivery_ts)")} AS delivery_ts
FROM m_orders o
"""
J02_HISTORY = STATUS + f"""
SELECT request_id, order_id, old_status_id, new_status_id, NULL::VARCHAR AS note, actor, {stamp('ts')} AS created_at FROM done
"""
J02_RESTOCK = STATUS + """
SELECT i.product_id, sum(i.qty)::BIGINT AS delta FROM done d JOIN m_order_items i USING (order_id)
WHERE d.new_status_id = 8 GROUP BY i.product_id
"""
J02_PRODUCTS = STATUS + """
SELECT product_id, (stock + coalesce(delta, 0))::BIGINT AS stock,
  CASE WHEN delta IS NULL THEN '1995-01-01 00:00:00.000000' ELSE '2001-07-31 00:00:00.000000' END AS updated_at
FROM m_products LEFT JOIN (
  SELECT i.product_id, sum(i.qty)::BIGINT AS delta FROM done d JOIN m_order_items i USING (order_id)
  WHERE d.new_status_id = 8 GROUP BY 1) r USING (product_id)
"""
J09_ORDERS = STATUS + f"""
SELECT order_id, coalesce((SELECT arg_max(d.new_status_id, d.n) FROM done d WHERE d.order_id = o.order_id), status_id) AS status_id,
  {stamp("coalesce((SELECT max(ts) FROM done d WHERE d.order_id = o.order_id AND new_status_id = 2), payment_ts)")} AS payment_ts,
  {stamp('order_ts')} AS created_at,
  {stamp("coalesce((SELECT max(ts) FROM done d WHERE d.order_id = o.order_id), order_ts)")} AS updated_at
FROM m_orders o
"""
J02_REJECTS = STATUS + """
SELECT request_id, 'backward step' AS reason FROM fold WHERE NOT ok AND request_id IS NOT NULL
UNION ALL
SELECT request_id, CASE WHEN order_id NOT IN (SELECT order_id FROM m_orders) THEN 'unknown order' ELSE 'unknown status' END
FROM m_status_requests WHERE order_id NOT IN (SELECT order_id FROM m_orders)
  OR new_status_id NOT IN (SELECT status_id FROM m_order_status)
"""

ADDS = """
WITH fine AS (SELECT a.* FROM m_cart_adds a JOIN m_products p USING (product_id) WHERE p.active AND p.stock >= a.qty),
target AS (SELECT customer_id, product_id, min(cart_id) AS cart_id FROM m_carts WHERE customer_id IS NOT NULL GROUP BY 1, 2)
"""
J03_CARTS = ADDS + f"""
SELECT c.cart_id, c.customer_id, c.session_id, c.product_id,
  (c.qty + CASE WHEN c.cart_id IN (SELECT cart_id FROM target)
     THEN coalesce((SELECT sum(f.qty) FROM fine f WHERE f.customer_id = c.customer_id AND f.product_id = c.product_id), 0)
     ELSE 0 END)::BIGINT AS qty, {stamp('c.created_at')} AS created_at,
  {stamp("""coalesce(CASE WHEN c.cart_id IN (SELECT cart_id FROM target)
     THEN (SELECT max(f.ts) FROM fine f WHERE f.customer_id = c.customer_id AND f.product_id = c.product_id) END, c.created_at)""")} AS updated_at
FROM m_carts c
UNION ALL
SELECT min(request_id), customer_id, NULL, product_id, sum(qty)::BIGINT, {stamp('min(ts)')}, {stamp('max(ts)')}
FROM fine f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.customer_id = f.customer_id AND t.product_id = f.product_id)
GROUP BY customer_id, product_id
"""
J03_REJECTS = """
SELECT request_id, CASE WHEN p.product_id IS NULL OR NOT p.active THEN 'product missing or inactive'
                        ELSE 'insufficient stock' END AS reason
FROM m_cart_adds a LEFT JOIN m_products p USING (product_id) WHERE p.product_id IS NULL OR NOT p.active OR p.stock < a.qty
"""

J04_PRODUCTS = f"""
SELECT product_id, (stock + coalesce((SELECT sum(qty) FROM m_replenish_requests r WHERE r.product_id = p.product_id), 0))::BIGINT
    AS stock,
  {stamp("coalesce((SELECT max(ts) FROM m_replenish_requests r WHERE r.product_id = p.product_id), TIMESTAMP '1995-01-01')")}
    AS updated_at
FROM m_products p
"""
J04_AUDIT = f"""
WITH q AS (SELECT r.*, p.stock + sum(r.qty) OVER (PARTITION BY r.product_id ORDER BY ts, request_id ROWS UNBOUNDED PRECEDING)
             AS after FROM m_replenish_requests r JOIN m_products p USING (product_id))
SELECT request_id, 'products' AS table_name, 'UPDATE' AS op, product_id AS row_id,
  '{{"stock":' || (after - qty)::BIGINT || '}}' AS old_row,
  '{{"stock":' || after::BIGINT || ',"restocked":' || qty || '}}' AS new_row, actor, {stamp('ts')} AS created_at
FROM q
"""
J04_REJECTS = """
SELECT request_id, 'unknown product' AS reason FROM m_replenish_requests
WHERE product_id NOT IN (SELECT product_id FROM m_products)
"""


def _row_json(alias: str) -> str:
    quoted, bare = ("name", "franchise"), ("price", "promo_price", "stock", "stock_min", "active")
    parts = [f"'{{\"product_id\":' || {alias}.product_id"]
    parts += [f"',\"{c}\":' || coalesce('\"' || {alias}.{c} || '\"', 'null')" for c in quoted]
    parts += [f"',\"{c}\":' || coalesce({alias}.{c}::VARCHAR, 'null')" for c in bare]
    parts += [f"',\"updated_at\":\"' || strftime({alias}.updated_at, '%Y-%m-%dT%H:%M:%S.%g') || '\"}}'"]
    return " || ".join(parts)


DIFFERS = " OR ".join(
    f"o.{c} IS DISTINCT FROM n.{c}" for c in ("name", "franchise", "price", "promo_price", "stock", "stock_min", "active")
)
J05 = f"""
SELECT 'products' AS table_name, CASE WHEN o.product_id IS NULL THEN 'INSERT' WHEN n.product_id IS NULL THEN 'DELETE'
    ELSE 'UPDATE' END AS op, coalesce(o.product_id, n.product_id) AS row_id, {_row_json('o')} AS old_row, {_row_json('n')} AS new_row
FROM m_old o FULL JOIN m_new n ON o.product_id = n.product_id
WHERE o.product_id IS NULL OR n.product_id IS NULL OR {DIFFERS}
"""
J06 = """
SELECT n.product_id, n.name, o.stock AS stock_before, n.stock, n.stock_min FROM m_old o JOIN m_new n USING (product_id)
WHERE n.stock <= n.stock_min AND o.stock > o.stock_min
"""
J07 = """
SELECT item_id, order_id, product_id, qty, unit_price::DOUBLE AS unit_price, unit_discount::DOUBLE AS unit_discount,
  ((unit_price - coalesce(unit_discount, 0)) * qty)::DOUBLE AS subtotal
FROM m_order_items
"""
HELD = """EXISTS (SELECT 1 FROM m_{0} x WHERE x.customer_id = c.customer_id)"""
FREE = f"NOT {HELD.format('orders')} AND NOT {HELD.format('reviews')} AND NOT {HELD.format('carts')}"
J08_CUSTOMERS = f"SELECT customer_id, name FROM m_customers c WHERE {FREE}"
J08_ADDRESSES = f"SELECT address_id, customer_id FROM m_addresses c WHERE {FREE}"
J08_REFUSALS = f"""
SELECT customer_id, CASE WHEN {HELD.format('orders')} THEN 'has orders' WHEN {HELD.format('reviews')} THEN 'has reviews'
  ELSE 'has carts' END AS reason
FROM m_customers c WHERE NOT ({FREE})
"""
_SINCE = {"orders": "order_ts", "reviews": "created_at", "carts": "created_at"}
_RECENT = {t: f"EXISTS (SELECT 1 FROM m_{t} x WHERE x.customer_id = c.customer_id AND x.{ts} >= TIMESTAMP '2000-06-01')" for t, ts in _SINCE.items()}
_IDLE = " AND ".join(f"NOT {held}" for held in _RECENT.values())
J08_ARCHIVED = f"SELECT customer_id, name FROM m_customers c WHERE {_IDLE}"
J08_ARCHIVED_ADDRESSES = f"SELECT address_id, customer_id FROM m_addresses c WHERE {_IDLE}"
J08_ARCHIVED_REFUSALS = f"""
SELECT customer_id, CASE WHEN {_RECENT['orders']} THEN 'has orders' WHEN {_RECENT['reviews']} THEN 'has reviews' ELSE 'has carts' END AS reason
FROM m_customers c WHERE NOT ({_IDLE})
"""
J09 = f"""
SELECT n.product_id, n.name, n.franchise, n.price::DOUBLE AS price, n.promo_price::DOUBLE AS promo_price, n.stock, n.stock_min,
  n.active, CASE WHEN o.product_id IS NOT NULL AND ({DIFFERS}) THEN '2001-07-31 00:00:00.000000'
                 ELSE {stamp('n.updated_at')} END AS updated_at
FROM m_new n LEFT JOIN m_old o USING (product_id)
"""
J10 = """
WITH q AS (SELECT i.*, row_number() OVER (PARTITION BY order_id, product_id ORDER BY item_id, i.qty, unit_price,
             unit_discount NULLS FIRST, subtotal) AS k, count(*) OVER (PARTITION BY order_id, product_id) AS n,
             sum(i.qty) OVER (PARTITION BY order_id, product_id) AS total FROM m_order_items i)
SELECT a.item_id, a.order_id, a.product_id, a.total::BIGINT AS qty, a.unit_price::DOUBLE AS unit_price,
  a.unit_discount::DOUBLE AS unit_discount,
  ((z.unit_price - coalesce(z.unit_discount, 0)) * a.total)::DOUBLE AS subtotal
FROM q a JOIN q z ON z.order_id = a.order_id AND z.product_id = a.product_id AND a.k = 1 AND z.k = z.n
"""
J11 = f"""
SELECT review_id, product_id, customer_id, rating, approved, {stamp('created_at')} AS created_at FROM m_reviews
"""
J12 = f"""
SELECT order_id, nullif(status_id - 1, 0) AS old_status_id, status_id AS new_status_id, 'Automatic status update' AS note,
  'system' AS actor, {stamp('order_ts')} AS created_at
FROM m_orders
"""
J13 = """
SELECT order_id, customer_id, (SELECT a.address_id FROM m_addresses a WHERE a.customer_id = o.customer_id
                               ORDER BY principal DESC, address_id LIMIT 1) AS address_id
FROM m_orders o
"""

SQL = {
    "j01_checkout_orders": J01_ORDERS,
    "j01_checkout_items": J01_ITEMS,
    "j01_checkout_products": J01_PRODUCTS,
    "j02_status_products": J02_PRODUCTS,
    "j09_stamp_orders": J09_ORDERS,
    "j01_checkout_stock_deltas": J01_DELTAS,
    "j01_checkout_coupon_use": J01_COUPONS,
    "j01_checkout_history": J01_HISTORY,
    "j01_checkout_carts": J01_CARTS,
    "j01_checkout_rejects": J01_REJECTS,
    "j02_status_orders": J02_ORDERS,
    "j02_status_history": J02_HISTORY,
    "j02_status_restock": J02_RESTOCK,
    "j02_status_rejects": J02_REJECTS,
    "j03_upsert_cart_lines": J03_CARTS,
    "j03_upsert_cart_rejects": J03_REJECTS,
    "j04_replenish_products": J04_PRODUCTS,
    "j04_replenish_audit": J04_AUDIT,
    "j04_replenish_rejects": J04_REJECTS,
    "j05_change_log": J05,
    "j06_low_stock_alerts": J06,
    "j07_item_subtotals": J07,
    "j08_plan_deletes_customers": J08_CUSTOMERS,
    "j08_plan_deletes_addresses": J08_ADDRESSES,
    "j08_plan_deletes_refusals": J08_REFUSALS,
    "j08_archived_customers": J08_ARCHIVED,
    "j08_archived_addresses": J08_ARCHIVED_ADDRESSES,
    "j08_archived_refusals": J08_ARCHIVED_REFUSALS,
    "j09_stamp_updates": J09,
    "j10_merge_items": J10,
    "j11_dedupe_reviews": J11,
    "j12_backfill_status_history": J12,
    "j13_assign_delivery_address": J13,
}
