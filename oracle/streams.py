"""What the streaming jobs must have emitted once all input is read, and what a round trip through files keeps."""

from oracle.jobs import J05
from oracle.model import day, stamp

# A day is out once an order more than one day after its end was seen.
S01 = f"""
SELECT {day('order_ts::DATE')} AS day, count(*) AS orders, sum(subtotal)::DOUBLE AS gross, sum(discount)::DOUBLE AS discounts,
  sum(freight)::DOUBLE AS freight, sum(total)::DOUBLE AS net
FROM m_orders WHERE status_id NOT IN (8, 10) GROUP BY order_ts::DATE
HAVING order_ts::DATE + INTERVAL 1 DAY <= (SELECT max(order_ts) FROM m_orders) - INTERVAL 1 DAY
"""

S02 = f"""
WITH hourly AS (SELECT product_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS period_end, sum(delta) AS delta
                FROM m_stock_deltas GROUP BY 1, 2),
levels AS (SELECT h.product_id, period_end, p.stock_min, h.delta,
             p.stock + sum(h.delta) OVER (PARTITION BY h.product_id ORDER BY period_end ROWS UNBOUNDED PRECEDING) AS stock
           FROM hourly h JOIN m_products p USING (product_id))
SELECT product_id, {stamp('period_end')} AS period_end, (stock - delta)::BIGINT AS stock_before, stock::BIGINT AS stock, stock_min
FROM levels WHERE stock <= stock_min AND stock - delta > stock_min
AND period_end <= (SELECT max(ts) FROM m_stock_deltas) - INTERVAL 10 MINUTE
"""

L02 = f"""
SELECT order_id, order_no, customer_id, status_id, total::DOUBLE AS total, coupon_code, {stamp('order_ts')} AS order_ts,
  {stamp('payment_ts')} AS payment_ts, strftime(order_ts, '%Y-%m') AS month
FROM m_orders WHERE order_ts >= TIMESTAMP '1996-01-15' AND order_ts < TIMESTAMP '2001-01-15'
"""

# One month holds the lines of more than ten units alone.
L02_ITEMS = f"""
SELECT item_id, order_id, product_id, qty::BIGINT AS qty, i.subtotal::DOUBLE AS subtotal, strftime(order_ts, '%Y-%m') AS month,
  {stamp('order_ts')} AS order_ts
FROM m_order_items i JOIN m_orders o USING (order_id)
WHERE order_ts >= TIMESTAMP '1997-12-10' AND order_ts < TIMESTAMP '1998-04-20'
AND (strftime(order_ts, '%Y-%m') <> '1998-02' OR qty > 10)
"""

L02_BUCKETS = """
SELECT order_id, customer_id, total::DOUBLE AS total, count(*) AS n_items, sum(qty)::BIGINT AS units, sum(i.subtotal)::DOUBLE AS items_value
FROM m_order_items i JOIN m_orders o USING (order_id) GROUP BY ALL
"""

L03 = "\nUNION ALL\n".join(
    f"SELECT '{column}' AS \"column\", count(*) - count({column}) AS num_nulls, min({column})::VARCHAR AS min, max({column})::VARCHAR AS max FROM m_products"
    for column in ("product_id", "category_id", "stock", "price", "promo_price")
)

SQL = {
    "l02_write_and_load": L02,
    "l02_items_round_trip": L02_ITEMS,
    "l02_bucketed_join": L02_BUCKETS,
    "l03_column_statistics": L03,
    "s01_stream_daily_revenue": S01,
    "s02_stream_low_stock": S02,
    "s03_stream_change_log": J05,
}
