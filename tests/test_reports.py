"""Reports on hand-made rows the generated tables do not contain."""

import datetime as dt

from tests.helpers import by_key, rows, shop
from tillspan.operators import extras, lookups, reports, views


def order(order_id, customer_id=1, ts="2024-03-10T12:00:00", total="100", status_id=7, method_id=1, address_id=1, **more):
    return {
        "order_id": order_id, "order_no": f"O{order_id}", "customer_id": customer_id, "address_id": address_id,
        "status_id": status_id, "method_id": method_id, "subtotal": total, "discount": "0", "freight": "0",
        "total": total, "instalments": 1, "order_ts": ts, **more,
    }


def item(order_id, product_id, qty=1, price="10", item_id=None):
    return {
        "item_id": item_id or order_id * 100 + product_id, "order_id": order_id, "product_id": product_id, "qty": qty,
        "unit_price": price, "subtotal": str(float(price) * qty),
    }


def product(product_id, category_id=1, stock=10, stock_min=5, active=True, price="10", **more):
    return {
        "product_id": product_id, "sku": f"S{product_id}", "name": f"P{product_id}", "category_id": category_id,
        "price": price, "stock": stock, "stock_min": stock_min, "active": active, "featured": False, **more,
    }


def customer(customer_id, active=True, created="2024-01-05T00:00:00", birth="1990-03-15", **more):
    return {
        "customer_id": customer_id, "name": f"C{customer_id}", "email": f"c{customer_id}@x.example", "level": 1, "xp": 5,
        "active": active, "created_at": created, "birth_date": birth, **more,
    }


def address(address_id, customer_id, city_id=10, principal=True, postcode="01000000"):
    return {
        "address_id": address_id, "customer_id": customer_id, "city_id": city_id, "principal": principal,
        "postcode": postcode,
    }


def test_sales_detail_keeps_the_last_second_and_ends_before_the_next_day(spark):
    t = shop(
        spark, customers=[customer(1)], addresses=[address(1, 1)], products=[product(1)],
        orders=[order(1, ts="2024-12-31T23:59:59"), order(2, ts="2025-01-01T00:00:00")],
        order_items=[item(1, 1), item(2, 1)],
    )
    assert rows(reports.sales_detail(t, "2024-01-01", "2025-01-01"), "order_no") == [("O1",)]


def test_best_sellers_zeros_ties_and_inactive(spark):
    t = shop(
        spark, products=[product(1), product(2), product(3), product(4, active=False), product(5)],
        orders=[order(1), order(2, status_id=8), order(3)],
        order_items=[item(1, 2, 3), item(2, 1, 3), item(3, 2, 0), item(3, 4, 50)],
        reviews=[
            {"review_id": 1, "product_id": 1, "customer_id": 1, "rating": 5, "approved": True},
            {"review_id": 2, "product_id": 1, "customer_id": 2, "rating": 4, "approved": True},
            {"review_id": 3, "product_id": 1, "customer_id": 3, "rating": 1, "approved": False},
        ],
    )
    found = [r.asDict() for r in reports.best_sellers(t).collect()]
    assert [r["product_id"] for r in found] == [1, 2, 3, 5]
    one, two, three = found[0], found[1], found[2]
    assert (one["units_sold"], one["delivered_orders"], float(one["avg_rating"]), one["n_reviews"]) == (3, 0, 4.5, 2)
    assert (two["units_sold"], two["delivered_orders"]) == (3, 2)
    assert (three["units_sold"], three["revenue"], three["delivered_orders"], three["avg_rating"]) == (0, 0, 0, 0)
    # The tie between 1 and 2 at the limit goes to the lower id.
    assert rows(reports.best_sellers(t, limit=1), "product_id") == [(1,)]


def test_vip_customers_addresses_age_and_silent_customers(spark):
    t = shop(
        spark,
        customers=[customer(1), customer(2, birth=None), customer(3), customer(4, active=False)],
        addresses=[address(12, 1, 20), address(11, 1, 10), address(13, 3, 10, principal=False)],
        orders=[order(1, 1, total="50"), order(2, 3, total="70"), order(3, 4, total="900")],
        order_items=[item(1, 1), item(1, 2), item(2, 1)], products=[product(1), product(2)],
    )
    found = [r.asDict() for r in reports.vip_customers(t, "2024-03-14").collect()]
    assert [r["customer_id"] for r in found] == [3, 1, 2]
    assert [r["main_city"] for r in found] == [None, "Alpha/NS", None]
    assert [r["distinct_products"] for r in found] == [1, 2, 0]
    assert (found[2]["orders"], found[2]["total_spent"], found[2]["avg_order"], found[2]["last_order"]) == (0, 0, 0, None)
    assert found[1]["age"] == 33
    assert by_key(reports.vip_customers(t, "2024-03-15"), "customer_id")[1]["age"] == 34


def test_region_shares_add_up(star):
    df = reports.region_category_revenue(star)
    share = {r["region"]: r["s"] for r in df.groupBy("region").agg({"region_pct": "sum"}).toDF("region", "s").collect()}
    assert all(abs(float(s) - 100) < 1.5 for s in share.values())
    sums = df.groupBy("region").agg({"revenue": "sum", "region_revenue": "max"}).collect()
    assert all(r["sum(revenue)"] == r["max(region_revenue)"] for r in sums)


def test_rollup_total_equals_plain_total_and_counts_an_order_once(spark):
    t = shop(
        spark, customers=[customer(1)], addresses=[address(1, 1)], products=[product(1), product(2, category_id=2)],
        orders=[order(1), order(2)], order_items=[item(1, 1), item(1, 2), item(2, 2)],
    )
    found = {(r["region"], r["state"], r["category"]): (r["level"], r["orders"], float(r["revenue"]))
             for r in reports.region_category_rollup(t).collect()}
    assert found[(None, None, None)] == (7, 2, 30.0)
    assert found[("North", "NS", None)] == (1, 2, 30.0)
    assert found[("North", "NS", "Figures")] == (0, 1, 10.0)
    assert found[("North", "NS", "Games")] == (0, 2, 20.0)


def test_cart_conversion(spark):
    cart = {"cart_id": 1, "customer_id": 1, "session_id": "s", "product_id": 1, "qty": 4}
    t = shop(
        spark, products=[product(1), product(2, active=False), product(3)],
        carts=[cart, {**cart, "cart_id": 2, "customer_id": None, "qty": 1}, {**cart, "cart_id": 3, "product_id": 2}],
        orders=[order(1), order(2, status_id=8), order(3, status_id=10)],
        order_items=[item(1, 1, 2), item(2, 1, 1), item(3, 1, 3)],
    )
    (only,) = reports.cart_conversion(t).collect()
    assert (only["cart_lines"], only["cart_units"], only["interested_customers"]) == (2, 5, 1)
    assert (only["units_sold"], only["completed_orders"]) == (6, 1)
    assert (float(only["conversion_pct"]), only["abandon_potential"]) == (120.0, -1)


def months_shop(spark):
    return shop(
        spark, products=[product(1), product(2)],
        orders=[
            order(1, ts="2023-03-05T00:00:00", total="100"), order(2, ts="2024-01-05T00:00:00", total="100"),
            order(3, ts="2024-03-05T00:00:00", total="300"), order(4, ts="2024-03-06T00:00:00", total="50", status_id=8),
        ],
        order_items=[item(1, 1), item(2, 1), item(2, 2), item(3, 1), item(4, 1)],
    )


def test_monthly_trend_repeats_orders_per_item_and_looks_back_by_position(spark):
    january, march = reports.monthly_trend(months_shop(spark), "2024-01-01").collect()
    assert float(january["revenue"]) == 200.0 and january["orders"] == 1 and january["items_sold"] == 2
    assert float(march["revenue"]) == 300.0
    assert float(march["prev_month_revenue"]) == 200.0 and float(march["monthly_growth_pct"]) == 50.0
    assert march["prev_year_revenue"] is None and january["prev_month_revenue"] is None
    assert (march["revenue_rank"], january["revenue_rank"]) == (1, 2)


def test_monthly_trend_order_grain_follows_the_calendar(spark):
    january, february, march = reports.monthly_trend_order_grain(months_shop(spark), "2024-01-01").collect()
    assert float(january["revenue"]) == 100.0
    assert (february["orders"], float(february["revenue"]), float(february["monthly_growth_pct"])) == (0, 0.0, -100.0)
    assert march["prev_month_revenue"] is None and march["monthly_growth_pct"] is None
    assert float(march["prev_year_revenue"]) == 100.0 and float(march["yearly_growth_pct"]) == 200.0
    assert float(march["moving_avg_3m"]) == 200.0


def test_payment_performance_ties_and_unused_methods(spark):
    t = shop(
        spark, customers=[customer(1)], addresses=[address(1, 1, 20), address(2, 1, 10)],
        orders=[
            order(1, address_id=1, status_id=2, payment_ts="2024-03-10T15:30:00"), order(2, address_id=2, status_id=8),
            order(3, method_id=3),
        ],
    )
    found = by_key(reports.payment_performance(t), "payment_method")
    assert set(found) == {"Card", "Transfer"}
    assert found["Card"]["main_region"] == "North"
    assert float(found["Card"]["hours_to_payment"]) == 3.5
    assert (float(found["Card"]["success_pct"]), float(found["Card"]["cancel_pct"])) == (50.0, 50.0)
    assert found["Transfer"]["orders"] == 0 and found["Transfer"]["success_pct"] is None


def test_cohorts_with_early_orders_and_silent_customers(spark):
    t = shop(
        spark,
        customers=[customer(1, created="2024-03-20T00:00:00"), customer(2, created="2024-03-01T00:00:00"),
                   customer(3, created="2024-04-01T00:00:00")],
        orders=[
            order(1, 1, ts="2024-01-15T00:00:00", total="10"), order(2, 1, ts="2024-03-25T00:00:00", total="20"),
            order(3, 1, ts="2024-06-01T00:00:00", total="30"), order(4, 1, ts="2024-06-02T00:00:00", total="30"),
        ],
    )
    march, april = reports.cohort_retention(t, "2024-01-01").collect()
    assert (march["registered"], march["bought_month_0"], march["bought_month_3"], march["orders"]) == (2, 1, 1, 4)
    assert float(march["cohort_value"]) == 90.0 and float(march["ltv_3m"]) == 90.0
    assert float(march["conversion_month_0"]) == 50.0 and float(march["retention_month_3"]) == 100.0
    assert (april["registered"], april["orders"], april["cohort_value"], april["ltv_3m"]) == (1, 0, None, None)
    (line,) = reports.cohort_matrix(t, "2024-01-01").collect()
    assert (line["m0"], line["m1"], line["m3"]) == (1, None, 1)


def test_stockout_classes_and_trend(spark):
    t = shop(
        spark,
        products=[product(1, stock=0), product(2, stock=5), product(3, stock=10), product(4, stock=11),
                  product(5, stock=7), product(6, stock=4, active=False), product(7, stock=5)],
        orders=[order(1, ts="2024-03-10T12:00:00"), order(2, ts="2024-02-15T00:00:00"), order(3, ts="2024-03-11T00:00:00")],
        order_items=[item(1, 5, 30), item(2, 7, 3), item(3, 5, 99)],
        carts=[{"cart_id": 1, "customer_id": 1, "session_id": "s", "product_id": 2, "qty": 6}],
    )
    found = [r.asDict() for r in reports.stockout_forecast(t, "2024-03-10").collect()]
    assert [(r["product_id"], r["stock_status"]) for r in found] == [
        (1, "RUPTURE"), (5, "CRITICAL"), (7, "LOW"), (2, "LOW"), (3, "ATTENTION")
    ]
    five, seven, two = found[1], found[2], found[3]
    assert (five["sold_30d"], float(five["days_left"]), float(five["avg_per_sale_day"])) == (30, 7.0, 30.0)
    assert float(five["trend_pct"]) == 328.6
    assert seven["trend_pct"] is None and (two["trend_pct"], two["days_left"]) == (0, None)
    assert two["effective_stock"] == -1


def test_dashboard_of_a_month_without_sales_is_one_row(spark):
    t = shop(spark, customers=[customer(1)], products=[product(1)], orders=[order(1, ts="2024-02-10T00:00:00")],
             order_items=[item(1, 1)])
    (row,) = reports.executive_dashboard(t, "2024-03-31").collect()
    assert (row["orders_month"], row["orders_prev_month"], row["top_category"], row["revenue_month"]) == (0, 1, None, None)
    assert float(row["orders_change_pct"]) == -100.0 and row["cart_lines"] == 0
    assert reports.dashboard_long(t, "2024-03-31").count() == len(row)


def test_anonymous_carts_are_told_apart(spark):
    line = {"cart_id": 1, "customer_id": None, "session_id": "a", "product_id": 1, "qty": 1}
    t = shop(spark, products=[product(1, promo_price="8")], carts=[line, {**line, "cart_id": 2, "session_id": "b"},
             {**line, "cart_id": 3, "customer_id": 5}, {**line, "cart_id": 4, "customer_id": 5, "qty": 2}])
    (row,) = reports.executive_dashboard(t, "2024-03-31").collect()
    assert (row["cart_lines"], row["distinct_carts"], float(row["cart_value"])) == (4, 3, 40.0)


def test_product_summary(spark):
    t = shop(spark, products=[product(1, price="0", promo_price="0"), product(2, price="10", promo_price="7.5", stock=5),
                              product(3, stock=0)])
    found = by_key(views.product_summary(t), "product_id")
    assert float(found[1]["discount_pct"]) == 0 and float(found[2]["discount_pct"]) == 25.0
    assert float(found[2]["final_price"]) == 7.5 and float(found[3]["final_price"]) == 10
    assert [found[n]["stock_status"] for n in (1, 2, 3)] == ["Available", "Low stock", "Out of stock"]
    assert (found[1]["avg_rating"], found[1]["n_reviews"]) == (0, 0)


def test_customer_stats_ties_and_customers_without_orders(spark):
    t = shop(
        spark, customers=[customer(1), customer(2)],
        products=[product(1, franchise="Zeta"), product(2, franchise="Beta"), product(3)],
        orders=[order(1, status_id=7), order(2, status_id=8)],
        order_items=[item(1, 1), item(1, 3), item(2, 2), item(2, 3)],
    )
    (only,) = lookups.customer_stats(t).collect()
    assert (only["customer_id"], only["favourite_franchise"], only["usual_status"]) == (1, "Beta", "Cancelled")
    assert only["first_order"] == dt.date(2024, 3, 10)


def test_top_products_filters_and_unsold(spark):
    t = shop(spark, products=[product(1, 1, franchise="A"), product(2, 2, franchise="A"), product(3, 2), product(4, active=False)],
             orders=[order(1)], order_items=[item(1, 3, 2), item(1, 4, 9)])
    assert [r["product_id"] for r in lookups.top_products(t).collect()] == [3, 1, 2]
    assert rows(lookups.top_products(t, category_id=2), "product_id", "units_sold") == [(2, 0), (3, 2)]
    assert rows(lookups.top_products(t, franchise="A", limit=1), "product_id") == [(1,)]


def test_daily_revenue_includes_both_ends(spark):
    t = shop(spark, orders=[order(1, ts="2024-03-01T00:00:00"), order(2, ts="2024-03-02T23:59:59"),
                            order(3, ts="2024-03-03T00:00:00"), order(4, ts="2024-03-02T01:00:00", status_id=10)])
    found = rows(lookups.daily_revenue(t, "2024-03-01", "2024-03-02"), "day", "orders", "net")
    assert found == [(dt.date(2024, 3, 1), 1, 100.0), (dt.date(2024, 3, 2), 1, 100.0)]


def test_rank_in_category_counts_every_better_product(spark):
    t = shop(spark, products=[product(n) for n in range(1, 7)], orders=[order(1)],
             order_items=[item(1, n, 1, price) for n, price in enumerate(["5", "900", "5", "901", "0", "900"], 1)])
    found = {r["product_id"]: r["category_rank"] for r in extras.product_rank_in_category(t).collect()}
    assert found == {4: 1, 2: 2, 6: 2, 1: 4, 3: 4, 5: 6}
