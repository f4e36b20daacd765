"""Rules and batch jobs on hand-made rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import by_key, make, rows, statuses
from tests.test_reports import address, customer, item, order, product
from tillspan.operators import jobs, rules


def test_clean_customers(spark):
    df = make(spark, "customers", [
        {**customer(1, birth="2000-02-29"), "name": "José Ação", "email": "  Ana@Mail.COM ", "tax_id": "12345678901"},
        {**customer(2, birth=None), "email": "no-at.example", "tax_id": "123"},
        {**customer(3), "email": "a@b.c"},
    ])
    found = by_key(rules.clean_customers(df, "2024-02-28"), "customer_id")
    assert found[1]["plain_name"] == "Jose Acao" and found[1]["email"] == "ana@mail.com" and found[1]["email_valid"]
    assert found[1]["tax_id"] == "123.456.789-01" and found[1]["age"] == 23
    assert (found[2]["tax_id"], found[2]["age"], found[2]["email_valid"]) == (None, None, False)
    assert (found[3]["tax_id"], found[3]["email_valid"]) == (None, False)


def test_price_list(spark):
    df = make(spark, "products", [product(1, price="3", promo_price="1"), product(2, price="0", promo_price="0"), product(3)])
    assert rows(rules.price_list(df), "product_id", "final_price", "discount_pct") == [
        (1, 1.0, 66.67), (2, 0.0, 0.0), (3, 10.0, 0.0)
    ]


def test_availability(spark):
    goods = make(spark, "products", [product(1, stock=3), product(2, stock=9, active=False)])
    lines = spark.createDataFrame([(1, 3), (1, 4), (2, 1), (9, 1)], "product_id bigint, qty int")
    assert rows(rules.check_availability(lines, goods)) == [(1, 3, True), (1, 4, False), (2, 1, False), (9, 1, False)]


def test_freight_by_digit_weight_and_limit(spark):
    digits = make(spark, "freight_requests", [
        {"request_id": n, "postcode": f"{d}1234567", "value": "298.99", "weight_kg": "1.500"} for n, d in enumerate("0123456789X")
    ])
    fees = [r["freight"] for r in rules.quote_freight(digits).orderBy("request_id").collect()]
    assert [float(f) for f in fees] == [28, 28, 33, 33, 38, 43, 48, 53, 38, 43, 43]
    edge = make(spark, "freight_requests", [
        {"request_id": 1, "postcode": "7", "value": "299.00", "weight_kg": "9"},
        {"request_id": 2, "postcode": None, "value": "10", "weight_kg": None},
        {"request_id": 3, "postcode": "0", "value": "10", "weight_kg": "0.333"},
    ])
    assert rows(rules.quote_freight(edge), "request_id", "freight") == [(1, 0.0), (2, 42.0), (3, 25.67)]


def coupon(code, kind="PERCENT", value="10", min_order="0", **more):
    return {
        "coupon_id": 1, "code": code, "kind": kind, "value": value, "min_order": min_order, "used": 0, "active": True,
        "starts": "2024-01-01", "ends": "2024-12-31", **more,
    }


def test_coupons(spark):
    coupons = make(spark, "coupons", [
        coupon("TEN"), coupon("OLD", ends="2024-02-01"), coupon("CAPPED", max_uses=3, used=3), coupon("ALMOST", max_uses=3, used=2),
        coupon("BIG", kind="FIXED", value="500"), coupon("MIN", min_order="100.01"), coupon("OFF", active=False),
    ])
    codes = ["ten", "OLD", "CAPPED", "ALMOST", "BIG", "MIN", "OFF", "NONE", None]
    orders = make(spark, "orders", [order(n, total="100.00", coupon_code=c) for n, c in enumerate(codes)])
    found = rules.apply_coupons(orders, coupons, "2024-03-10")
    cuts = [float(r["coupon_discount"]) for r in found.orderBy("order_id").collect()]
    assert cuts == [10, 0, 0, 10, 100, 0, 0, 0, 0]


def request(n, order_id, status, minute=None):
    return {
        "request_id": n, "ts": f"2024-05-01T10:{minute if minute is not None else n:02d}:00", "order_id": order_id,
        "new_status_id": status, "actor": "clerk",
    }


def test_status_changes(spark):
    orders = make(spark, "orders", [order(1, status_id=1), order(2, status_id=4), order(3, status_id=9)])
    items = make(spark, "order_items", [item(1, 5, 2), item(2, 5, 3)])
    asked = make(spark, "status_requests", [
        request(1, 1, 2), request(2, 1, 2), request(3, 1, 1), request(4, 1, 7),
        request(5, 2, 8), request(6, 2, 8), request(7, 2, 5), request(8, 2, 10),
        request(9, 3, 8), request(10, 99, 2), request(11, 1, 77),
    ])
    done = jobs.apply_status_changes(asked, orders, items, statuses(spark))
    assert rows(done.rejects) == [(10, "unknown order"), (11, "unknown status"), (3, "backward step"), (7, "backward step")]
    assert rows(done.history, "request_id", "old_status_id", "new_status_id") == [
        (1, 1, 2), (2, 2, 2), (4, 2, 7), (5, 4, 8), (6, 8, 8), (8, 8, 10), (9, 9, 8)
    ]
    found = by_key(done.orders, "order_id")
    assert [found[n]["status_id"] for n in (1, 2, 3)] == [7, 10, 8]
    assert found[1]["payment_ts"] == dt.datetime(2024, 5, 1, 10, 2) and found[1]["delivery_ts"] == dt.datetime(2024, 5, 1, 10, 4)
    assert rows(done.restock) == [(5, 6)]


@pytest.mark.parametrize("seed", range(3))
def test_status_running_maximum_equals_the_fold(spark, seed):
    import random

    draw = random.Random(seed)
    asked = [request(n, draw.randrange(4), draw.randrange(1, 12), draw.randrange(20)) for n in range(120)]
    orders = [order(n, status_id=1 + n * 2) for n in range(4)]
    state = {o["order_id"]: o["status_id"] for o in orders}
    refused = set()
    for r in sorted(asked, key=lambda r: (r["ts"], r["request_id"])):
        new = r["new_status_id"]
        if new > 10 or (new < state[r["order_id"]] and new < 8):
            refused.add(r["request_id"])
        else:
            state[r["order_id"]] = new
    done = jobs.apply_status_changes(
        make(spark, "status_requests", asked), make(spark, "orders", orders), make(spark, "order_items", []), statuses(spark)
    )
    assert {r["request_id"] for r in done.rejects.collect()} == refused
    assert {r["order_id"]: r["status_id"] for r in done.orders.collect()} == state


def test_upsert_cart(spark):
    goods = make(spark, "products", [product(1, stock=5), product(2, active=False)])
    carts = make(spark, "carts", [
        {"cart_id": 7, "customer_id": 1, "product_id": 1, "qty": 2}, {"cart_id": 8, "customer_id": 1, "product_id": 1, "qty": 4},
        {"cart_id": 9, "customer_id": None, "session_id": "s", "product_id": 1, "qty": 1},
    ])
    adds = make(spark, "cart_adds", [
        {"request_id": n, "ts": "2024-01-01T00:00:00", "customer_id": c, "product_id": p, "qty": q}
        for n, c, p, q in [(1, 1, 1, 5), (2, 1, 1, 5), (3, 1, 1, 6), (4, 2, 1, 1), (5, 2, 1, 2), (6, 1, 2, 1), (7, 1, 3, 1)]
    ])
    done = jobs.upsert_cart(adds, carts, goods, cart_id_base=100)
    assert rows(done.carts, "cart_id", "customer_id", "qty") == [(104, 2, 3), (7, 1, 12), (8, 1, 4), (9, None, 1)]
    assert rows(done.rejects) == [
        (3, "insufficient stock"), (6, "product missing or inactive"), (7, "product missing or inactive")
    ]


def test_replenish(spark):
    goods = make(spark, "products", [product(1, stock=5), product(2, stock=1)])
    asked = make(spark, "replenish_requests", [
        {"request_id": n, "ts": ts, "product_id": p, "qty": q, "actor": "a"}
        for n, ts, p, q in [(1, "2024-01-02T00:00:00", 1, 10), (2, "2024-01-01T00:00:00", 1, 3), (3, "2024-01-01T00:00:00", 9, 1)]
    ])
    done = jobs.replenish(asked, goods)
    assert rows(done.products, "product_id", "stock") == [(1, 18), (2, 1)]
    audit = by_key(done.audit, "request_id")
    assert json.loads(audit[2]["old_row"]) == {"stock": 5} and json.loads(audit[2]["new_row"]) == {"stock": 8, "restocked": 3}
    assert json.loads(audit[1]["old_row"]) == {"stock": 8} and json.loads(audit[1]["new_row"]) == {"stock": 18, "restocked": 10}
    assert rows(done.rejects) == [(3, "unknown product")]


def snapshots(spark):
    base = dict(created_at="2024-01-01T00:00:00", updated_at="2024-01-01T00:00:00")
    old = make(spark, "products", [
        product(1, **base), product(2, stock=6, **base), product(3, **base), product(4, franchise=None, **base)
    ])
    new = make(spark, "products", [
        product(1, **base), product(2, stock=5, **base), product(4, franchise="F", **base), product(5, stock=2, **base)
    ])
    return old, new


def test_change_log_turns_old_into_new(spark):
    old, new = snapshots(spark)
    log = jobs.change_log(old, new, "product_id", "products")
    assert rows(log, "row_id", "op") == [(2, "UPDATE"), (3, "DELETE"), (4, "UPDATE"), (5, "INSERT")]
    entries = by_key(log, "row_id")
    assert json.loads(entries[4]["old_row"])["franchise"] is None and json.loads(entries[4]["new_row"])["franchise"] == "F"
    assert entries[3]["new_row"] is None and entries[5]["old_row"] is None
    parsed = log.select("row_id", F.from_json("new_row", new.schema).alias("r"))
    kept = old.join(log.select(F.col("row_id").alias("product_id")), "product_id", "left_anti")
    rebuilt = kept.unionByName(parsed.filter("r is not null").select("r.*"))
    assert rows(rebuilt) == rows(new)


def test_low_stock_alerts_only_on_crossing(spark):
    old, new = snapshots(spark)
    assert rows(jobs.low_stock_alerts(old, new), "product_id", "stock_before", "stock") == [(2, 6, 5)]
    assert jobs.low_stock_alerts(new, new).count() == 0


def test_stamp_updates(spark):
    old, new = snapshots(spark)
    stamped = by_key(jobs.stamp_updates(old, new, "product_id", F.lit("2024-06-01").cast("timestamp_ntz")), "product_id")
    changed = {k for k, v in stamped.items() if v["updated_at"] == dt.datetime(2024, 6, 1)}
    assert set(stamped) == {1, 2, 4, 5} and changed == {2, 4}


def test_item_subtotals_and_merge(spark):
    items = make(spark, "order_items", [
        {"item_id": 1, "order_id": 1, "product_id": 1, "qty": 2, "unit_price": "10", "unit_discount": "1", "subtotal": "999"},
        {"item_id": 2, "order_id": 1, "product_id": 1, "qty": 3, "unit_price": "12", "unit_discount": None, "subtotal": "0"},
        {"item_id": 3, "order_id": 1, "product_id": 2, "qty": 1, "unit_price": "5", "unit_discount": "0.5", "subtotal": "0"},
    ])
    assert rows(jobs.item_subtotals(items), "item_id", "subtotal") == [(1, 18.0), (2, 36.0), (3, 4.5)]
    assert rows(jobs.merge_items(items), "item_id", "qty", "unit_price", "unit_discount", "subtotal") == [
        (1, 5, 10.0, 1.0, 60.0), (3, 1, 5.0, 0.5, 4.5)
    ]


def test_plan_deletes(spark):
    people = make(spark, "customers", [customer(n) for n in range(1, 6)])
    asked = spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 4, 77)], "customer_id bigint")
    plan = jobs.plan_deletes(
        asked, people, make(spark, "orders", [order(1, 1)]), make(spark, "addresses", [address(1, 1), address(4, 4), address(5, 5)]),
        make(spark, "reviews", [{"review_id": 1, "product_id": 1, "customer_id": 2, "rating": 3}]),
        make(spark, "carts", [{"cart_id": 1, "customer_id": 3, "product_id": 1, "qty": 1}, {"cart_id": 2, "product_id": 1, "qty": 1}]),
    )
    assert rows(plan.customers, "customer_id") == [(4,)] and rows(plan.addresses, "address_id") == [(4,)]
    assert rows(plan.refusals) == [(1, "has orders"), (2, "has reviews"), (3, "has carts")]


def test_dedupe_reviews(spark):
    sent = make(spark, "reviews", [
        {"review_id": n, "product_id": p, "customer_id": c, "rating": r} for n, p, c, r in [(5, 1, 1, 5), (3, 1, 1, 2), (4, 2, 1, 4)]
    ])
    assert rows(jobs.dedupe_reviews(sent), "review_id", "rating") == [(3, 2), (4, 4)]


def test_history_and_addresses(spark):
    orders = make(spark, "orders", [order(1, 1, status_id=1), order(2, 2, status_id=5), order(3, 3)])
    assert rows(jobs.backfill_status_history(orders), "order_id", "old_status_id", "new_status_id") == [
        (1, None, 1), (2, 4, 5), (3, 6, 7)
    ]
    homes = make(spark, "addresses", [
        address(10, 1, principal=False), address(12, 1), address(11, 1), address(21, 2, principal=False), address(20, 2, principal=False)
    ])
    assert rows(jobs.assign_delivery_address(orders, homes), "order_id", "address_id") == [(1, 11), (2, 20), (3, None)]
