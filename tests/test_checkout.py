"""Checkout against a one-by-one simulation, and its invariants."""

import random

import pytest

from tests.helpers import by_key, make, rows, statuses
from tests.test_jobs import coupon
from tests.test_reports import address, product
from tillspan.operators import checkout as module
from tillspan.operators.checkout import checkout
from tillspan.plans.lineage import cut


def request(n, customer_id, minute, address_id=None, code=None):
    return {
        "request_id": n, "ts": f"2024-03-10T10:{minute:02d}:00", "customer_id": customer_id,
        "address_id": customer_id if address_id is None else address_id, "method_id": 1, "coupon_code": code,
    }


def cart(n, customer_id, product_id, qty):
    return {"cart_id": n, "customer_id": customer_id, "session_id": "s", "product_id": product_id, "qty": qty}


def run(spark, requests, carts, products, addresses, coupons, **options):
    return checkout(
        make(spark, "checkout_requests", requests), make(spark, "carts", carts), make(spark, "products", products),
        make(spark, "addresses", addresses), make(spark, "coupons", coupons), statuses(spark), **options,
    )


def test_small_cases(spark):
    done = run(
        spark,
        [request(1, 1, 5), request(2, 2, 4, code="ten"), request(3, 3, 1), request(4, 2, 9), request(5, 4, 1, address_id=99),
         request(6, 4, 2), request(7, 5, 1), request(8, 1, 6)],
        [cart(1, 1, 1, 1), cart(2, 2, 1, 1), cart(3, None, 1, 1), cart(4, 4, 2, 1), cart(5, 5, 3, 1)],
        [product(1, stock=1, price="299", promo_price="299.00"), product(2, price="298.99"), product(3, active=False)],
        [address(n, n, postcode="71234567") for n in range(1, 6)], [coupon("TEN")],
    )
    assert rows(done.rejects) == [
        (1, "insufficient stock"), (3, "empty cart"), (4, "empty cart"), (5, "unknown address"), (7, "insufficient stock"),
        (8, "insufficient stock"),
    ]
    placed = by_key(done.orders, "order_id")
    assert {k: tuple(float(v[c]) for c in ("subtotal", "discount", "freight", "total")) for k, v in placed.items()} == {
        2: (299.0, 29.9, 0.0, 269.1), 6: (298.99, 0.0, 52.0, 350.99)
    }
    assert rows(done.stock_deltas) == [(1, -1), (2, -1)]
    assert rows(done.coupon_use) == [("TEN", 1)]
    assert rows(done.carts, "cart_id") == [(1,), (3,), (5,)]
    assert rows(done.history, "order_id", "new_status_id") == [(2, 1), (6, 1)]


# Everything in one fold, groups of any size, and groups cut after a few lines.
@pytest.mark.parametrize(("seed", "fold_lines"), [(0, 4000), (1, 25), (2, 3), (0, 1)])
def test_equals_one_by_one_processing(spark, seed, fold_lines):
    draw = random.Random(seed)
    products = [product(n, stock=draw.randrange(0, 14), price=str(draw.randrange(1, 90)), active=draw.random() > 0.1) for n in range(8)]
    carts = [cart(n, draw.randrange(30), draw.randrange(8), draw.randrange(1, 4)) for n in range(90)]
    requests = [
        request(n, draw.randrange(30), draw.randrange(12), address_id=-1 if draw.random() < 0.1 else None,
                code=draw.choice([None, "few", "min"]))
        for n in range(50)
    ]
    coupons = [coupon("FEW", max_uses=4, used=1), coupon("MIN", kind="FIXED", value="9", min_order="150")]
    addresses = [address(n, n, postcode=f"{n % 10}000") for n in range(30)]

    stock = {p["product_id"]: p["stock"] for p in products if p["active"]}
    price = {p["product_id"]: float(p["price"]) for p in products}
    held: dict[int, dict[int, int]] = {}
    for line in carts:
        lines = held.setdefault(line["customer_id"], {})
        lines[line["product_id"]] = lines.get(line["product_id"], 0) + line["qty"]
    used, placed, refused = 1, {}, {}
    for r in sorted(requests, key=lambda r: (r["ts"], r["request_id"])):
        lines = held.get(r["customer_id"], {})
        value = sum(q * price[p] for p, q in lines.items())
        if value == 0:
            refused[r["request_id"]] = "empty cart"
        elif r["address_id"] == -1:
            refused[r["request_id"]] = "unknown address"
        elif any(stock.get(p, -1) < q for p, q in lines.items()):
            refused[r["request_id"]] = "insufficient stock"
        else:
            for p, q in lines.items():
                stock[p] -= q
            cut = 0.0
            if r["coupon_code"] == "few" and used < 4:
                cut, used = round(value / 10, 2), used + 1
            elif r["coupon_code"] == "min" and value >= 150:
                cut = 9.0
            placed[r["request_id"]] = (value, cut)
            held[r["customer_id"]] = {}

    done = run(spark, requests, carts, products, addresses, coupons, fold_lines=fold_lines)
    assert {r["request_id"]: r["reason"] for r in done.rejects.collect()} == refused
    assert {r["order_id"]: (float(r["subtotal"]), float(r["discount"])) for r in done.orders.collect()} == placed
    sold = {r["product_id"]: -r["delta"] for r in done.stock_deltas.collect()}
    begin = {p["product_id"]: p["stock"] for p in products}
    assert all(begin[p] - q == stock[p] >= 0 for p, q in sold.items())
    assert all(r["total"] == r["subtotal"] - r["discount"] + r["freight"] for r in done.orders.collect())


def chain(n):
    """Each request wants the product its predecessor wants, and the next one; a product has one piece."""
    carts = [cart(2 * k + j, k, k + j, 1) for k in range(n) for j in (0, 1)]
    made = [{**request(k, k, 0), "ts": f"2024-03-10T{k // 3600:02d}:{k // 60 % 60:02d}:{k % 60:02d}"} for k in range(n)]
    return made, carts, [product(k, stock=1) for k in range(n + 1)], [address(k, k) for k in range(n)], []


def test_a_chain_of_a_thousand_needs_few_checkpoints(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(module, "cut", lambda df: calls.append(1) or cut(df))
    done = run(spark, *chain(1000))
    # Every second request finds the piece gone that the one before it took.
    assert sorted(r["order_id"] for r in done.orders.collect()) == list(range(0, 1000, 2))
    assert len(calls) <= 5


def test_a_chain_cut_into_pieces(spark):
    done = run(spark, *chain(60), fold_lines=25)
    assert sorted(r["order_id"] for r in done.orders.collect()) == list(range(0, 60, 2))


def test_without_an_initial_state_orders_are_kept(spark):
    done = checkout(
        make(spark, "checkout_requests", [request(1, 1, 5)]), make(spark, "carts", [cart(1, 1, 1, 1)]), make(spark, "products", [product(1)]),
        make(spark, "addresses", [address(1, 1)]), make(spark, "coupons", []), statuses(spark).limit(0),
    )
    assert rows(done.orders, "order_id", "status_id") == [(1, None)]
