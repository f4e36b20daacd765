import re

from tests.helpers import make, rows, statuses
from tests.test_reports import customer, order, product
from tillspan.catalog import ALSO_REQUIRED
from tillspan.operators import quality
from tillspan.plans.inspect import plan_text
from tillspan.sources.constraints import RULES
from tillspan.sources.tables import Retail


def test_unique_ignores_nulls(spark):
    df = make(spark, "customers", [{**customer(1), "tax_id": t} for t in ("a", "a", "a", "b", None, None)])
    assert rows(quality.check_unique(df, ["tax_id"], "tax")) == [("tax", 1)]
    assert rows(quality.duplicate_keys(df, ["tax_id"])) == [("a", 3)]


def test_references_skip_nulls(spark):
    orders = make(spark, "orders", [order(1, 1), order(2, 9), order(3, 9), {**order(4), "customer_id": None}])
    people = make(spark, "customers", [customer(1)])
    assert rows(quality.check_references(orders, people, "customer_id", "customer_id", "fk")) == [("fk", 2)]
    assert rows(quality.orphan_rows(orders, people, "customer_id", "customer_id"), "order_id") == [(2,), (3,)]


def test_rules_pass_nulls_and_name_the_broken_ones(spark):
    df = make(spark, "products", [
        product(1), product(2, price="-1", promo_price=None), product(3, price="5", promo_price="5"), {**product(4), "price": None}
    ])
    counts = dict(rows(quality.check_rules(df, RULES["products"])))
    assert counts == {"price": 1, "promo_price": 0, "cost": 0, "stock": 0, "promo_below_price": 1}
    assert rows(quality.broken_rows(df, RULES["products"]).selectExpr("product_id", "concat_ws(',', broken)")) == [
        (2, "price"), (3, "promo_below_price")
    ]


def test_there_are_22_rules_and_20_references():
    from tillspan.sources.constraints import REFERENCES, REQUIRED, UNIQUE

    assert sum(len(r) for r in RULES.values()) == 22
    assert len(REFERENCES) == 20 and len(UNIQUE) == len(REQUIRED) == 15


def test_required_and_counts(spark):
    df = make(spark, "customers", [customer(1), {**customer(2), "email": None}])
    assert rows(quality.check_required(df, ["name", "email"])) == [("email", 1), ("name", 0)]
    assert rows(quality.table_counts(Retail.of(customers=df), ["customers"])) == [("customers", 2)]


def test_all_rules_are_listed_and_missing_tables_are_shown_as_unchecked(spark, star):
    assert [quality.all_unique(star).count(), quality.all_references(star).count(), quality.all_rules(star).count()] == [27, 20, 22]
    assert quality.all_required(star, ALSO_REQUIRED).count() == 69
    assert all(q(star).filter("violations is null").isEmpty() for q in (quality.all_unique, quality.all_references, quality.all_rules, quality.all_required))
    few = Retail.of(
        orders=make(spark, "orders", [order(1, 1), order(2, 9), order(3, 9), {**order(4, 1), "status_id": None}]),
        customers=make(spark, "customers", [customer(1)]), order_status=statuses(spark),
    )
    found = {r["rule"]: r["violations"] for r in quality.all_references(few).collect()}
    assert {k: v for k, v in found.items() if v is not None} == {"orders.customer_id -> customers.customer_id": 2, "orders.status_id -> order_status.status_id": 0}
    assert len(found) == 20
    assert sum(r["violations"] is None for r in quality.all_rules(few).collect()) == 22 - 4 - 3


def test_references_are_checked_in_one_scan_per_table_and_one_shuffle(spark, star, tmp_path):
    names = ("orders", "order_status", "customers", "payment_methods")
    for name in names:
        getattr(star, name).write.parquet(f"{tmp_path}/{name}")
    t = Retail({name: (lambda name=name: spark.read.parquet(f"{tmp_path}/{name}")) for name in names})
    text = plan_text(quality.all_references(t))
    assert all(len(re.findall(rf"Location: \w+ \[\S*/{name}\]", text)) == 1 for name in names)
    assert len(re.findall(r"Arguments: hashpartitioning", text)) == 2 and "SortMergeJoin" not in text  # the second moves a row per key column
