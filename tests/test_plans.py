"""What the plans promise: scans per fact table, no cross joins of tables, pruned columns, no Python in the way."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.helpers import rows
from tillspan.catalog import ON_TABLES
from tillspan.plans.inspect import final_plan, operators, plan_text, scans
from tillspan.sources.star import star_retail
from tillspan.sources.tables import Retail, load_tables, with_month, write_table

QUERIES = entry.queries()

# How often a report reads a fact table. Top lists have read the ranking columns before, and here what belongs to the
# listed keys.
SCANS = {
    "r01_sales_detail": {"lineitem": 1, "orders": 1},
    "r02_best_sellers": {"lineitem": 1, "orders": 1},
    "r03_vip_customers": {"lineitem": 1, "orders": 1},
    "r04_region_category_revenue": {"lineitem": 1, "orders": 1},
    "r04b_region_category_rollup": {"lineitem": 1, "orders": 1},
    "r05_cart_conversion": {"lineitem": 0, "orders": 1, "events": 1},
    "r06_monthly_trend": {"lineitem": 1, "orders": 1},
    "r06b_monthly_trend_order_grain": {"lineitem": 1, "orders": 1},
    "r07_payment_performance": {"lineitem": 0, "orders": 1},
    "r08_cohort_retention": {"lineitem": 0, "orders": 1},
    "r08b_cohort_matrix": {"lineitem": 0, "orders": 1},
    "r09_stockout_forecast": {"lineitem": 1, "orders": 1, "events": 1},
    "r10_executive_dashboard": {"lineitem": 1, "orders": 2, "events": 1},
    "v02_order_summary": {"lineitem": 1, "orders": 1},
    "v03_monthly_sales": {"lineitem": 0, "orders": 1},
    "t01_customer_stats": {"lineitem": 1, "orders": 2},
    "t03_daily_revenue": {"lineitem": 0, "orders": 1},
    "x05_product_rank_in_category": {"lineitem": 1},
}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_scans(name, spark):
    found = scans(QUERIES[name](spark, SF_DIR))
    assert {table: found[table] for table in SCANS[name]} == SCANS[name]


@pytest.mark.parametrize("name", sorted(ON_TABLES))
def test_no_cartesian_product_and_no_python(name, spark):
    found = operators(QUERIES[name](spark, SF_DIR))
    assert not {op for op in found if "Python" in op or "Pandas" in op or op == "CartesianProduct"}
    # One-row sides only: the dashboard, and the initial state of new orders.
    if not name.startswith(("r10", "j01")):
        assert "BroadcastNestedLoopJoin" not in found


def test_columns_are_pruned(spark):
    text = plan_text(QUERIES["r04_region_category_revenue"](spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


# Keys with few values. A shuffle of a fact on one of them would put most of it into a handful of tasks.
FEW_VALUES = {"status_id", "method_id", "category_id", "state_id", "city_id", "new_status_id", "status_before"}
STORED = (
    "states", "cities", "categories", "payment_methods", "order_status", "customers", "products", "addresses", "orders",
    "order_items", "reviews", "carts", "coupons",
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The derived tables written as a shop would store them; job inputs stay derived."""
    directory = str(tmp_path_factory.mktemp("shop"))
    star = star_retail(spark, SF_DIR.replace("0.001", "0.01"))
    for name in STORED:
        write_table(with_month(star.order_items, star.orders) if name == "order_items" else getattr(star, name), directory, name)
    loaded = load_tables(spark, directory, STORED)
    return Retail({name: (lambda name=name: getattr(loaded if name in STORED else star, name)) for name in star.names()})


@pytest.mark.parametrize("name", sorted(n for n in ON_TABLES if n[0] in "rvtcx" or n[:3] in ("j02", "j03", "j13")))
def test_small_tables_are_broadcast_when_everything_else_is_too_large(name, spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        text = plan_text(ON_TABLES[name](stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = re.findall(r"\) (?:SortMergeJoin|ShuffledHashJoin).*?\nLeft keys \[\d+\]: \[(.*?)\]", text)
    keys = [{re.sub(r"#\d+L?", "", k) for k in join.split(", ")} for join in joins]
    # The payment report joins its few result rows to the methods; no fact is moved for that.
    expected = [{"method_id"}] if name.startswith("r07") else []
    assert [k for k in keys if k <= FEW_VALUES] == expected


def test_stored_tables_give_the_same_answers(spark, stored):
    star = star_retail(spark, SF_DIR.replace("0.001", "0.01"))
    for name in ("r01_sales_detail", "r02_best_sellers", "r04_region_category_revenue", "r06_monthly_trend", "r07_payment_performance", "r09_stockout_forecast", "r10_executive_dashboard"):
        assert rows(ON_TABLES[name](stored)) == rows(ON_TABLES[name](star))


@pytest.mark.parametrize(
    "name", ["r01_sales_detail", "r06_monthly_trend", "r06b_monthly_trend_order_grain", "r09_stockout_forecast", "r10_executive_dashboard", "r10b_dashboard_long"]
)
def test_a_period_prunes_the_folders_of_orders_and_items(name, spark, stored):
    text = plan_text(ON_TABLES[name](stored))
    for table in ("orders", "order_items"):
        found = re.findall(rf"Location: \w+ \[\S*/{table}[\]/].*?(?=ReadSchema)", text, flags=re.DOTALL)
        assert found and all(re.search(r"PartitionFilters: \[.*month#\d+ >= \d{4}-\d\d", scan) or table == "orders" and "month#" in scan for scan in found), text
    if name == "r06b_monthly_trend_order_grain":
        assert rows(ON_TABLES[name](stored)) == rows(ON_TABLES[name](star_retail(spark, SF_DIR.replace("0.001", "0.01"))))


def test_buckets_spare_every_exchange(spark):
    text = plan_text(QUERIES["l02_bucketed_join"](spark, SF_DIR))
    assert "hashpartitioning" not in text and "Bucketed: true" in text


@pytest.mark.parametrize("name", ["r02_best_sellers", "r03_vip_customers", "r05_cart_conversion", "j10_merge_items", "j11_dedupe_reviews"])
def test_no_exchange_carries_a_whole_fact(name, spark, stored):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        found = final_plan(ON_TABLES[name](stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # What goes through an exchange is a partial aggregate, a broadcast, or the few rows of a join with a broadcast.
    for line, below in re.findall(r"([^\n]*Exchange hashpartitioning[^\n]*)\n([^\n]*(?:\n[^\n]*){0,4})", found):
        assert re.search("Aggregate|BroadcastHashJoin", below), (line, below)
    assert "SortMergeJoin" not in found


def test_large_lists_fall_back_to_shuffles(spark, star, monkeypatch):
    from tillspan.plans import joins

    want = {name: rows(ON_TABLES[name](star)) for name in ("r02_best_sellers", "r03_vip_customers", "r05_cart_conversion", "r09_stockout_forecast", "j10_merge_items")}
    for function in (joins.broadcast_limited, joins.taken, joins.checked, joins.broadcast_counted):
        monkeypatch.setattr(function, "__defaults__", (0,))
    assert {name: rows(ON_TABLES[name](star)) for name in want} == want
