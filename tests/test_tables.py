"""Loading, writing, pruning and analysing tables."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import make, rows
from tests.test_reports import item, order, product
from tillspan.operators import reports
from tillspan.plans.inspect import plan_text
from tillspan.sources.schemas import RETAIL_DDL, schema_of
from tillspan.plans.session import size_shuffles
from tillspan.sources.tables import (
    Retail,
    analyze_table,
    catalog_tables,
    in_period,
    load_tables,
    replace_folders,
    save_bucketed,
    with_month,
    write_table,
)


def test_round_trip_and_month_folders(spark, tmp_path):
    orders = make(spark, "orders", [order(n, ts=f"2024-{m:02d}-15T00:00:00") for n, m in enumerate((1, 1, 2, 3))])
    goods = make(spark, "products", [product(1), product(2, promo_price="3.50")])
    write_table(orders, str(tmp_path), "orders")
    write_table(goods, str(tmp_path), "products")
    t = load_tables(spark, str(tmp_path))
    assert t.names() == list(RETAIL_DDL)
    assert rows(t.orders.drop("month")) == rows(orders)
    assert t.products.schema == schema_of("products") and rows(t.products) == rows(goods)
    assert len(glob.glob(f"{tmp_path}/orders/month=2024-*")) == 3


def test_items_lie_in_the_month_of_their_order_and_months_are_replaced_alone(spark, tmp_path):
    orders = make(spark, "orders", [order(n, ts=f"2024-{n:02d}-15T00:00:00") for n in (1, 2, 3)])
    items = make(spark, "order_items", [item(n, p) for n in (1, 2, 3) for p in (1, 2)] + [item(99, 1)])
    with pytest.raises(ValueError):
        write_table(items, str(tmp_path), "order_items")
    write_table(with_month(items, orders), str(tmp_path), "order_items")
    stored = load_tables(spark, str(tmp_path)).order_items
    assert sorted((r["order_id"], r["month"]) for r in stored.collect()) == [
        (1, "2024-01"), (1, "2024-01"), (2, "2024-02"), (2, "2024-02"), (3, "2024-03"), (3, "2024-03"), (99, None)
    ]
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/order_items/month=*/*.parquet")}
    before = files()
    replace_folders(stored.filter("month = '2024-02' and product_id = 2").withColumn("qty", F.lit(77)), str(tmp_path), "order_items")
    after = files()
    assert {f for f in before if "2024-02" not in f} == {f for f in after if "2024-02" not in f}
    assert all(before[f] == after[f] for f in after if "2024-02" not in f)
    assert not {f for f in before if "2024-02" in f} & set(after)
    changed = load_tables(spark, str(tmp_path)).order_items
    assert sorted((r["order_id"], r["product_id"], r["qty"] == 77) for r in changed.collect()) == [
        (1, 1, False), (1, 2, False), (2, 2, True), (3, 1, False), (3, 2, False), (99, 1, False)
    ]
    # Nothing to replace changes nothing.
    replace_folders(changed.limit(0), str(tmp_path), "order_items")
    assert files() == after


def test_a_period_prunes_month_folders_and_reaches_the_scan(spark, tmp_path):
    orders = make(spark, "orders", [order(n, ts=f"2024-{m:02d}-15T00:00:00") for n, m in enumerate((1, 2, 3, 4))])
    write_table(orders, str(tmp_path), "orders")
    t = load_tables(spark, str(tmp_path))
    part = in_period(t.orders, "order_ts", "2024-02-15", "2024-03-15").select("order_id")
    assert rows(part) == [(1,)]
    plan = plan_text(part)
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(order_ts)" in plan
    assert "ReadSchema: struct<order_id:bigint,order_ts:timestamp_ntz>" in plan


def test_a_month_above_the_advisory_size_is_cut_into_files(spark, tmp_path):
    orders = make(spark, "orders", [order(n) for n in range(2000)]).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    write_table(orders, str(tmp_path), "orders")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{tmp_path}/orders/month=2024-03/*.parquet")) > 1
    assert load_tables(spark, str(tmp_path)).orders.count() == 2000


def test_bucketed_facts_join_without_a_shuffle(spark, tmp_path, star):
    names = {}
    for name in ("orders", "order_items"):
        names[name] = f"tillspan_{name}"
        spark.sql(f"DROP TABLE IF EXISTS {names[name]}")
        save_bucketed(getattr(star, name), names[name], "order_id", 4, f"{tmp_path}/{name}")
    saved = catalog_tables(spark, names)
    t = Retail.of(orders=saved.orders, order_items=saved.order_items, order_status=star.order_status)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2000")
    try:
        plan = plan_text(reports.monthly_trend(t, "1998-01-01"))
        assert "hashpartitioning(order_id" not in plan and "SortMergeJoin" in plan
        assert rows(reports.monthly_trend(t, "1998-01-01")) == rows(reports.monthly_trend(star, "1998-01-01"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in names.values():
            spark.sql(f"DROP TABLE {table}")


def test_shuffles_are_sized_by_data_and_cores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(spark, 10 * 1024**4, 4000)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "52429"
    size_shuffles(spark, 1000, 4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_analyze_gives_column_statistics(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS tillspan_products")
    make(spark, "products", [product(n) for n in range(5)]).write.option("path", f"{tmp_path}/p").saveAsTable("tillspan_products")
    analyze_table(spark, "tillspan_products", ["product_id", "stock"])
    described = spark.sql("DESCRIBE EXTENDED tillspan_products product_id").collect()
    assert {r["info_name"]: r["info_value"] for r in described}["distinct_count"] == "5"
    spark.sql("DROP TABLE tillspan_products")


def test_partitions_grow_with_the_files(spark, tmp_path, monkeypatch):
    from tillspan.plans import session

    names = [f"spark.sql.adaptive.{k}" for k in ("coalescePartitions.initialPartitionNum", "advisoryPartitionSizeInBytes")]
    before = {name: spark.conf.get(name, None) for name in names}
    spark.range(1000).repartition(4).write.parquet(f"{tmp_path}/a.parquet")
    stored = sum(f.stat().st_size for f in tmp_path.glob("a.parquet/*.parquet"))
    monkeypatch.setattr(session, "STORED_BYTES_PER_PARTITION", 10)
    try:
        session.size_merging(spark, [f"{tmp_path}/a.parquet"])
        assert int(spark.conf.get(names[0])) == -(-stored // 10) > int(spark.conf.get("spark.sql.shuffle.partitions"))
        monkeypatch.setattr(session, "STORED_BYTES_PER_PARTITION", 1 << 30)
        session.size_merging(spark, [f"{tmp_path}/a.parquet"])
        assert spark.conf.get(names[0]) == spark.conf.get("spark.sql.shuffle.partitions")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
