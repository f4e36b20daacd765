"""Updates of stored tables against the same change on frames: folders, batches, keys that are NULL or unknown."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import by_key, make, rows, statuses
from tests.test_jobs import request as status_request
from tests.test_reports import order, product
from tillspan.operators import jobs
from tillspan.sources import merge
from tillspan.sources.merge import apply_updates
from tillspan.sources.tables import load_tables, write_table

STAMP = "timestamp_ntz'2024-06-01 12:00:00'"


def files(directory):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{directory}/*=*/*.parquet")}


def folders(changed):
    return {os.path.basename(os.path.dirname(f)) for f in changed}


def deltas(spark, changes):
    return spark.createDataFrame(changes, "product_id long, delta long")


def test_stock_changes_touch_their_folders_alone_and_count_once(spark, tmp_path):
    write_table(make(spark, "products", [product(n, stock=50) for n in range(200)]), str(tmp_path), "products")
    before = files(tmp_path / "products")
    change = deltas(spark, [(3, -5), (7, 9), (999, 1)])
    for _ in range(2):
        jobs.update_stock(spark, str(tmp_path), change, "one", F.expr(STAMP))
    after = files(tmp_path / "products")
    assert len(folders(before)) > 40 and 1 <= len(folders(set(before) ^ set(after))) <= 3
    assert all(before[f] == after[f] for f in set(before) & set(after))
    found = by_key(load_tables(spark, str(tmp_path)).products, "product_id")
    assert {k: v["stock"] for k, v in found.items() if v["stock"] != 50} == {3: 45, 7: 59}
    assert sum(v["updated_at"] is not None and v["updated_at"].year == 2024 and v["updated_at"].month == 6 for v in found.values()) == 2
    jobs.update_stock(spark, str(tmp_path), change, "two", F.expr(STAMP))
    found = by_key(load_tables(spark, str(tmp_path)).products, "product_id")
    assert len(found) == 200 and (found[3]["stock"], found[7]["stock"]) == (40, 68)


def test_a_batch_that_died_between_folders_is_finished(spark, tmp_path, monkeypatch):
    write_table(make(spark, "products", [product(n, stock=50) for n in range(100)]), str(tmp_path), "products")
    # The first half of the products gets its folders, then the job dies.
    replace = merge.replace_folders
    monkeypatch.setattr(merge, "replace_folders", lambda df, d, name: replace(df.filter("part < 32"), d, name))
    change = deltas(spark, [(n, 1) for n in range(100)])
    jobs.update_stock(spark, str(tmp_path), change, "one", F.expr(STAMP))
    assert 0 < load_tables(spark, str(tmp_path)).products.filter("stock = 51").count() < 100
    monkeypatch.setattr(merge, "replace_folders", replace)
    jobs.update_stock(spark, str(tmp_path), change, "one", F.expr(STAMP))
    assert rows(load_tables(spark, str(tmp_path)).products, "product_id", "stock") == sorted(
        [(n, 51) for n in range(100)], key=lambda r: (False, str(r[0]))
    )


def test_orders_change_in_their_months_as_they_do_in_frames(spark, tmp_path):
    orders = make(spark, "orders", [order(n, ts=f"2024-{1 + n % 4:02d}-15T00:00:00", status_id=1) for n in range(12)])
    write_table(orders, str(tmp_path), "orders")
    asked = [status_request(1, 0, 2, 1), status_request(2, 4, 2, 2), status_request(3, 4, 4, 3), status_request(4, 77, 2, 4)]
    done = jobs.apply_status_changes(make(spark, "status_requests", asked), orders, make(spark, "order_items", []), statuses(spark))
    before = files(tmp_path / "orders")
    for _ in range(2):
        jobs.update_orders(spark, str(tmp_path), done.changes, "one")
    after = files(tmp_path / "orders")
    assert folders(set(before) ^ set(after)) == {"month=2024-01"}
    assert rows(load_tables(spark, str(tmp_path)).orders.drop("month")) == rows(done.orders)
    assert by_key(done.orders, "order_id")[4]["updated_at"] == by_key(done.orders, "order_id")[4]["shipping_ts"]


def test_null_keys_repeated_keys_and_unknown_columns(spark, tmp_path):
    write_table(make(spark, "products", [product(1), {**product(2), "product_id": None}]), str(tmp_path), "products")
    change = lambda u: {"stock": F.col("stock") + u["delta"]}
    apply_updates(spark, str(tmp_path), "products", deltas(spark, [(None, 7)]), ["product_id"], change, "a")
    assert [r["stock"] - product(2)["stock"] for r in load_tables(spark, str(tmp_path)).products.filter("product_id is null").collect()] == [7]
    with pytest.raises(ValueError):
        apply_updates(spark, str(tmp_path), "products", deltas(spark, [(1, 7), (1, 8)]), ["product_id"], change, "b")
    with pytest.raises(KeyError):
        apply_updates(spark, str(tmp_path), "products", deltas(spark, [(1, 7)]), ["product_id"], lambda u: {"nothing": u["delta"]}, "c")
    before = files(tmp_path / "products")
    apply_updates(spark, str(tmp_path), "products", deltas(spark, []), ["product_id"], change, "d")
    assert files(tmp_path / "products") == before
