"""Streaming jobs against their batch forms, over split input, restarts and late rows."""

import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import make, rows, statuses
from tests.test_reports import order, product
from tillspan.operators import jobs, lookups
from tillspan.sources.schemas import schema_of
from tillspan.sources.tables import Retail
from tillspan.streaming.changes import ChangeLog, stream_change_log
from tillspan.streaming.revenue import stream_daily_revenue
from tillspan.streaming.run import drain, drained
from tillspan.streaming.stock import state_store, stream_low_stock


def feed(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def put(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def test_daily_revenue_over_split_files_and_a_restart(spark, tmp_path):
    days = [order(n, ts=f"2024-03-{1 + n // 3:02d}T{n % 3 * 9:02d}:00:00", status_id=8 if n % 7 == 0 else 7) for n in range(60)]
    source, out, check = (f"{tmp_path}/{d}" for d in ("in", "out", "check"))
    stream = None
    for start in range(0, 60, 20):
        put(make(spark, "orders", days[start:start + 20]), source)
        stream = stream_daily_revenue(feed(spark, source, schema_of("orders")), statuses(spark))
        drain(stream, out, check)
    # One late order, for a day that was closed long ago.
    put(make(spark, "orders", [order(99, ts="2024-03-01T00:00:00")]), source)
    found = drained(stream_daily_revenue(feed(spark, source, schema_of("orders")), statuses(spark)), out, check)
    batch = lookups.daily_revenue(
        Retail.of(orders=make(spark, "orders", days), order_status=statuses(spark)), "2024-03-01", "2024-03-31"
    )
    last_closed = dt.date(2024, 3, 18)
    assert rows(found) == rows(batch.filter(F.col("day") <= F.lit(last_closed)))


def test_low_stock_over_split_files_and_a_restart(spark, tmp_path):
    goods = make(spark, "products", [product(1, stock=20, stock_min=5), product(2, stock=100, stock_min=5)])
    # Product 1 falls, is refilled and falls again; product 2 never gets there.
    moves = [-8, -8, 0, 30, -20, -9, -1] + [0] * 5
    events = [
        {"event_id": n * 2 + p, "ts": f"2024-03-01T{n:02d}:30:00", "product_id": p, "delta": moves[n]}
        for n in range(12) for p in (1, 2)
    ]
    source, out, check = (f"{tmp_path}/{d}" for d in ("in", "out", "check"))
    for start in range(0, 24, 8):
        put(make(spark, "stock_deltas", events[start:start + 8]), source)
        with state_store(spark):
            found = drained(stream_low_stock(feed(spark, source, schema_of("stock_deltas")), goods), out, check)
        # The table is refreshed between the runs: the movements so far are in its stock now.
        so_far = sum(moves[: (start + 8) // 2])
        goods = make(spark, "products", [product(1, stock=20 + so_far, stock_min=99), product(2, stock=100 + so_far, stock_min=99), product(3)])
    assert rows(found, "product_id", "period_end", "stock_before", "stock") == [
        (1, dt.datetime(2024, 3, 1, 2), 12, 4), (1, dt.datetime(2024, 3, 1, 6), 14, 5)
    ]


def test_products_without_a_start_raise_no_alerts(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    events = [{"event_id": n, "ts": f"2024-03-01T{n:02d}:30:00", "product_id": p, "delta": -9} for n in range(6) for p in (1, 2, 3)]
    put(make(spark, "stock_deltas", events), f"{tmp_path}/in")
    goods = make(spark, "products", [product(1, stock=10), {**product(2), "stock": None}, {**product(3), "product_id": None}])
    with state_store(spark):
        found = drained(stream_low_stock(feed(spark, f"{tmp_path}/in", schema_of("stock_deltas")), goods), f"{tmp_path}/out", f"{tmp_path}/check")
    assert rows(found, "product_id", "stock_before", "stock") == [(1, 10, 1)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def versions(spark, items):
    base = dict(created_at="2024-01-01T00:00:00", updated_at="2024-01-01T00:00:00")
    full = make(spark, "products", [product(n, price=p, **base) for n, p, *_ in items])
    marks = spark.createDataFrame([(n, gone, seq) for n, _, gone, seq in items], "product_id bigint, deleted boolean, seq bigint")
    return full.join(marks, "product_id")


def test_change_log_over_batches_restart_and_replay(spark, tmp_path):
    schema = schema_of("products")
    stored = schema.add("deleted", "boolean").add("seq", "long")
    schema = schema_of("products")
    first = versions(spark, [(1, "10", False, 0), (2, "20", False, 0), (3, "30", False, 0)]).drop("deleted", "seq")
    log = ChangeLog(f"{tmp_path}/table", schema, "product_id", "products")
    log.start(first)
    source = f"{tmp_path}/in"
    put(versions(spark, [(1, "11", False, 1), (4, "40", False, 2)]), source)
    stream_change_log(feed(spark, source, stored), log, f"{tmp_path}/check")
    put(versions(spark, [(2, "20", False, 3), (3, "30", True, 4)]), source)
    second = versions(spark, [(1, "12", False, 6)])
    put(second, source)
    entries = stream_change_log(feed(spark, source, stored), log, f"{tmp_path}/check")
    assert rows(entries, "batch", "row_id", "op") == [
        (0, 1, "UPDATE"), (0, 4, "INSERT"), (1, 3, "DELETE"), (2, 1, "UPDATE")
    ]
    assert rows(log.current(spark), "product_id", "price") == [(1, 12.0), (2, 20.0), (4, 40.0)]
    # Running the last batch again changes nothing.
    log.apply(second, 2)
    assert entries.sparkSession.read.parquet(log.log).count() == 4
    assert rows(log.current(spark), "product_id", "price") == [(1, 12.0), (2, 20.0), (4, 40.0)]
    assert rows(log.current(spark, before=1), "product_id", "price") == [(1, 11.0), (2, 20.0), (3, 30.0), (4, 40.0)]
    whole = jobs.change_log(first, log.current(spark), "product_id", "products")
    assert rows(whole, "row_id", "op") == [(1, "UPDATE"), (3, "DELETE"), (4, "INSERT")]


def test_change_log_leaves_out_versions_that_come_late(spark, tmp_path):
    log = ChangeLog(f"{tmp_path}/table", schema_of("products"), "product_id", "products")
    log.start(versions(spark, [(1, "10", False, 0), (2, "20", False, 0)]).drop("deleted", "seq"))
    log.apply(versions(spark, [(1, "30", False, 7), (2, "20", True, 8)]), 0)
    log.apply(versions(spark, [(1, "20", False, 3), (2, "25", False, 5)]), 1)
    assert rows(log.current(spark), "product_id", "price") == [(1, 30.0)]
    assert rows(log.entries(spark), "batch", "row_id", "op") == [(0, 1, "UPDATE"), (0, 2, "DELETE")]
    log.apply(versions(spark, [(1, "40", False, 7)]), 2)
    assert rows(log.current(spark), "product_id", "price") == [(1, 40.0)]
    late = log.late_versions(spark)
    assert rows(late, "batch", "product_id", "_version", "_known") == [(1, 1, 3, 7), (1, 2, 5, 8)]


def test_bases_replace_the_history_before_them(spark, tmp_path):
    import random

    draw, truth, sent = random.Random(5), {n: (0, "1") for n in range(20)}, []
    logs = [ChangeLog(f"{tmp_path}/{every}", schema_of("products"), "product_id", "products", merge_every=every) for every in (2, 1000)]
    first = versions(spark, [(n, "1", False, 0) for n in range(20)]).drop("deleted", "seq")
    for log in logs:
        log.start(first)
    for batch in range(7):
        # Out of order: numbers fall back behind earlier batches.
        rows_ = {n: (n, str(draw.randrange(2, 90)), draw.random() < 0.2, draw.randrange(100) + 10 * batch) for n in draw.sample(range(25), 9)}
        sent.append(versions(spark, list(rows_.values())))
        for n, price, gone, seq in rows_.values():
            if seq >= truth.get(n, (-1, None))[0] or truth.get(n) == (0, "1"):
                truth[n] = (seq, None if gone else price)
        for log in logs:
            log.apply(sent[-1], batch)
    want = sorted(((n, float(p)) for n, (_, p) in truth.items() if p is not None), key=lambda r: str(r[0]))
    for log in logs:
        assert rows(log.current(spark), "product_id", "price") == want
    assert rows(logs[0].entries(spark)) == rows(logs[1].entries(spark))
    # A batch reads the last base and what came later.
    read = lambda log, before: {r[0].split("/")[-2] for r in log._stored(spark, before).select(F.input_file_name()).distinct().collect()}
    assert read(logs[0], 7) == {"base=5", "batch=6"} and read(logs[0], 6) == {"base=3", "batch=4", "batch=5"}
    # A base that was half written isn't listed: it is passed over, and made anew.
    sent[0].limit(1).write.mode("overwrite").parquet(f"{logs[0].bases}/base=6")
    assert rows(logs[0].current(spark), "product_id", "price") == want
    logs[0].merge(spark, 6)
    assert read(logs[0], None) == {"base=6"} and rows(logs[0].current(spark), "product_id", "price") == want
    # A batch sent again after its base was made finds the base before it.
    logs[0].apply(sent[5], 5)
    assert rows(logs[0].entries(spark)) == rows(logs[1].entries(spark)) and rows(logs[0].current(spark), "product_id", "price") == want


def test_the_state_of_a_product_takes_plain_rows():
    from types import SimpleNamespace

    from pyspark.sql import Row
    from tillspan.streaming.stock import _alert_processor

    held = {"level": None}
    state = SimpleNamespace(get=lambda: held["level"], exists=lambda: held["level"] is not None, update=lambda v: held.update(level=v))
    alerts = _alert_processor()
    alerts.init(SimpleNamespace(getValueState=lambda *_: state))
    moves = [Row(period_end=n, product_id=1, delta=d) for n, d in ((3, -4), (1, -3), (2, None))]
    assert list(alerts.handleInputRows((1,), iter(moves), None)) == []  # not in the table
    alerts.handleInitialState((1,), Row(product_id=1, stock=10, stock_min=5), None)
    alerts.handleInitialState((1,), Row(product_id=1, stock=99, stock_min=5), None)  # listed twice
    assert [tuple(r) for r in alerts.handleInputRows((1,), iter(moves), None)] == [(1, 3, 7, 3, 5)]
    assert held["level"] == (3, 5)
