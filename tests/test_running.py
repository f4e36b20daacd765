"""Chunked running totals equal the plain window, hot keys and equal times included."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import rows
from tillspan.plans.joins import left_lookup
from tillspan.plans.lineage import cut
from tillspan.plans.groups import connected
from tillspan.plans.ordered import RANGE, in_ranges, numbered
from tillspan.plans.running import before_each_row, before_each_row_in_ranges, latest_before


def requests(spark, n=600):
    # Key 0 owns two thirds of the rows; many rows share a time.
    return spark.range(n).selectExpr(
        "id", "case when id % 3 = 0 then id % 7 else 0 end as k",
        "timestamp_ntz'2024-01-01 00:00:00' + cast(id * 7919 % 400 as int) * interval '20' second as ts",
        "cast(id * 31 % 17 as int) - 5 as v", "case when id % 4 = 0 then id end as mark",
    )


def test_running_totals(spark):
    df = requests(spark)
    outputs = {"s": ("v", F.sum), "m": ("v", F.max), "l": ("v", F.min)}
    found = before_each_row(df, ["k"], "ts", "id", outputs)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", *[agg(c).over(w).alias(name) for name, (c, agg) in outputs.items()])
    assert found.columns == want.columns and rows(found) == rows(want)


@pytest.mark.parametrize("ranges", [1, 7, 40, None])
def test_running_totals_in_ranges(spark, ranges):
    df = requests(spark).withColumn("k", F.when(F.col("k") != 3, F.col("k")))  # a key of its own is NULL
    outputs = {"s": ("v", F.sum), "m": ("v", F.max), "l": ("mark", F.min)}
    found = before_each_row_in_ranges(df, ["k"], "ts", "id", outputs, ranges)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", *[agg(c).over(w).alias(name) for name, (c, agg) in outputs.items()])
    assert found.columns == want.columns and rows(found) == rows(want)
    assert before_each_row_in_ranges(df.limit(0), ["k"], "ts", "id", outputs, ranges).collect() == []


def test_ranges_follow_rows_not_keys_or_times(spark):
    # One product, one time stamp, a million rows.
    df = spark.range(1_000_000).selectExpr("1 as k", "timestamp_ntz'2024-01-01 00:00:00' as ts", "id", "1 as v")
    ordered = in_ranges(df, [F.col("k"), F.col("ts"), F.col("id")], "test", 16)
    sizes = sorted(r["count"] for r in ordered.groupBy(RANGE).count().collect())
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    found = before_each_row_in_ranges(df, ["k"], "ts", "id", {"s": ("v", F.sum)}, 16)
    assert found.filter(F.coalesce("s", F.lit(0)) != F.col("id")).isEmpty()
    assert numbered(ordered, "n").filter("n <> id + 1").isEmpty()


def test_connected_rows(spark):
    links = [(k, f"v{k}") for k in range(300)] + [(k + 1, f"v{k}") for k in range(299)] + [(1000 + k, "hub") for k in range(50)] + [(5000, "alone")]
    groups = {r["row"]: r["group"] for r in connected(spark.createDataFrame(links, "row long, value string"), "row", "value").collect()}
    assert groups == {**{k: 0 for k in range(300)}, **{1000 + k: 1000 for k in range(50)}, 5000: 5000}


def test_latest_before(spark):
    df = requests(spark)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("seen", F.last("mark", ignorenulls=True).over(w))
    assert rows(latest_before(df, ["k"], "ts", "id", "mark", "seen")) == rows(want)


def test_left_lookup_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, None)], "id bigint, code string")
    table = spark.createDataFrame([("a", 10)], "code string, v int")
    assert rows(left_lookup(df, "code", table, "id"), "id", "code", "v") == [
        (1, "a", 10), (2, None, None), (3, "z", None), (4, None, None)
    ]


def test_cut_drops_the_lineage(spark):
    df = cut(spark.range(10).filter("id > 4"))
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().toString()
