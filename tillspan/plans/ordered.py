"""A total order over a whole table, cut into ranges that tasks sort by themselves.

The rows are dealt by range of the order's columns, so that neighbours share a task whatever their key: a key that
holds most rows is simply spread over many ranges. The sorted ranges are written once to shared storage; every row
then has a place that no retry changes, and what lies before a range follows from one small row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspan.plans.lineage import run_dir

RANGE, PLACE = "_range", "_place"
# A place has the number of its range above so many bits, and its number inside the range below.
PLACE_BITS = 33


def in_ranges(df: DataFrame, order: Sequence[Column], name: str, ranges: int | None = None) -> DataFrame:
    """`df` in the given order, written once, with `_range` and `_place`: numbers that grow along the order.

    `ranges` is their number; left out, it is the session's number of shuffle partitions, and their bounds are taken
    from a sample of the rows, so they follow how many rows there are and not what the keys are. Equal rows of the
    order share a range.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).withColumn(PLACE, F.monotonically_increasing_id())
    path = run_dir(spark, name)
    placed.withColumn(RANGE, F.shiftright(F.col(PLACE), PLACE_BITS)).write.parquet(path)
    return spark.read.schema(placed.schema.add(RANGE, "long")).parquet(path)


def before_range() -> Window:
    """The window over one row per range that covers the ranges before it.

    It has no partition: its rows are as many as ranges, not as rows of the table.
    """
    return Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def numbered(ordered: DataFrame, alias: str) -> DataFrame:
    """Adds the number of each row, from 1, to a table of `in_ranges`."""
    sizes = ordered.groupBy(RANGE).agg(F.count(F.lit(1)).alias("_size"))
    earlier = F.coalesce(F.sum("_size").over(before_range()), F.lit(0)).alias("_earlier")
    offsets = sizes.select(RANGE, earlier)
    inside = F.col(PLACE) - F.shiftleft(F.col(RANGE), PLACE_BITS)
    return ordered.join(F.broadcast(offsets), RANGE).withColumn(alias, F.col("_earlier") + inside + 1).drop("_earlier")
