"""Running totals over groups of any size.

A plain window sends every row of a group to one task. `before_each_row` cuts a group into chunks of time:
chunk totals are aggregated before the shuffle, a window over the few chunk totals of a group gives what
lies before each chunk, and the window over single rows runs inside one chunk only. It moves the rows once and
suits keys that are busy for a long time, like orders.

`before_each_row_in_ranges` bounds the work by numbers of rows: the rows are ordered by (key, ts, tie) over the whole
cluster and cut into ranges of similar size, whatever the keys and times are. It suits keys that may get any number of
rows at one time, like products and coupons. Both equal the plain window ordered by (ts, tie).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillspan.plans.ordered import PLACE, RANGE, in_ranges

CHUNK = "MINUTE"


def before_each_row(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    outputs: dict[str, tuple[str, Callable[[Column], Column]]],
    unit: str = CHUNK,
) -> DataFrame:
    """Add, for each `outputs[name] = (column, aggregate)`, the aggregate over the earlier rows of the group.

    The aggregate must be one that can be taken of partial results again: F.sum, F.max or F.min. It is NULL
    for the first row of a group. `tie` makes the order total.
    """
    keys = list(keys)
    chunked = df.withColumn("_chunk", F.date_trunc(unit, F.col(ts)))
    totals = chunked.groupBy(*keys, "_chunk").agg(
        *[agg(F.col(column)).alias(f"_t_{name}") for name, (column, agg) in outputs.items()]
    )
    earlier_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "_chunk",
        *[agg(F.col(f"_t_{name}")).over(earlier_chunks).alias(f"_c_{name}") for name, (_, agg) in outputs.items()],
    )
    earlier_rows = (
        Window.partitionBy(*keys, "_chunk").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = chunked.select(
        "*",
        *[agg(F.col(column)).over(earlier_rows).alias(f"_r_{name}") for name, (column, agg) in outputs.items()],
    )
    joined = inside.join(carried, [*keys, "_chunk"])
    both = {
        name: _combine(agg, F.col(f"_c_{name}"), F.col(f"_r_{name}")) for name, (_, agg) in outputs.items()
    }
    return joined.select(*df.columns, *[column.alias(name) for name, column in both.items()])


def before_each_row_in_ranges(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    outputs: dict[str, tuple[str, Callable[[Column], Column]]],
    ranges: int | None = None,
) -> DataFrame:
    """As `before_each_row`, by ranges of rows; rows whose key is NULL are a group like any other.

    Only the first key of a range can have begun in an earlier one, so what is carried into the ranges is at most
    one row for each of them.
    """
    keys = list(keys)
    ordered = in_ranges(df, [*[F.col(k) for k in keys], F.col(ts), F.col(tie)], "running", ranges)
    totals = ordered.groupBy(*keys, RANGE).agg(*[agg(F.col(column)).alias(f"_t_{name}") for name, (column, agg) in outputs.items()])
    of_key = Window.partitionBy(*keys).orderBy(RANGE)
    carried = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(RANGE).alias("_k_range"),
        F.lag(F.lit(True)).over(of_key).alias("_begun"),
        *[
            agg(F.col(f"_t_{name}")).over(of_key.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_c_{name}")
            for name, (_, agg) in outputs.items()
        ],
    ).filter("_begun")
    earlier_rows = Window.partitionBy(RANGE, *keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    inside = ordered.select("*", *[agg(F.col(column)).over(earlier_rows).alias(f"_r_{name}") for name, (column, agg) in outputs.items()])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = inside.join(F.broadcast(carried), [F.col(RANGE) == F.col("_k_range"), *same], "left")
    both = {name: _combine(agg, F.col(f"_c_{name}"), F.col(f"_r_{name}")) for name, (_, agg) in outputs.items()}
    return joined.select(*df.columns, *[column.alias(name) for name, column in both.items()])


def latest_before(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    column: str,
    alias: str,
    unit: str = CHUNK,
) -> DataFrame:
    """Add the last non-NULL value of `column` among the earlier rows of the group, else NULL."""
    stamped = df.withColumn(
        "_stamp", F.when(F.col(column).isNotNull(), F.struct(F.col(ts), F.col(tie), F.col(column)))
    )
    found = before_each_row(stamped, keys, ts, tie, {"_last": ("_stamp", F.max)}, unit)
    return found.withColumn(alias, F.col(f"_last.{column}")).drop("_stamp", "_last")


def _combine(agg: Callable[[Column], Column], carried: Column, inside: Column) -> Column:
    if agg is F.sum:
        zero = F.lit(0)
        total = F.coalesce(carried, zero) + F.coalesce(inside, zero)
        return F.when(carried.isNotNull() | inside.isNotNull(), total)
    if agg is F.max:
        return F.greatest(carried, inside)
    if agg is F.min:
        return F.least(carried, inside)
    raise ValueError("only F.sum, F.max and F.min can be carried across chunks")
