"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tillspan.plans.lineage import run_dir

# A frame cut by a limit of at most this many rows may be broadcast: its size is bounded by construction.
MAX_BROADCAST_ROWS = 100_000


def broadcast_limited(df: DataFrame, limit: int, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a frame that a `limit(n)` bounds; no hint where n is above `most`."""
    return F.broadcast(df) if limit <= most else df


def taken(df: DataFrame, limit: int, most: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, list[Row] | None]:
    """The rows of a frame that a `limit(n)` bounds, computed once: plans read them as constants, and what they tell of
    the work to come can be looked at. A frame of more than `most` rows stays a plan, and there are no rows to look at."""
    if limit > most:
        return df, None
    rows = df.collect()
    return df.sparkSession.createDataFrame(rows, df.schema), rows


def broadcast_counted(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a frame that has no more than `most` rows; for one that is cheap to count."""
    return broadcast_limited(df, df.limit(most + 1).count(), most)


def checked(df: DataFrame, name: str, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A frame written to shared storage and counted: with a broadcast hint if it has no more than `most` rows.

    For the narrow side of a join that is expected to be small, where only the data can tell. Beyond `most` rows the
    join shuffles.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    return F.broadcast(stored) if stored.count() <= most else stored


def left_lookup(df: DataFrame, key: str, table: DataFrame, spread_by: str) -> DataFrame:
    """Left join `table` on a column that is often NULL.

    Rows without a key can match nothing, yet a shuffle would send all of them to one task. A second
    join column, 0 where there is a key and a hash of `spread_by` where there is none, spreads them.
    """
    place = F.when(F.col(key).isNotNull(), F.lit(0)).otherwise(F.hash(spread_by))
    left = df.withColumn("_place", place)
    right = table.withColumn("_place", F.lit(0))
    return left.join(right, [key, "_place"], "left").drop("_place")
