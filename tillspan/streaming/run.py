"""Running a streaming query over everything that has arrived."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TIME = "_event_time"


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Add the watermarked event time. Watermarks want a zoned timestamp; `plans.session.tune` sets the zone to UTC,
    so that zone-free times keep their days."""
    return stream.withColumn(EVENT_TIME, F.col(ts).cast("timestamp")).withWatermark(EVENT_TIME, delay)


def drain(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> None:
    """Process all available input and append the results to Parquet files; can be called again for new input."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(out_dir)
    )
    query.awaitTermination()


def drained(stream: DataFrame, out_dir: str, checkpoint_dir: str) -> DataFrame:
    """As `drain`, and read all results so far."""
    drain(stream, out_dir, checkpoint_dir)
    return stream.sparkSession.read.schema(stream.schema).parquet(out_dir)


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Start stateful queries with this many state partitions; without a number the session's setting stays.

    Adaptive execution does not merge the partitions of a stateful query, and the number a query starts with stays
    with its checkpoint: choose it for the data the query will see in its life.
    """
    if partitions is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)
