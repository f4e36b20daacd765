"""Daily revenue from a stream of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspan.sources.statuses import VOID
from tillspan.streaming.run import EVENT_TIME, with_event_time


def stream_daily_revenue(orders: DataFrame, order_status: DataFrame, delay: str = "1 day") -> DataFrame:
    """One row per day once the day is closed, i.e. once an order later than its end by `delay` was seen.

    Orders arriving after their day was closed are dropped. The aggregation combines before the shuffle, so a
    busy day costs one small row per task.
    """
    void = order_status.filter(F.col("name").isin(*VOID)).select("status_id")
    return (
        with_event_time(orders, "order_ts", delay)
        .join(void, "status_id", "left_anti")
        .groupBy(F.window(EVENT_TIME, "1 day").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("subtotal").alias("gross"),
            F.sum("discount").alias("discounts"),
            F.sum("freight").alias("freight"),
            F.sum("total").alias("net"),
        )
        .select(F.col("w.start").cast("date").alias("day"), "orders", "gross", "discounts", "freight", "net")
    )
