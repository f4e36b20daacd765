"""Low-stock alerts from a stream of stock movements."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.streaming.run import EVENT_TIME, with_event_time

ALERT_SCHEMA = "product_id bigint, period_end timestamp_ntz, stock_before bigint, stock bigint, stock_min bigint"

# The state of the alert job lives in this store; it has to be chosen before the query starts.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Start stateful queries with that store; the session's own setting comes back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stream_low_stock(
    deltas: DataFrame, products: DataFrame, period: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """An alert whenever a product's stock, seen at the ends of periods, falls to or below its minimum.

    Movements are summed per product and period first. That step combines before the shuffle, so a product with
    a third of all movements reaches its state as one row per period; alerts do not depend on how the input is cut
    into batches.

    The state of a product is its stock and its minimum. They are taken from `products` when the query first starts
    and never again: a restart goes on with the stock in the state, whatever the table has become in between, so that
    no movement counts twice. Products that are not in the table then have no stock and raise no alerts.
    """
    floors = products.filter("product_id is not null").select(
        "product_id", F.col("stock").cast("bigint"), F.col("stock_min").cast("bigint")
    )
    periods = (
        with_event_time(deltas, "ts", delay)
        .groupBy(F.window(EVENT_TIME, period).alias("w"), "product_id")
        .agg(F.sum("delta").alias("delta"))
        .select("product_id", F.col("w.end").cast("timestamp_ntz").alias("period_end"), "delta")
    )
    return periods.groupBy("product_id").transformWithState(
        _alert_processor(),
        outputStructType=ALERT_SCHEMA,
        outputMode="Append",
        timeMode="None",
        initialState=floors.groupBy("product_id"),
    )


def _alert_processor():
    # Made inside a function so that it travels to the workers by value.
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    class Alerts(StatefulProcessor):
        """Rows as they are: most products have few of them, for which a pandas frame each costs far more."""

        def init(self, handle):
            self.level = handle.getValueState("level", "stock bigint, stock_min bigint")
            self.started = None

        def handleInitialState(self, key, initialState, timerValues):
            # Rows of a key come together; of a product that is listed twice the first one counts.
            if key == self.started:
                return
            self.started = key
            if initialState["stock"] is not None and initialState["stock_min"] is not None:
                self.level.update((initialState["stock"], initialState["stock_min"]))

        def handleInputRows(self, key, rows, timerValues):
            level = self.level.get()
            if level is None:
                return
            stock, floor = level
            found = []
            for row in sorted(rows, key=lambda row: row["period_end"]):
                before, stock = stock, stock + (row["delta"] or 0)
                if stock <= floor < before:
                    found.append(Row(product_id=key[0], period_end=row["period_end"], stock_before=before, stock=stock, stock_min=floor))
            self.level.update((stock, floor))
            yield from found

        def close(self):
            pass

    return Alerts()
