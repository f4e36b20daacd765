"""Batch jobs on request tables and snapshots. Jobs that can refuse a request return a `rejects` frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.functions.numbers import money, zero_if_null
from tillspan.plans.joins import checked
from tillspan.plans.running import before_each_row, before_each_row_in_ranges, latest_before
from tillspan.sources.merge import apply_updates
from tillspan.sources.statuses import CANCELLED, CLOSING_FLOW, STAMP_DELIVERY, STAMP_PAYMENT, STAMP_SHIPPING
from tillspan.sources.tables import MONTH


def _json(row: Column) -> Column:
    return F.to_json(row, {"ignoreNullFields": "false"})


def _keys(df: DataFrame, column: str) -> DataFrame:
    """The distinct keys of a table, combined before the shuffle; what a semi or anti join should look into."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct()


def _rejects(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull()).select("request_id", "reason")


# --- order status -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class StatusChanges:
    orders: DataFrame
    history: DataFrame
    restock: DataFrame
    rejects: DataFrame
    changes: DataFrame  # what became of the orders that changed, for `update_orders`


# Columns of an order a change of status sets, and the column of `changes` they take; NULL there changes nothing.
CHANGED_BY_STATUS = {
    "status_id": "_status", "payment_ts": "_payment", "shipping_ts": "_shipping", "delivery_ts": "_delivery",
    "updated_at": "_touched",
}


def apply_status_changes(
    requests: DataFrame, orders: DataFrame, items: DataFrame, order_status: DataFrame
) -> StatusChanges:
    """Apply requests to orders in the order of (ts, request_id).

    A step back is refused unless it closes the order. The state an order has reached when a request arrives
    is the highest flow asked for so far: refused requests lie below it, and after a closing step only further
    closing steps pass. So acceptance is a running maximum, and no request has to wait for another.
    Cancelling puts the items back into stock, twice if it is done twice.
    """
    flows = order_status.select(F.col("status_id").alias("new_status_id"), F.col("flow").alias("new_flow"), "name")
    current = orders.select("order_id", F.col("status_id").alias("status_before"), F.lit(True).alias("known"))
    flow_before = order_status.select(F.col("status_id").alias("status_before"), F.col("flow").alias("flow_before"))
    checked = (
        requests.join(current, "order_id", "left")
        .join(flows, "new_status_id", "left")
        .join(flow_before, "status_before", "left")
    )
    missing = F.when(F.col("known").isNull(), "unknown order").when(F.col("new_flow").isNull(), "unknown status")
    sound = checked.filter(F.col("known") & F.col("new_flow").isNotNull())
    ranked = before_each_row(sound, ["order_id"], "ts", "request_id", {"asked": ("new_flow", F.max)})
    reached = F.greatest("flow_before", "asked")
    passes = (F.col("new_flow") >= CLOSING_FLOW) | F.coalesce(F.col("new_flow") >= reached, F.lit(True))
    judged = ranked.withColumn("accepted", passes)
    accepted = judged.filter("accepted")

    history = latest_before(accepted, ["order_id"], "ts", "request_id", "new_status_id", "_previous").select(
        "request_id", "order_id",
        F.coalesce("_previous", "status_before").alias("old_status_id"),
        "new_status_id", "note", "actor", F.col("ts").alias("created_at"),
    )

    def stamped(status_id: int) -> Column:
        return F.max(F.when(F.col("new_status_id") == status_id, F.col("ts")))

    changes = accepted.groupBy("order_id").agg(
        F.max_by("new_status_id", F.struct("ts", "request_id")).alias("_status"),
        stamped(STAMP_PAYMENT).alias("_payment"),
        stamped(STAMP_SHIPPING).alias("_shipping"),
        stamped(STAMP_DELIVERY).alias("_delivery"),
        F.count_if(F.col("name") == CANCELLED).alias("_cancels"),
        F.max("ts").alias("_touched"),
    )
    updated = orders.join(changes, "order_id", "left").select(
        *[F.coalesce(CHANGED_BY_STATUS[c], c).alias(c) if c in CHANGED_BY_STATUS else F.col(c) for c in orders.columns]
    )
    restock = (
        items.select("order_id", "product_id", "qty")
        .join(changes.filter("_cancels > 0").select("order_id", "_cancels"), "order_id")
        .groupBy("product_id")
        .agg(F.sum(F.col("qty") * F.col("_cancels")).alias("delta"))
    )
    refused = judged.filter("not accepted").select("request_id", F.lit("backward step").alias("reason"))
    rejects = _rejects(checked.withColumn("reason", missing)).unionByName(refused)
    return StatusChanges(updated, history, restock, rejects, changes.drop("_cancels"))


# --- carts --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class CartUpdate:
    carts: DataFrame
    rejects: DataFrame


def upsert_cart(adds: DataFrame, carts: DataFrame, products: DataFrame, cart_id_base: int = 0) -> CartUpdate:
    """Add quantities to cart lines. Only the added quantity is checked against the stock.

    A customer's line for a product grows (the one with the lowest id, should there be several); otherwise a
    new line is made whose id is `cart_id_base` plus the first request that asked for it.
    """
    carts = carts.drop(MONTH)
    goods = products.filter("active").select("product_id", "stock")
    checked = adds.join(goods, "product_id", "left").withColumn(
        "reason",
        F.when(F.col("stock").isNull(), "product missing or inactive").when(
            F.col("stock") < F.col("qty"), "insufficient stock"
        ),
    )
    accepted = (
        checked.filter("reason is null")
        .groupBy("customer_id", "product_id")
        .agg(
            F.sum("qty").alias("_added"),
            F.min("request_id").alias("_request"),
            F.min("ts").alias("_ts"),
            F.max("ts").alias("_last"),
        )
    )
    owned = carts.filter("customer_id is not null")
    targets = (
        owned.groupBy("customer_id", "product_id")
        .agg(F.min("cart_id").alias("_target"))
        .join(accepted, ["customer_id", "product_id"], "right")
    )
    growing = targets.filter("_target is not null").select(F.col("_target").alias("cart_id"), "_added", "_last")
    grown = carts.join(growing, "cart_id", "left").withColumns(
        {"qty": (F.col("qty") + zero_if_null(F.col("_added"))).cast("int"), "updated_at": F.coalesce("_last", "updated_at")}
    )
    opened = targets.filter("_target is null").select(
        (F.col("_request") + cart_id_base).alias("cart_id"), "customer_id",
        F.lit(None).cast("string").alias("session_id"), "product_id",
        F.col("_added").cast("int").alias("qty"), F.col("_ts").alias("created_at"), F.col("_last").alias("updated_at"),
    )
    return CartUpdate(grown.select(*carts.columns).unionByName(opened.select(*carts.columns)), _rejects(checked))


# --- stock --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Replenishment:
    products: DataFrame
    audit: DataFrame
    rejects: DataFrame


def replenish(requests: DataFrame, products: DataFrame) -> Replenishment:
    """Add quantities to stocks, with one audit row per request showing the stock before and after it."""
    stocks = products.select("product_id", "stock")
    checked = requests.join(stocks, "product_id", "left").withColumn(
        "reason", F.when(F.col("stock").isNull(), "unknown product")
    )
    sound = checked.filter("reason is null")
    running = before_each_row_in_ranges(sound, ["product_id"], "ts", "request_id", {"_earlier": ("qty", F.sum)})
    before = F.col("stock") + zero_if_null(F.col("_earlier"))
    audit = running.withColumns({"_before": before, "_after": before + F.col("qty")}).select(
        "request_id", F.lit("products").alias("table_name"), F.lit("UPDATE").alias("op"),
        F.col("product_id").alias("row_id"),
        F.to_json(F.struct(F.col("_before").alias("stock"))).alias("old_row"),
        F.to_json(F.struct(F.col("_after").alias("stock"), F.col("qty").alias("restocked"))).alias("new_row"),
        "actor", F.col("ts").alias("created_at"),
    )
    totals = sound.groupBy("product_id").agg(F.sum("qty").alias("_added"), F.max("ts").alias("_ts"))
    joined = products.join(totals, "product_id", "left")
    changed = {"stock": (F.col("stock") + zero_if_null(F.col("_added"))).cast("int")}
    if "updated_at" in products.columns:
        changed["updated_at"] = F.coalesce("_ts", "updated_at")
    return Replenishment(joined.withColumns(changed).select(*products.columns), audit, _rejects(checked))


# --- changes applied to stored tables -------------------------------------------------------------------------


def update_stock(spark: SparkSession, directory: str, deltas: DataFrame, batch: str, ts: Column) -> None:
    """Add (product_id, delta) to the stored products. A batch applied again changes nothing."""
    change = lambda u: {"stock": (F.col("stock") + u["delta"]).cast("int"), "updated_at": ts}
    apply_updates(spark, directory, "products", deltas.select("product_id", "delta"), ["product_id"], change, batch)


def update_orders(spark: SparkSession, directory: str, changes: DataFrame, batch: str) -> None:
    """Apply the `changes` of `apply_status_changes` to the stored orders, in the months they lie in."""
    change = lambda u: {c: F.coalesce(u[new], F.col(c)) for c, new in CHANGED_BY_STATUS.items()}
    apply_updates(spark, directory, "orders", changes, ["order_id"], change, batch)


# --- snapshots ----------------------------------------------------------------------------------------------


def _sides(old: DataFrame, new: DataFrame, key: str, ignore: Sequence[str]) -> DataFrame:
    """Both versions of every row side by side, with the columns that count for a change."""
    columns = old.columns
    compared = [c for c in columns if c not in ignore]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.col(key),
            F.struct(*columns).alias(f"{name}_row"),
            F.struct(*compared).alias(f"{name}_value"),
        )

    return side(old, "old").join(side(new, "new"), key, "full_outer")


def change_log(
    old: DataFrame, new: DataFrame, key: str, table_name: str, ignore: Sequence[str] = ()
) -> DataFrame:
    """INSERT, UPDATE and DELETE rows with both versions as JSON. Columns in `ignore` make no change by themselves.

    Rows are compared by value, so no change can hide behind a hash collision.
    """
    changed = _sides(old, new, key, ignore).filter(~F.col("old_value").eqNullSafe(F.col("new_value")))
    op = (
        F.when(F.col("old_row").isNull(), "INSERT").when(F.col("new_row").isNull(), "DELETE").otherwise("UPDATE")
    )
    return changed.select(
        F.lit(table_name).alias("table_name"), op.alias("op"), F.col(key).alias("row_id"),
        _json(F.col("old_row")).alias("old_row"), _json(F.col("new_row")).alias("new_row"),
    )


def low_stock_alerts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Products whose stock fell to or below the minimum between two snapshots."""
    above = old.filter(F.col("stock") > F.col("stock_min")).select("product_id", F.col("stock").alias("stock_before"))
    return (
        new.filter(F.col("stock") <= F.col("stock_min"))
        .select("product_id", "name", "stock", "stock_min")
        .join(above, "product_id")
        .select("product_id", "name", "stock_before", "stock", "stock_min")
    )


def stamp_updates(old: DataFrame, new: DataFrame, key: str, ts: Column) -> DataFrame:
    """The newer snapshot with `updated_at` set on rewritten rows only; new rows keep what they came with."""
    ignore = ("updated_at",)
    joined = _sides(old, new, key, ignore).filter(F.col("new_row").isNotNull())
    stamp = (
        F.when(F.col("old_row").isNull(), F.col("new_row.updated_at"))
        .when(F.col("old_value").eqNullSafe(F.col("new_value")), F.col("old_row.updated_at"))
        .otherwise(ts)
    )
    return joined.select(*[
        stamp.alias(c) if c == "updated_at" else F.col(f"new_row.{c}").alias(c) for c in old.columns
    ])


# --- rows ---------------------------------------------------------------------------------------------------


def item_subtotals(items: DataFrame) -> DataFrame:
    """Items with the subtotal recomputed, whatever was supplied."""
    net = F.col("unit_price") - F.coalesce(F.col("unit_discount"), F.lit(0))
    return items.withColumn("subtotal", money(net * F.col("qty")))


@dataclass(frozen=True)
class DeletePlan:
    customers: DataFrame
    addresses: DataFrame
    refusals: DataFrame


def plan_deletes(
    requests: DataFrame, customers: DataFrame, orders: DataFrame, addresses: DataFrame, reviews: DataFrame,
    carts: DataFrame,
) -> DeletePlan:
    """Which of the named customers can go. Orders, reviews and carts hold a customer; addresses go with it."""
    asked = customers.join(_keys(requests, "customer_id"), "customer_id", "left_semi")
    held = asked
    for name, table in (("orders", orders), ("reviews", reviews), ("carts", carts)):
        held = held.join(_keys(table, "customer_id").withColumn(f"_{name}", F.lit(True)), "customer_id", "left")
    reason = (
        F.when(F.col("_orders"), "has orders").when(F.col("_reviews"), "has reviews").when(F.col("_carts"), "has carts")
    )
    judged = held.withColumn("reason", reason)
    leaving = judged.filter("reason is null").select(*customers.columns)
    return DeletePlan(
        leaving,
        addresses.join(leaving.select("customer_id"), "customer_id", "left_semi"),
        judged.filter("reason is not null").select("customer_id", "reason"),
    )


def merge_items(items: DataFrame, seq: Sequence[str] = ("item_id",)) -> DataFrame:
    """One row per (order, product). Quantities add up; unit price and discount stay those of the first row in
    the order of `seq`, while the subtotal is taken at the price and discount of the last one.

    Most items stand alone with their order and product; these pass without being moved, and only the keys are counted
    by a shuffle of all.
    """
    alone, several = _alone_and_several(items, ["order_id", "product_id"], "merge-items")
    net = F.col("unit_price") - F.coalesce(F.col("unit_discount"), F.lit(0))
    alone = alone.select(
        "item_id", "order_id", "product_id", F.col("qty").cast("int").alias("qty"), "unit_price", "unit_discount",
        money(net * F.col("qty")).alias("subtotal"),
    )
    order = F.struct(*seq)
    merged = several.groupBy("order_id", "product_id").agg(
        F.min_by(F.struct("item_id", "unit_price", "unit_discount"), order).alias("first"),
        F.max_by(F.struct("unit_price", "unit_discount"), order).alias("last"),
        F.sum("qty").alias("qty"),
    )
    last_net = F.col("last.unit_price") - F.coalesce(F.col("last.unit_discount"), F.lit(0))
    return alone.unionByName(merged.select(
        "first.item_id", "order_id", "product_id", F.col("qty").cast("int").alias("qty"), "first.unit_price",
        "first.unit_discount", money(last_net * F.col("qty")).alias("subtotal"),
    ))


def _alone_and_several(df: DataFrame, keys: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose key no other row has, and the others. NULL is a key like any other.

    Counting moves the keys alone, by a hash aggregate. The keys that several rows have are written and counted; where
    they are few they are broadcast, and no row is moved to tell the two kinds apart.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = checked(repeated.select(*[F.col(k).alias(f"_{k}") for k in keys]), name)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def dedupe_reviews(reviews: DataFrame) -> DataFrame:
    """The first review of each customer for each product."""
    alone, several = _alone_and_several(reviews, ["product_id", "customer_id"], "dedupe-reviews")
    first = F.min_by(F.struct(*reviews.columns), F.col("review_id")).alias("first")
    return alone.unionByName(several.groupBy("product_id", "customer_id").agg(first).select("first.*"))


def backfill_status_history(orders: DataFrame, note: str = "Automatic status update", actor: str = "system") -> DataFrame:
    """One history row per order: from the state before its present one, if there is any."""
    return orders.select(
        "order_id",
        F.when(F.col("status_id") > 1, F.col("status_id") - 1).alias("old_status_id"),
        F.col("status_id").alias("new_status_id"),
        F.lit(note).alias("note"), F.lit(actor).alias("actor"), F.col("order_ts").alias("created_at"),
    )


def assign_delivery_address(orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Orders with the customer's principal address, else any of theirs (lowest id); NULL where there is none."""
    principal = F.min(F.when(F.col("principal"), F.col("address_id")))
    chosen = addresses.groupBy("customer_id").agg(F.coalesce(principal, F.min("address_id")).alias("_address"))
    joined = orders.join(chosen, "customer_id", "left")
    return joined.select(*[F.col("_address").alias(c) if c == "address_id" else F.col(c) for c in orders.columns])
