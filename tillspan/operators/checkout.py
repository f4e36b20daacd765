"""Batch checkout: carts become orders, with stock and coupons shared among competing requests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspan.functions.numbers import money, zero_if_null
from tillspan.functions.pricing import coupon_amount, final_price, freight
from tillspan.plans.groups import connected
from tillspan.plans.joins import left_lookup
from tillspan.plans.lineage import cut
from tillspan.plans.running import before_each_row_in_ranges


@dataclass(frozen=True)
class Checkout:
    orders: DataFrame
    items: DataFrame
    stock_deltas: DataFrame
    coupon_use: DataFrame
    history: DataFrame
    carts: DataFrame
    rejects: DataFrame


# So many contested lines are folded in one task; their work grows with the square of the products among them at most.
FOLD_LINES = 4000
EMPTY, NO_ADDRESS, NO_STOCK = "empty cart", "unknown address", "insufficient stock"


def checkout(
    requests: DataFrame,
    carts: DataFrame,
    products: DataFrame,
    addresses: DataFrame,
    coupons: DataFrame,
    order_status: DataFrame,
    order_id_base: int = 0,
    fold_lines: int = FOLD_LINES,
) -> Checkout:
    """Turn carts into orders as if the requests ran one by one in the order of (ts, request_id).

    The first request of a customer that has a cart and a known address competes for it; once it is accepted
    the cart is gone, and if it is refused for stock so are the later ones, as stock only falls in a batch.
    An order takes the id `order_id_base + request_id`.
    """
    lines, totals = _cart_lines(requests, carts, products)
    known = addresses.select("address_id", "postcode", F.lit(True).alias("known"))
    judged = (
        requests.join(totals, "customer_id", "left")
        .join(known, "address_id", "left")
        .withColumn("filled", F.coalesce(F.col("subtotal") > 0, F.lit(False)))
    )
    first = (
        judged.filter("filled and known")
        .groupBy("customer_id")
        .agg(F.min(F.struct("ts", "request_id")).alias("_first"))
        .select("customer_id", F.col("_first.ts").alias("first_ts"), F.col("_first.request_id").alias("first_id"))
    )
    candidates = judged.join(first.select(F.col("first_id").alias("request_id")), "request_id", "left_semi")
    wanted = candidates.select("request_id", "ts", "customer_id").join(lines, "customer_id")
    refused = cut(_without_stock(wanted, fold_lines))

    accepted = candidates.join(refused, "request_id", "left_anti")
    priced, coupon_use = _with_discounts(accepted, coupons)
    # Always one row: without an initial state orders have none.
    start = order_status.filter("flow = 1").agg(F.min("status_id").alias("status_id"))
    cost = freight(F.col("postcode"), F.col("subtotal"), F.lit(1))
    orders = (
        priced.withColumn("freight", cost)
        .crossJoin(F.broadcast(start))
        .select(
            (F.col("request_id") + order_id_base).alias("order_id"),
            F.concat(F.lit("ORD"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit("-"), "request_id").alias("order_no"),
            "customer_id", "address_id", "status_id", "method_id", "subtotal", "discount", "freight",
            money(F.col("subtotal") - F.col("discount") + F.col("freight")).alias("total"),
            F.coalesce("instalments", F.lit(1)).alias("instalments"),
            "coupon_code", F.col("ts").alias("order_ts"),
            *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("payment_ts", "shipping_ts", "delivery_ts")],
            *[F.lit(None).cast("string").alias(c) for c in ("notes", "client_ip")],
            F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"),
        )
    )
    sold = wanted.join(refused, "request_id", "left_anti")
    items = sold.select(
        (F.col("request_id") + order_id_base).alias("order_id"), "product_id", "qty",
        F.col("price").alias("unit_price"), money(F.col("qty") * F.col("price")).alias("subtotal"),
    )
    stock_deltas = sold.groupBy("product_id").agg((-F.sum("qty")).alias("delta"))
    history = orders.select(
        "order_id", F.lit(None).cast("bigint").alias("old_status_id"), F.col("status_id").alias("new_status_id"),
        F.lit("Order created").alias("note"), F.lit("system").alias("actor"), F.col("order_ts").alias("created_at"),
    )
    emptied = accepted.select("customer_id", F.lit(True).alias("_emptied"))
    left = left_lookup(carts, "customer_id", emptied, spread_by="cart_id").filter("_emptied is null")

    served = first.join(refused.select(F.col("request_id").alias("first_id"), F.lit(True).alias("failed")), "first_id", "left")
    later = (F.col("ts") > F.col("first_ts")) | (
        (F.col("ts") == F.col("first_ts")) & (F.col("request_id") > F.col("first_id"))
    )
    reason = (
        F.when(~F.col("filled"), EMPTY)
        .when(F.col("failed").isNull() & later, EMPTY)
        .when(F.col("known").isNull(), NO_ADDRESS)
        .when(F.col("failed"), NO_STOCK)
    )
    rejects = (
        judged.join(served, "customer_id", "left")
        .withColumn("reason", reason)
        .filter("reason is not null")
        .select("request_id", "reason")
    )
    return Checkout(orders, items, stock_deltas, coupon_use, history, left.select(*carts.columns), rejects)


def _cart_lines(requests: DataFrame, carts: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One line per customer and product with price and what can be taken, and the value of each cart."""
    asking = requests.select("customer_id").distinct()
    goods = products.select(
        "product_id",
        final_price(F.col("price"), F.col("promo_price")).alias("price"),
        # Nothing can be taken of an inactive product.
        F.when(F.col("active"), F.col("stock")).otherwise(0).alias("cap"),
    )
    lines = (
        carts.filter("customer_id is not null")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("qty").alias("qty"))
        .join(asking, "customer_id", "left_semi")
        .join(goods, "product_id", "left")
        .withColumn("cap", zero_if_null(F.col("cap")))
    )
    totals = lines.groupBy("customer_id").agg(money(F.sum(F.col("qty") * F.col("price"))).alias("subtotal"))
    return lines, totals


def _without_stock(wanted: DataFrame, fold_lines: int = FOLD_LINES) -> DataFrame:
    """Ids of the requests refused for stock, exactly as in one-by-one processing.

    Only products asked for beyond their stock matter. If few lines ask for them, these are folded one by one in a
    single task. Else a round finds for each line two bounds of the demand before it: that of the accepted requests,
    and that of the accepted and the open ones. A request passes if all its lines fit under the upper bound and fails
    if one does not fit under the lower bound; what stays open hangs together through shared products, and each such
    group is folded on its own, the groups in parallel. Of a group with more than `fold_lines` lines only the first
    so many are folded, as no request depends on later ones; the others take part in the next round.
    """
    hopeless = wanted.filter(F.col("qty") > F.col("cap")).select("request_id").distinct()
    possible = wanted.join(hopeless, "request_id", "left_anti").select("request_id", "ts", "product_id", "qty", "cap")
    scarce = (
        possible.groupBy("product_id")
        .agg(F.sum("qty").alias("demand"), F.max("cap").alias("cap"))
        .filter("demand > cap")
        .select("product_id")
    )
    contested = cut(possible.join(scarce, "product_id", "left_semi").withColumn("accepted", F.lit(False)))
    state, first = contested, True
    while True:
        n_open = state.filter("not accepted").count()
        if not n_open:
            break
        if n_open > fold_lines:
            state = cut(_decide(state))
            n_open = state.filter("not accepted").count()
            if not n_open:
                break
        rooms = state.withColumn("room", F.col("cap")) if first and n_open == state.count() else _with_rooms(state)
        if n_open <= fold_lines:
            asked = rooms.filter("not accepted").withColumn("group", F.lit(0).cast("bigint"))
        else:
            asked = _first_of_groups(rooms.filter("not accepted"), fold_lines)
        state, first = cut(_settled(state, _folded(asked))), False
    # What is left over at the end was accepted; the rest of the contested requests failed.
    passed = state.select("request_id").distinct()
    failed = contested.select("request_id").distinct().join(passed, "request_id", "left_anti")
    return hopeless.unionByName(failed)


def _decide(state: DataFrame) -> DataFrame:
    """One round: the lines of open requests are marked accepted, dropped, or left open."""
    bounds = before_each_row_in_ranges(
        state.withColumn("sure", F.when(F.col("accepted"), F.col("qty")).otherwise(0)),
        ["product_id"], "ts", "request_id", {"most": ("qty", F.sum), "least": ("sure", F.sum)},
    )
    fits = zero_if_null(F.col("most")) + F.col("qty") <= F.col("cap")
    fails = zero_if_null(F.col("least")) + F.col("qty") > F.col("cap")
    verdicts = (
        bounds.filter("not accepted")
        .groupBy("request_id")
        .agg(F.min(fits).alias("passes"), F.max(fails).alias("fails"))
        .filter("passes or fails")
        .select("request_id", (F.col("passes") & ~F.col("fails")).alias("verdict"))
    )
    return _settled(state, verdicts)


def _settled(state: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The lines after some requests were decided: accepted ones marked, refused ones gone."""
    accepted = F.col("accepted") | F.coalesce("verdict", F.lit(False))
    return (
        state.join(verdicts, "request_id", "left")
        .filter("verdict is null or verdict")
        .select("request_id", "ts", "product_id", "qty", "cap", accepted.alias("accepted"))
    )


def _with_rooms(state: DataFrame) -> DataFrame:
    """What of each line's stock the accepted requests before it have left."""
    sure = state.withColumn("sure", F.when(F.col("accepted"), F.col("qty")).otherwise(0))
    found = before_each_row_in_ranges(sure, ["product_id"], "ts", "request_id", {"least": ("sure", F.sum)})
    return found.withColumn("room", F.col("cap") - zero_if_null(F.col("least"))).drop("least", "sure")


def _first_of_groups(lines: DataFrame, fold_lines: int) -> DataFrame:
    """Open lines with their group, of large groups those of the first requests only.

    The lines before a request are counted in ranges, as a group may hold most lines of a batch.
    """
    grouped = lines.join(connected(lines, "request_id", "product_id"), "request_id")
    sizes = grouped.groupBy("group", "ts", "request_id").agg(F.count(F.lit(1)).alias("n"))
    queued = before_each_row_in_ranges(sizes, ["group"], "ts", "request_id", {"before": ("n", F.sum)})
    # The first request of a group is always among them, however many lines it has.
    near = queued.filter(zero_if_null(F.col("before")) < fold_lines).select("request_id")
    return grouped.join(near, "request_id", "left_semi")


def _folded(asked: DataFrame) -> DataFrame:
    """(request_id, verdict) of requests decided one after the other inside their group.

    `room` is what a line finds if no open request before it takes anything; the fold carries what those before it
    took of each product.
    """
    line = F.struct("product_id", F.col("qty").cast("bigint").alias("qty"), F.col("room").cast("bigint").alias("room"))
    requests = asked.groupBy("group", "ts", "request_id").agg(F.collect_list(line).alias("lines"))
    queues = requests.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("ts", "request_id", "lines"))).alias("queue"))
    nothing = F.struct(
        F.create_map().cast("map<bigint,bigint>").alias("taken"), F.array().cast("array<struct<request_id:bigint,verdict:boolean>>").alias("verdicts")
    )

    def step(so_far: Column, request: Column) -> Column:
        before = lambda at: F.coalesce(F.element_at(so_far["taken"], at["product_id"]), F.lit(0).cast("bigint"))
        fits = F.forall(request["lines"], lambda at: before(at) + at["qty"] <= at["room"])
        takes = F.map_from_entries(F.transform(request["lines"], lambda at: F.struct(at["product_id"], at["qty"])))
        zero = F.lit(0).cast("bigint")
        more = F.map_zip_with(so_far["taken"], takes, lambda _, a, b: F.coalesce(a, zero) + F.coalesce(b, zero))
        verdict = F.struct(request["request_id"].alias("request_id"), fits.alias("verdict"))
        return F.struct(
            F.when(fits, more).otherwise(so_far["taken"]).alias("taken"), F.concat(so_far["verdicts"], F.array(verdict)).alias("verdicts")
        )

    folded = queues.select(F.aggregate("queue", nothing, step, lambda end: end["verdicts"]).alias("verdicts"))
    return folded.select(F.inline("verdicts"))


def _with_discounts(accepted: DataFrame, coupons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Discounts in the order of the requests; a coupon that runs out gives nothing to the ones behind."""
    offers = coupons.filter("active").select(
        F.col("code").alias("_code"), "kind", F.col("value").alias("amount"), "min_order", "max_uses",
        F.coalesce("used", F.lit(0)).alias("used"), "starts", "ends",
    )
    coded = accepted.withColumn("_code", F.upper("coupon_code"))
    matched = left_lookup(coded, "_code", offers, spread_by="request_id")
    in_dates = F.col("ts").cast("date").between(F.col("starts"), F.col("ends"))
    cut_off = coupon_amount(F.col("kind"), F.col("amount"), F.col("min_order"), F.col("subtotal"))
    offered = matched.withColumn("offer", F.when(in_dates, cut_off))
    claims = before_each_row_in_ranges(
        offered.filter("offer > 0").select("request_id", "ts", "_code", "offer", "used", "max_uses", F.lit(1).alias("one")),
        ["_code"], "ts", "request_id", {"earlier": ("one", F.sum)},
    )
    under_cap = F.col("max_uses").isNull() | (F.col("used") + zero_if_null(F.col("earlier")) < F.col("max_uses"))
    granted = claims.filter(under_cap)
    priced = accepted.join(granted.select("request_id", F.col("offer").alias("discount")), "request_id", "left")
    uses = granted.groupBy(F.col("_code").alias("code")).agg(F.count(F.lit(1)).alias("uses"))
    return priced.withColumn("discount", F.coalesce("discount", money(F.lit(0)))), uses
