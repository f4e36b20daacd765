"""The ten sales reports and their variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillspan.functions.dates import (
    DateLike,
    age_on,
    date_lit,
    day_after,
    days_before,
    instant,
    month_of,
    month_start,
    months_apart,
    seconds_between,
    shift_months,
)
from tillspan.functions.numbers import ratio, zero_if_null
from tillspan.functions.pricing import final_price
from tillspan.operators.common import (
    add_place,
    category_names,
    count_when,
    most_frequent,
    not_void,
    order_keys,
    status_ids,
    sum_when,
    with_place,
)
from tillspan.plans.joins import broadcast_counted, broadcast_limited, checked, taken
from tillspan.sources.statuses import AWAITING, CANCELLED, CONFIRMED, DELIVERED, MOVING, VOID
from tillspan.sources.tables import Retail, in_period


def sales_detail(t: Retail, start: DateLike, end: DateLike, ordered: bool = True) -> DataFrame:
    """One row per item sold with start <= order time < end, newest first.

    `ordered=False` leaves out the sort of the whole detail, for callers that write it to a table.
    """
    keys = order_keys(t)
    sold = in_period(t.orders, "order_ts", start, end).select(
        *keys, "order_no", "order_ts", "customer_id", "address_id", "method_id", "instalments",
        "discount", "freight", "total",
    )
    buyers = t.customers.select("customer_id", F.col("name").alias("customer"), "nickname", "level", "email")
    methods = t.payment_methods.select("method_id", F.col("name").alias("payment_method"))
    heads = with_place(sold.join(methods, "method_id"), t).join(buyers, "customer_id")
    goods = t.products.select("product_id", F.col("name").alias("product"), "franchise", "category_id").join(
        category_names(t), "category_id"
    )
    lines = t.order_items.select(*keys, "product_id", "qty", "unit_price", "subtotal")
    detail = (
        lines.join(heads, keys)
        .join(goods, "product_id")
        .select(
            "order_no", "order_ts", "customer", "nickname", "level", "email", "city", "state", "product",
            "franchise", "category", "qty", "unit_price", F.col("subtotal").alias("item_value"),
            "payment_method", "instalments", F.col("discount").alias("order_discount"), "freight",
            F.col("total").alias("order_total"),
        )
    )
    return detail.orderBy(F.col("order_ts").desc(), F.col("customer").asc()) if ordered else detail


def best_sellers(t: Retail, limit: int = 100) -> DataFrame:
    """Active products by units sold, with revenue, delivered orders and approved ratings.

    The ranking needs quantities, values and numbers of lines only, which combine before the shuffle. The list is
    computed once; the orders are then looked up for the lines of the listed products alone, whose number the list
    tells: if they are few, they are broadcast to the orders and neither fact is shuffled.
    """
    sold = t.order_items.groupBy("product_id").agg(
        F.sum("qty").alias("units"), F.sum("subtotal").cast(DecimalType(28, 2)).alias("sales"), F.count(F.lit(1)).alias("lines")
    )
    ranked = (
        t.products.filter("active")
        .select("product_id", "category_id", F.col("name").alias("product"), "sku", "price", "stock")
        .join(category_names(t), "category_id")
        .join(sold, "product_id", "left")
    )
    best_first = [F.col("units").desc_nulls_last(), F.col("product_id")]
    listed, rows = taken(ranked.orderBy(*best_first).limit(limit), limit)
    ids = broadcast_limited(listed.select("product_id"), limit)
    lines = t.order_items.select("order_id", "product_id").join(ids, "product_id", "left_semi").distinct()
    if rows is not None:
        lines = broadcast_limited(lines, sum(row["lines"] or 0 for row in rows))
    delivered = t.orders.join(status_ids(t, DELIVERED), "status_id", "left_semi").select("order_id")
    delivered = delivered.join(lines, "order_id").groupBy("product_id").agg(F.count(F.lit(1)).alias("delivered"))
    ratings = (
        t.reviews.filter("approved")
        .join(ids, "product_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("rating").alias("rated"), F.count(F.lit(1)).alias("n"))
    )
    return (
        # One row per listed product at most.
        listed.join(broadcast_limited(delivered, limit), "product_id", "left")
        .join(broadcast_limited(ratings, limit), "product_id", "left")
        .orderBy(*best_first)
        .select(
            "product_id", "category", "product", "sku", "price",
            zero_if_null(F.col("units")).alias("units_sold"),
            zero_if_null(F.col("sales")).alias("revenue"),
            zero_if_null(F.col("delivered")).alias("delivered_orders"),
            zero_if_null(ratio(F.col("rated"), F.col("n"), 2)).alias("avg_rating"),
            zero_if_null(F.col("n")).alias("n_reviews"),
            "stock",
        )
    )


def vip_customers(t: Retail, as_of: DateLike, limit: int = 50) -> DataFrame:
    """Active customers by total spent.

    The ranking takes all it can from one pass over the orders. The list is computed once and tells how many orders it
    stands for: if they are few, they are broadcast to the items, which then aren't shuffled.
    """
    bought = t.orders.groupBy("customer_id").agg(
        F.sum("total").alias("spent"), F.count(F.lit(1)).alias("n"),
        F.min("order_ts").alias("first_order"), F.max("order_ts").alias("last_order"),
    )
    ranked = (
        t.customers.filter("active")
        .select("customer_id", "name", "email", "birth_date", "created_at")
        .join(bought, "customer_id", "left")
    )
    most_first = [F.col("spent").desc_nulls_last(), F.col("customer_id")]
    listed, rows = taken(ranked.orderBy(*most_first).limit(limit), limit)
    ids = broadcast_limited(listed.select("customer_id"), limit)
    keys = order_keys(t)
    orders = t.orders.select(*keys, "customer_id").join(ids, "customer_id", "left_semi")
    if rows is not None:
        orders = broadcast_limited(orders, sum(row["n"] or 0 for row in rows))
    kinds = (
        t.order_items.select(*keys, "product_id")
        .join(orders, keys)
        .groupBy("customer_id")
        .agg(F.countDistinct("product_id").alias("kinds"))
    )
    homes = (
        t.addresses.filter("principal")
        .join(ids, "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.min_by("city_id", "address_id").alias("city_id"))
    )
    homes = add_place(homes, t).select("customer_id", F.concat("city", F.lit("/"), "state").alias("main_city"))
    return (
        # One row per listed customer at most.
        listed.join(broadcast_limited(kinds, limit), "customer_id", "left")
        .join(broadcast_limited(homes, limit), "customer_id", "left")
        .orderBy(*most_first)
        .select(
            "customer_id", "name", "email", "birth_date", age_on(F.col("birth_date"), as_of).alias("age"),
            "main_city",
            zero_if_null(F.col("n")).alias("orders"),
            zero_if_null(F.col("spent")).alias("total_spent"),
            zero_if_null(ratio(F.col("spent"), F.col("n"), 2)).alias("avg_order"),
            "last_order", "first_order",
            zero_if_null(F.col("kinds")).alias("distinct_products"),
            F.col("created_at").alias("customer_since"),
        )
    )


def _order_category_lines(t: Retail) -> DataFrame:
    """Sales per order and category: one row of ids and sums, still partitioned by order after the join."""
    goods = t.products.select("product_id", "category_id")
    heads = t.orders.select("order_id", "address_id").join(
        t.addresses.select("address_id", "city_id"), "address_id"
    )
    return (
        t.order_items.select("order_id", "product_id", "qty", "subtotal")
        .join(goods, "product_id")
        .join(heads, "order_id")
        .groupBy("order_id", "city_id", "category_id")
        .agg(F.sum("qty").alias("units"), F.sum("subtotal").alias("revenue"), F.count(F.lit(1)).alias("n_lines"))
    )


def region_category_revenue(t: Retail) -> DataFrame:
    """Sales per region, state, city and category, with share and rank inside the region."""
    by_city = (
        _order_category_lines(t)
        .groupBy("city_id", "category_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
            F.sum("n_lines").alias("n_lines"),
        )
    )
    sales = (
        add_place(by_city, t)
        .join(category_names(t), "category_id")
        .groupBy("region", "state", "city", "category")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("units").alias("units"),
            F.sum("revenue").cast(DecimalType(28, 2)).alias("revenue"),
            F.sum("n_lines").alias("n_lines"),
        )
    )
    region = Window.partitionBy("region")
    total = F.sum("revenue").over(region)
    return (
        sales.select(
            "region", "state", "city", "category", "orders", "units", "revenue",
            ratio(F.col("revenue"), F.col("n_lines"), 2).alias("avg_item_value"),
            total.alias("region_revenue"),
            ratio(F.col("revenue"), total, 2, times=100).alias("region_pct"),
            F.rank().over(region.orderBy(F.col("revenue").desc())).alias("region_rank"),
        )
        .orderBy("region", F.col("revenue").desc())
    )


def region_category_rollup(t: Retail) -> DataFrame:
    """Subtotals over region, state and category. `level` is 0 for single categories, 7 for the grand total.

    An order counts once in each subtotal although it may hold several categories. One row per order is
    marked, so that every level but the lowest counts marks; no distinct count has to run over the facts.
    """
    order = Window.partitionBy("order_id")
    known = _order_category_lines(t).join(t.categories.select("category_id"), "category_id", "left_semi")
    marked = known.withColumn(
        "first_of_order", (F.col("category_id") == F.min("category_id").over(order)).cast("int")
    )
    by_city = marked.groupBy("city_id", "category_id").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum("first_of_order").alias("firsts"),
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
    )
    small = add_place(by_city, t).join(category_names(t), "category_id")
    return (
        small.rollup("region", "state", "category")
        .agg(
            F.grouping_id().alias("level"),
            F.sum("pairs").alias("pairs"),
            F.sum("firsts").alias("firsts"),
            F.sum("units").alias("units"),
            F.sum("revenue").cast(DecimalType(28, 2)).alias("revenue"),
        )
        .select(
            "region", "state", "category", "level",
            F.when(F.col("level") == 0, F.col("pairs")).otherwise(F.col("firsts")).alias("orders"),
            "units", "revenue",
        )
        .orderBy(
            F.col("region").asc_nulls_last(), F.col("state").asc_nulls_last(), F.col("revenue").desc(), "category"
        )
    )


def cart_conversion(t: Retail, limit: int = 50) -> DataFrame:
    """Active products by the number of cart lines they are in, against what was sold of them.

    The list depends on the number of cart lines alone; everything else is read for the products on it.
    """
    ranked = (
        t.products.filter("active")
        .select("product_id", F.col("name").alias("product"), "sku", "category_id", "price", "stock")
        .join(category_names(t), "category_id")
        .join(t.carts.groupBy("product_id").agg(F.count(F.lit(1)).alias("cart_lines")), "product_id")
    )
    most_first = [F.col("cart_lines").desc(), F.col("product_id")]
    listed, _ = taken(ranked.orderBy(*most_first).limit(limit), limit)
    ids = broadcast_limited(listed.select("product_id"), limit)
    wanted = (
        t.carts.join(ids, "product_id", "left_semi")
        .groupBy("product_id")
        .agg(F.sum("qty").alias("cart_units"), F.countDistinct("customer_id").alias("interested_customers"))
    )
    # What was sold of the listed products, by order: written and counted, so that few rows are broadcast to the orders.
    lines = checked(
        t.order_items.select("order_id", "product_id", "qty")
        .join(ids, "product_id", "left_semi")
        .groupBy("product_id", "order_id")
        .agg(F.sum("qty").alias("units")),
        "cart-conversion",
    )
    good = not_void(t.orders, t, VOID).select("order_id").join(lines.select("order_id", "product_id"), "order_id")
    good = good.groupBy("product_id").agg(F.count(F.lit(1)).alias("good_orders"))
    sold = lines.groupBy("product_id").agg(F.sum("units").alias("units"))
    units = zero_if_null(F.col("units"))
    return (
        # One row per listed product at most.
        listed.join(broadcast_limited(wanted, limit), "product_id")
        .join(broadcast_limited(sold, limit), "product_id", "left")
        .join(broadcast_limited(good, limit), "product_id", "left")
        .orderBy(*most_first)
        .select(
            "product_id", "product", "sku", "category", "price", "stock", "cart_lines", "cart_units",
            "interested_customers",
            units.alias("units_sold"),
            zero_if_null(F.col("good_orders")).alias("completed_orders"),
            ratio(units, F.col("cart_units"), 2, times=100).alias("conversion_pct"),
            (F.col("cart_units") - units).alias("abandon_potential"),
        )
    )


def _with_items(orders: DataFrame, t: Retail) -> DataFrame:
    """Orders that have items, with month sold, number of items and units."""
    keys = order_keys(t)
    items = t.order_items.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"), F.sum("qty").alias("units"))
    both = orders.select(*keys, "order_ts", "customer_id", "total").join(items, keys)
    return both.select("customer_id", month_of(F.col("order_ts")).alias("month"), "total", "n_items", "units")


def monthly_trend(t: Retail, since: DateLike) -> DataFrame:
    """Months since a date with growth, moving average and rank.

    Revenue and average are weighted by the number of item rows, because the defining report sums order totals
    after joining the items. `monthly_trend_order_grain` counts every order once.
    """
    valid = not_void(in_period(t.orders, "order_ts", since), t, VOID)
    per_order = _with_items(valid, t)
    weighted = (F.col("total") * F.col("n_items").cast(DecimalType(10, 0))).cast(DecimalType(22, 2))
    months = (
        per_order.groupBy("month", "customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(weighted).alias("revenue"),
            F.sum("n_items").alias("n_items"),
            F.sum("units").alias("units"),
        )
        .groupBy("month")
        .agg(
            F.sum("orders").alias("orders"),
            F.count("customer_id").alias("customers"),
            F.sum("revenue").cast(DecimalType(30, 2)).alias("revenue"),
            F.sum("n_items").alias("n_items"),
            F.sum("units").alias("units"),
        )
    )
    # One row per month from here on, so a window without a partition key stays small.
    in_order = Window.orderBy("month")
    last_three = in_order.rowsBetween(-2, Window.currentRow)
    revenue = F.col("revenue")
    previous, year_ago = F.lag("revenue", 1).over(in_order), F.lag("revenue", 12).over(in_order)
    return months.select(
        "month", "orders", "customers", "revenue",
        ratio(revenue, F.col("n_items"), 2).alias("avg_order"),
        F.col("units").alias("items_sold"),
        previous.alias("prev_month_revenue"),
        year_ago.alias("prev_year_revenue"),
        ratio(revenue - previous, previous, 2, times=100).alias("monthly_growth_pct"),
        ratio(revenue - year_ago, year_ago, 2, times=100).alias("yearly_growth_pct"),
        ratio(F.sum("revenue").over(last_three), F.count("revenue").over(last_three), 2).alias("moving_avg_3m"),
        F.rank().over(Window.orderBy(revenue.desc())).alias("revenue_rank"),
    ).orderBy("month")


def monthly_trend_order_grain(t: Retail, since: DateLike) -> DataFrame:
    """As `monthly_trend`, every order counted once and neighbours taken by calendar month.

    All calendar months from `since` to the last month sold are listed, empty ones with zeros. The twelve
    months before `since` are read as well, so the first year has its year-ago values. The moving average is
    the mean of the months with sales among three calendar months.
    """
    first = month_start(since)
    valid = not_void(in_period(t.orders, "order_ts", shift_months(first, -12)), t, VOID)
    per_order = _with_items(valid, t)
    sold = (
        per_order.groupBy("month", "customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("revenue"), F.sum("units").alias("units"))
        .groupBy("month")
        .agg(
            F.sum("orders").alias("orders"),
            F.count("customer_id").alias("customers"),
            F.sum("revenue").cast(DecimalType(28, 2)).alias("revenue"),
            F.sum("units").alias("units"),
        )
    )
    # The first month asked for is listed even if nothing was sold; each month then fills the gap behind it.
    anchor = sold.sparkSession.range(1).select(
        date_lit(first).alias("month"),
        *[F.lit(None).cast(sold.schema[c].dataType).alias(c) for c in ("orders", "customers", "revenue", "units")],
    )
    months = sold.unionByName(anchor).groupBy("month").agg(
        *[F.max(c).alias(c) for c in ("orders", "customers", "revenue", "units")]
    )
    following = F.add_months(F.lead("month").over(Window.orderBy("month")), -1)
    gapless = months.withColumn("following", F.coalesce(following, F.col("month"))).select(
        F.explode(F.expr("sequence(month, following, interval 1 month)")).alias("listed"), "*"
    )
    real = F.col("listed") == F.col("month")
    spine = gapless.select(
        F.col("listed").alias("month"),
        *[F.when(real, F.col(c)).alias(c) for c in ("orders", "customers", "revenue", "units")],
    )
    in_order = Window.orderBy("month")
    last_three = in_order.rowsBetween(-2, Window.currentRow)
    revenue = F.col("revenue")
    shown = zero_if_null(revenue)
    previous, year_ago = F.lag("revenue", 1).over(in_order), F.lag("revenue", 12).over(in_order)
    looked_up = spine.select(
        "month",
        zero_if_null(F.col("orders")).alias("orders"),
        zero_if_null(F.col("customers")).alias("customers"),
        shown.alias("revenue"),
        zero_if_null(ratio(revenue, F.col("orders"), 2)).alias("avg_order"),
        zero_if_null(F.col("units")).alias("items_sold"),
        previous.alias("prev_month_revenue"),
        year_ago.alias("prev_year_revenue"),
        ratio(shown - previous, previous, 2, times=100).alias("monthly_growth_pct"),
        ratio(shown - year_ago, year_ago, 2, times=100).alias("yearly_growth_pct"),
        ratio(F.sum("revenue").over(last_three), F.count("revenue").over(last_three), 2).alias("moving_avg_3m"),
    )
    return (
        looked_up.filter(F.col("month") >= date_lit(first))
        .withColumn("revenue_rank", F.rank().over(Window.orderBy(revenue.desc())))
        .orderBy("month")
    )


def payment_performance(t: Retail) -> DataFrame:
    """Orders, value, states, delay and main region per active payment method, from one pass over the orders."""
    named = t.order_status.select("status_id", F.col("name").alias("status"))
    status, paid = F.col("status"), F.col("payment_ts").isNotNull()
    by_region = (
        with_place(t.orders.join(named, "status_id"), t, "left")
        .groupBy("method_id", "region")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("total").alias("value"),
            count_when(status == CONFIRMED).alias("confirmed"),
            count_when(status == AWAITING).alias("awaiting"),
            count_when(status == CANCELLED).alias("cancelled"),
            count_when(paid).alias("paid"),
            sum_when(paid, seconds_between(F.col("order_ts"), F.col("payment_ts"))).alias("wait"),
        )
    )
    totals = by_region.groupBy("method_id").agg(
        *[F.sum(c).alias(c) for c in ("orders", "value", "confirmed", "awaiting", "cancelled", "paid", "wait")],
        most_frequent("orders", "region").alias("main_region"),
    )
    return (
        t.payment_methods.filter("active")
        .select("method_id", F.col("name").alias("payment_method"), "max_instalments", "fee_pct")
        .join(totals, "method_id", "left")
        .orderBy(F.col("value").desc_nulls_last(), "method_id")
        .select(
            "payment_method", "max_instalments", "fee_pct",
            zero_if_null(F.col("orders")).alias("orders"),
            zero_if_null(F.col("value")).alias("total_value"),
            zero_if_null(ratio(F.col("value"), F.col("orders"), 2)).alias("avg_order"),
            zero_if_null(F.col("confirmed")).alias("confirmed"),
            zero_if_null(F.col("awaiting")).alias("awaiting"),
            zero_if_null(F.col("cancelled")).alias("cancelled"),
            ratio(F.col("wait"), F.col("paid") * 3600, 2).alias("hours_to_payment"),
            "main_region",
            ratio(F.col("confirmed"), F.col("orders"), 2, times=100).alias("success_pct"),
            ratio(F.col("cancelled"), F.col("orders"), 2, times=100).alias("cancel_pct"),
        )
    )


def _cohorts(t: Retail, since: DateLike) -> DataFrame:
    return t.customers.filter(F.col("created_at") >= instant(since)).select(
        "customer_id", month_of(F.col("created_at")).alias("cohort_month")
    )


def _cohort_activity(t: Retail, since: DateLike) -> DataFrame:
    """One row per customer and month offset: orders and value. Offsets are negative before registration."""
    joined = t.orders.select("customer_id", "total", month_of(F.col("order_ts")).alias("month")).join(
        _cohorts(t, since), "customer_id"
    )
    return joined.groupBy(
        "customer_id", "cohort_month", months_apart(F.col("month"), F.col("cohort_month")).alias("month_offset")
    ).agg(F.count(F.lit(1)).alias("orders"), F.sum("total").alias("value"))


def cohort_retention(t: Retail, since: DateLike) -> DataFrame:
    """Customers by month of registration: who bought in months 0 to 3, retention, value.

    Silent customers count as registered only, so they are taken from the customers alone. Each customer is
    reduced to one row before the cohort is summed; the distinct counts of the report become plain ones.
    """
    offset = F.col("month_offset")
    per_customer = (
        _cohort_activity(t, since)
        .groupBy("customer_id", "cohort_month")
        .agg(
            *[F.max((offset == n).cast("int")).alias(f"active_{n}") for n in range(4)],
            F.max(offset.between(0, 3).cast("int")).alias("active_any"),
            F.sum("orders").alias("orders"),
            F.sum("value").alias("value"),
        )
    )
    activity = per_customer.groupBy("cohort_month").agg(
        *[F.sum(f"active_{n}").alias(f"active_{n}") for n in range(4)],
        F.sum("active_any").alias("active_any"),
        F.sum("orders").alias("orders"),
        F.sum("value").cast(DecimalType(30, 2)).alias("value"),
    )
    registered = _cohorts(t, since).groupBy("cohort_month").agg(F.count(F.lit(1)).alias("registered"))
    active = [zero_if_null(F.col(f"active_{n}")) for n in range(4)]
    return (
        registered.join(activity, "cohort_month", "left")
        .select(
            "cohort_month", "registered",
            *[active[n].alias(f"bought_month_{n}") for n in range(4)],
            ratio(active[0], F.col("registered"), 2, times=100).alias("conversion_month_0"),
            *[ratio(active[n], active[0], 2, times=100).alias(f"retention_month_{n}") for n in range(1, 4)],
            F.col("value").alias("cohort_value"),
            ratio(F.col("value"), F.col("orders"), 2).alias("avg_order"),
            zero_if_null(F.col("orders")).alias("orders"),
            ratio(F.col("value"), F.col("active_any"), 2).alias("ltv_3m"),
        )
        .orderBy("cohort_month")
    )


def cohort_matrix(t: Retail, since: DateLike, n_months: int = 6) -> DataFrame:
    """Buyers per cohort and month offset 0..n_months, one column per offset; NULL where nobody bought.

    A cohort without any order up to the last offset has no row.
    """
    activity = _cohort_activity(t, since).filter(F.col("month_offset") <= n_months)
    # The activity holds one row per customer and offset, so counting rows counts customers.
    pivoted = (
        activity.groupBy("cohort_month")
        .pivot("month_offset", list(range(n_months + 1)))
        .agg(F.count(F.lit(1)))
    )
    named = [F.col(f"`{n}`").alias(f"m{n}") for n in range(n_months + 1)]
    return pivoted.select("cohort_month", *named).orderBy("cohort_month")


def stockout_forecast(t: Retail, as_of: DateLike) -> DataFrame:
    """Active products at or below twice their minimum stock, most urgent first.

    Sales and carts are read for these products alone: if they are few, they are broadcast to both.
    """
    end = day_after(as_of)
    short = t.products.filter(F.col("active") & (F.col("stock") <= F.col("stock_min") * 2)).select("product_id")
    short = broadcast_counted(short)
    keys = order_keys(t)
    recent = in_period(t.orders, "order_ts", days_before(as_of, 90), end).select(*keys, "order_ts")
    in_30, in_7 = F.col("day") >= date_lit(days_before(as_of, 30)), F.col("day") >= date_lit(days_before(as_of, 7))
    sales = (
        t.order_items.select(*keys, "product_id", "qty")
        .join(short, "product_id", "left_semi")
        .join(recent, keys)
        .groupBy("product_id", F.col("order_ts").cast("date").alias("day"))
        .agg(F.sum("qty").alias("qty"))
        .groupBy("product_id")
        .agg(
            sum_when(in_30, F.col("qty")).alias("s30"),
            sum_when(in_7, F.col("qty")).alias("s7"),
            F.sum("qty").alias("s90"),
            count_when(in_30).alias("days"),
        )
    )
    carts = t.carts.join(short, "product_id", "left_semi").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_carts"), F.sum("qty").alias("in_carts")
    )
    stock, floor = F.col("stock"), F.col("stock_min")
    s30, s7 = F.col("s30"), F.col("s7")
    selling = zero_if_null(s30) > 0
    critical = selling & (stock * 30 <= s30 * 7)
    urgency = F.when(stock == 0, 0).when(critical, 1).when(stock <= floor, 2).otherwise(3)
    low = (
        t.products.filter(F.col("active") & (stock <= floor * 2))
        .select("product_id", "sku", "name", "category_id", "price", "stock", "stock_min")
        .join(category_names(t), "category_id")
        .join(sales, "product_id", "left")
        .join(carts, "product_id", "left")
    )
    days_exact = stock * 30 / F.nullif(s30, F.lit(0))
    return low.orderBy(urgency, F.coalesce(days_exact, F.lit(9999)), "product_id").select(
        "product_id", "sku", "name", "category", "price", "stock", "stock_min",
        zero_if_null(s30).alias("sold_30d"),
        zero_if_null(s7).alias("sold_7d"),
        zero_if_null(F.col("s90")).alias("sold_90d"),
        zero_if_null(ratio(s30, F.col("days"), 2)).alias("avg_per_sale_day"),
        F.when(selling, ratio(stock * 30, s30, 1)).alias("days_left"),
        zero_if_null(F.col("n_carts")).alias("cart_lines"),
        zero_if_null(F.col("in_carts")).alias("cart_units"),
        (stock - zero_if_null(F.col("in_carts"))).alias("effective_stock"),
        F.when(stock == 0, "RUPTURE")
        .when(critical, "CRITICAL")
        .when(stock <= floor, "LOW")
        .when(stock <= floor * 2, "ATTENTION")
        .otherwise("NORMAL")
        .alias("stock_status"),
        F.when(selling, ratio(s7 * 30 - s30 * 7, s30 * 7, 1, times=100))
        .otherwise(F.lit(0).cast(DecimalType(18, 1)))
        .alias("trend_pct"),
    )


def executive_dashboard(t: Retail, as_of: DateLike) -> DataFrame:
    """One row of key figures for the month of `as_of`, up to and including that day.

    The row is returned even if nothing was sold in the month; the top category is then NULL.
    """
    end, this_month, last_month = day_after(as_of), month_start(as_of), shift_months(as_of, -1)
    ts, start = F.col("order_ts"), instant(this_month)
    current, previous = ts >= start, (ts >= instant(last_month)) & (ts < start)
    named = t.order_status.select("status_id", F.col("name").alias("status"))
    status = F.col("status")
    to_date = in_period(t.orders, "order_ts", end=end)
    sales = to_date.join(named, "status_id", "left").agg(
        count_when(current).alias("orders"),
        sum_when(current, F.col("total")).alias("revenue"),
        # NULL outside the month: one distinct count, and no second copy of every order.
        F.countDistinct(F.when(current, F.col("customer_id"))).alias("buyers"),
        count_when(previous).alias("orders_before"),
        sum_when(previous, F.col("total")).alias("revenue_before"),
        count_when(status == AWAITING).alias("awaiting"),
        count_when(status.isin(*MOVING)).alias("moving"),
        count_when((status == DELIVERED) & current).alias("delivered"),
    )
    created = F.col("created_at")
    people = t.customers.agg(
        count_when((created >= start) & (created < instant(end))).alias("new_customers"),
        count_when(F.col("active")).alias("active_customers"),
    )
    active, stock = F.col("active"), F.col("stock")
    goods = t.products.agg(
        count_when(active).alias("active_products"),
        count_when(active & (stock <= F.col("stock_min"))).alias("low_products"),
        count_when(active & (stock == 0)).alias("out_products"),
        sum_when(active, stock * F.col("price")).alias("stock_value"),
    )
    prices = t.products.select("product_id", final_price(F.col("price"), F.col("promo_price")).alias("final"))
    owner = F.coalesce(F.col("customer_id").cast("string"), F.col("session_id"))
    carts = (
        t.carts.groupBy("product_id", owner.alias("owner"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("qty").alias("units"))
        .join(prices, "product_id", "left")
        .agg(
            zero_if_null(F.sum("n")).alias("cart_lines"),
            F.countDistinct("owner").alias("distinct_carts"),
            F.sum(F.col("units") * F.col("final")).alias("cart_value"),
        )
    )
    top = (
        in_period(t.orders, "order_ts", this_month, end)
        .select(*order_keys(t))
        .join(t.order_items.select(*order_keys(t), "product_id", "subtotal"), order_keys(t))
        .groupBy("product_id")
        .agg(F.sum("subtotal").alias("value"))
        .join(t.products.select("product_id", "category_id"), "product_id")
        .join(category_names(t), "category_id")
        .groupBy("category")
        .agg(F.sum("value").alias("top_value"))
        .orderBy(F.col("top_value").desc(), "category")
        .limit(1)
    )
    # All five sides are one row by construction (the last may be empty).
    row = sales.crossJoin(people).crossJoin(goods).crossJoin(carts).join(top, F.lit(True), "left")
    return row.select(
        F.col("orders").alias("orders_month"),
        F.col("orders_before").alias("orders_prev_month"),
        ratio(F.col("orders") - F.col("orders_before"), F.col("orders_before"), 1, times=100).alias("orders_change_pct"),
        F.col("revenue").alias("revenue_month"),
        F.col("revenue_before").alias("revenue_prev_month"),
        ratio(F.col("revenue") - F.col("revenue_before"), F.col("revenue_before"), 1, times=100).alias(
            "revenue_change_pct"
        ),
        ratio(F.col("revenue"), F.col("orders"), 2).alias("avg_order_month"),
        "new_customers",
        F.col("buyers").alias("active_buyers_month"),
        "active_customers",
        ratio(F.col("buyers"), F.col("active_customers"), 1, times=100).alias("activation_pct"),
        "active_products", F.col("low_products").alias("low_stock_products"),
        F.col("out_products").alias("out_of_stock_products"), "stock_value",
        "cart_lines", "distinct_carts", "cart_value",
        F.col("category").alias("top_category"), F.col("top_value").alias("top_category_revenue"),
        F.col("awaiting").alias("awaiting_payment"), F.col("moving").alias("in_transport"),
        F.col("delivered").alias("delivered_month"),
    )


def dashboard_long(t: Retail, as_of: DateLike) -> DataFrame:
    """The dashboard as (position, metric, value) rows, values as text."""
    wide = executive_dashboard(t, as_of)
    entries = ", ".join(f"{n}, '{c}', cast(`{c}` as string)" for n, c in enumerate(wide.columns, 1))
    return wide.selectExpr(f"stack({len(wide.columns)}, {entries}) as (position, metric, value)")
