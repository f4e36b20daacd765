"""Pieces several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspan.sources.tables import MONTH, Retail


def add_place(df: DataFrame, t: Retail, how: str = "inner") -> DataFrame:
    """Add city, state and region to rows that carry a city_id; each small table is joined, and sized, by itself."""
    cities = t.cities.select("city_id", F.col("name").alias("city"), "state_id")
    states = t.states.select("state_id", F.col("code").alias("state"), "region")
    return df.join(cities, "city_id", how).join(states, "state_id", how).drop("state_id")


def with_place(df: DataFrame, t: Retail, how: str = "inner") -> DataFrame:
    """As `add_place`, for rows that carry an address_id."""
    addresses = t.addresses.select("address_id", "city_id")
    return add_place(df.join(addresses, "address_id", how), t, how)


def order_keys(t: Retail) -> list[str]:
    """The columns that join items with their orders.

    Where both are stored by month the month is one of them. It is the same on both sides, and a period asked of the
    orders then limits the folders of the items that are read, too.
    """
    by_month = MONTH in t.orders.columns and MONTH in t.order_items.columns
    return ["order_id", MONTH] if by_month else ["order_id"]


def category_names(t: Retail) -> DataFrame:
    return t.categories.select("category_id", F.col("name").alias("category"))


def status_ids(t: Retail, *names: str) -> DataFrame:
    return t.order_status.filter(F.col("name").isin(*names)).select("status_id")


def not_void(orders: DataFrame, t: Retail, void: tuple[str, ...]) -> DataFrame:
    """Orders outside the given states; an order without a known state is dropped, as by an inner join."""
    kept = t.order_status.filter(~F.col("name").isin(*void)).select("status_id")
    return orders.join(kept, "status_id", "left_semi")


def most_frequent(count: str, name: str) -> Column:
    """Aggregate: the name with the highest count, ties to the lowest name; names that are NULL do not take part.

    A plain aggregate over (key, name) counts, so it combines map-side where a window would sort whole keys.
    """
    pair = F.struct((-F.col(count)).alias("n"), F.col(name).alias("name"))
    return F.min(F.when(F.col(name).isNotNull(), pair))["name"]


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))
