"""Groups of rows that hang together through shared values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspan.plans.lineage import cut


def connected(links: DataFrame, row: str, value: str) -> DataFrame:
    """(row, group) for links (row, value): rows that share a value, also through other rows, are one group.

    A group is named by its smallest row. Each round hands every row the smallest name among its values, and then the
    name that this name itself has got, so that names travel twice as far in every round. Minima combine before the
    shuffle, so a value shared by many rows is no hot key.
    """
    links = cut(links.select(row, value).distinct())
    names = cut(links.select(row, F.col(row).alias("group")).distinct())
    while True:
        of_value = links.join(names, row).groupBy(value).agg(F.min("group").alias("group"))
        nearest = links.join(of_value, value).groupBy(row).agg(F.min("group").alias("near"))
        there = nearest.select(F.col(row).alias("near"), F.col("near").alias("far"))
        found = cut(
            names.join(nearest, row)
            .join(there, "near", "left")
            .select(row, F.least("near", F.coalesce("far", "near")).alias("group"), (F.col("group") > F.least("near", F.coalesce("far", "near"))).alias("moved"))
        )
        names = found.drop("moved")
        if found.filter("moved").isEmpty():
            return names
