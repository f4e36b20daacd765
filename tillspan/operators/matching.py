"""Similarity join on names by shared trigrams."""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspan.functions.text import trigrams
from tillspan.plans.joins import checked


# Names meet on so many shared trigrams at once, as long as a name doesn't take more than so many keys for that.
MOST_TOGETHER = 6
MOST_KEYS = 8
# Below this similarity a name has too many sets of trigrams to choose from; names then meet on single ones.
TOGETHER_FROM = 0.7


def name_matches(left: DataFrame, right: DataFrame, min_sim: float = 0.3) -> DataFrame:
    """Pairs of distinct names with |shared trigrams| / |all trigrams| >= min_sim.

    Both inputs have a `name` column. Repeated names are compared once; join the result back on the names to
    reach the rows. The answer is exact: a pair at or above the threshold must share some of the rarest trigrams
    of each name (prefix filtering), so only those are joined on, and common trigrams never meet. The larger name
    of a pair tells how many trigrams that are; with several at once a list of names stays short where every single
    trigram is common, as in numbers. Two names meet at the rarest trigrams their prefixes share, so no pair is
    produced twice. How common trigrams are is counted, and written to shared storage, when the plan is made.
    """
    sides = {"l": _names(left), "r": _names(right)}
    exploded = {s: df.select("name", F.explode("grams").alias("gram")) for s, df in sides.items()}
    # Written and counted: few are broadcast to the names, many meet them in a shuffle.
    frequency = checked(
        exploded["l"].unionByName(exploded["r"]).groupBy("gram").agg(F.count(F.lit(1)).alias("freq")), "trigrams"
    )
    needed = lambda n: F.ceil(n * F.lit(min_sim) - 1e-9).cast("int")

    def together(n: Column) -> Column:
        """How many trigrams a name of n, and any smaller one like it, is looked up by at once."""
        if min_sim < TOGETHER_FROM:
            return F.lit(1)
        spare, most = n - needed(n), F.lit(1)
        for count in range(2, MOST_TOGETHER + 1):
            # The largest number of spare trigrams for which that makes no more than MOST_KEYS keys.
            largest = max(d for d in range(MOST_KEYS) if comb(d + count, count) <= MOST_KEYS)
            most = F.when(spare <= largest, F.lit(count)).otherwise(most)
        return F.least(most, needed(n))

    def prefix(grams: str) -> Column:
        n = F.size(grams)
        return F.slice(grams, F.lit(1), F.least(n - needed(n) + F.col("count"), n))

    def keyed(side: str) -> DataFrame:
        # The trigrams of one name: their number is bounded by the length of the name. To the planner a table of names
        # is as small as its file, without their trigrams: it is never to be broadcast.
        ranked = exploded[side].hint("merge").join(frequency, "gram").groupBy("name").agg(
            F.array_sort(F.collect_list(F.struct("freq", "gram"))).alias("ranked")
        )
        n = F.col("n")
        ranked = ranked.select("name", F.transform("ranked", lambda g: g["gram"]).alias("grams"), F.size("ranked").alias("n"))
        # One number for the name itself and each size a larger partner may have.
        sizes = F.sequence(n, F.floor(n / F.lit(min_sim) + 1e-9).cast("int")) if min_sim >= TOGETHER_FROM else F.array(n)
        ways = ranked.withColumn("count", F.explode(F.array_distinct(F.transform(sizes, together))))
        return ways.select(
            F.col("name").alias(f"{side}_name"),
            F.col("grams").alias(f"{side}_grams"),
            "count",
            F.explode(_choices(prefix("grams"), F.col("count"))).alias("key"),
        )

    # Names are small before they have keys, which hides from the planner what a broadcast would collect.
    both = keyed("l").hint("merge").join(keyed("r"), ["count", "key"])
    n_l, n_r = F.size("l_grams"), F.size("r_grams")
    long_enough = (n_r >= n_l * min_sim - 1e-9) & (n_l >= n_r * min_sim - 1e-9)
    first_shared = _key(F.slice(F.array_intersect(prefix("l_grams"), prefix("r_grams")), F.lit(1), F.col("count"))) == F.col("key")
    shared = F.size(F.array_intersect("l_grams", "r_grams"))
    return (
        both.filter(long_enough & (F.col("count") == together(F.greatest(n_l, n_r))) & first_shared)
        .select("l_name", "r_name", _similarity(shared, n_l, n_r).alias("similarity"))
        .filter(F.col("similarity") >= min_sim)
        .withColumnsRenamed({"l_name": "left_name", "r_name": "right_name"})
    )


def _key(grams: Column) -> Column:
    return F.array_join(grams, " | ")


def _choices(prefix: Column, count: Column) -> Column:
    """Every choice of `count` trigrams of a prefix, in its order, as keys."""
    places = F.sequence(F.lit(1), F.size(prefix))
    spare = F.size(prefix) - count
    # Only beginnings that leave enough trigrams for the rest.
    chosen, keys = F.transform(F.filter(places, lambda k: k <= spare + 1), lambda k: F.array(k)), None
    for number in range(1, MOST_TOGETHER + 1):
        made = F.transform(chosen, lambda c: _key(F.transform(c, lambda k: F.get(prefix, k - 1))))
        keys = F.when(count == number, made) if keys is None else keys.when(count == number, made)
        after = lambda c, number=number: F.filter(places, lambda k: (k > F.element_at(c, -1)) & (k <= spare + number + 1))
        chosen = F.flatten(F.transform(chosen, lambda c: F.transform(after(c), lambda k: F.concat(c, F.array(k)))))
    return keys


def _names(df: DataFrame) -> DataFrame:
    return df.filter("name is not null").select("name").distinct().withColumn("grams", trigrams(F.col("name")))


def _similarity(shared: Column, n_left: Column, n_right: Column) -> Column:
    return shared / (n_left + n_right - shared)
