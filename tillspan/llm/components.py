"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspan.llm.common import Scratch

# Links that one task of a round handles. Rounds leave ever fewer links; tasks without rows would only take time to begin.
LINKS_PER_TASK = 20_000


def _tasks(links: int) -> int:
    return max(1, -(-links // LINKS_PER_TASK))


def components(links: DataFrame, scratch: Scratch, at_most: int | None = None) -> DataFrame:
    """(node, root) of every node of `links` (a, b): nodes have the same root if links join them.

    Every round hangs each node on its first neighbour and goes on with the links between what is left, so only
    minima are gathered and a node with very many links is combined before the shuffle. The order is drawn anew by a
    hash in every round; then few rounds are needed, for long chains too. Each round is cut by a written table, and has
    tasks for the number of links that are left, no more than the session's shuffles have. `at_most`: a number of links
    that is known not to be exceeded.
    """
    links = links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = scratch.save(links if at_most is None else links.coalesce(_tasks(at_most)))
    steps: list[DataFrame] = []
    most = rest = links.count()
    while rest:
        both = links.union(links.select("b", "a"))
        turn = F.lit(len(steps))
        place = lambda c: F.struct(F.xxhash64(c, turn).alias("turn"), F.col(c).alias("node"))
        step = both.groupBy("a").agg(F.min(place("b")).alias("first"))
        step = scratch.save(step.select(F.col("a").alias("node"), F.least(place("a"), "first")["node"].alias("to")).coalesce(_tasks(rest)))
        steps.append(step)
        left = step.withColumnsRenamed({"node": "a", "to": "a_to"})
        right = step.withColumnsRenamed({"node": "b", "to": "b_to"})
        links = links.join(left, "a").join(right, "b").where(F.col("a_to") != F.col("b_to"))
        links = links.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct()
        links = scratch.save(links.coalesce(_tasks(rest)))
        rest = links.count()
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # A node may hang on one that hangs on another in the same round: follow until nothing moves.
    parents = steps[0]
    for step in steps[1:]:
        # Later steps speak of nodes that had been their own root; theirs is the better word.
        later = step.withColumnsRenamed({"to": "later"})
        parents = parents.join(later, "node", "left").select("node", F.coalesce("later", "to").alias("to"))
    parents = scratch.save(parents.coalesce(_tasks(most)))
    while True:
        up = parents.select(F.col("node").alias("to"), F.col("to").alias("up"))
        moved = parents.join(up, "to", "left").select("node", F.coalesce("up", "to").alias("to"), (F.col("up") != F.col("to")).alias("moved"))
        moved = scratch.save(moved.coalesce(_tasks(most)))
        parents = moved.select("node", "to")
        if moved.where("moved").isEmpty():
            return parents.withColumnRenamed("to", "root")


def with_links(roots: DataFrame, links: DataFrame, scratch: Scratch, at_most: int | None = None) -> DataFrame:
    """(node, root) of the components `roots` (node, root) and the nodes of `links` (a, b) make together.

    Only links between different components take part in the rounds, as links between their roots.
    """
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = between.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    found = components(between, scratch, at_most)
    moved = roots.join(found.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left")
    moved = moved.select("node", F.coalesce("up", "root").alias("root"))
    return scratch.save(moved.union(found.join(roots, "node", "left_anti").select("node", "root")))
