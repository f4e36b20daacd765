"""Operator 7: allow and block rules for URLs, found through a blocked Bloom filter and an exact join.

A rule lists a canonical address: a host and the beginning of a path. It holds for the host and all its
subdomains. Every URL is turned into the addresses that could list it: each suffix of its host, with the
beginnings of its path that are as long as some listed path. A blocked Bloom filter of the rules drops nearly all
of them; what passes is joined with the rules themselves, so that false positives go. Only DataFrame functions.

Defined results: a URL that is NULL or has no `://` has an empty host and path and no rule; an empty host fits no
rule; equal URLs get equal rows; without rules every URL gets the default verdict. Of several fitting rules the
longest (host and path together) wins, then the one with the longer host, then `block`. Duplicate rules count once,
and rules whose host or path is NULL are no rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspan.llm.common import LOWER, UPPER

# Blocks of 64 bits. The filter is this large for any list; a longer list only lets more false positives through.
BLOCKS = 4096
PROBES = 3


def host_of(url: Column) -> Column:
    after = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.length(after) + 4, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.contains(url, F.lit("://")), host).otherwise("")


def path_of(url: Column) -> Column:
    after = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.length(after) + 4, F.length(url))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), path).otherwise("")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """The bits of an address inside its block, from a hash that is independent of the block's number."""
    mask = F.lit(0).cast("long")
    for probe in range(PROBES):
        bit = F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(64)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def rule_keys(rules: DataFrame) -> DataFrame:
    """One row per listed address: `block` and `allow` for the same address count as `block`."""
    return (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
        .groupBy(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"))
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("address", F.concat("rule_host", "rule_path"))
    )


def bloom_blocks(keys: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The filter: at most `blocks` rows of a block number and its bits."""
    return keys.groupBy(_block(F.col("address"), blocks).alias("block")).agg(
        F.bit_or(_mask(F.col("address"))).alias("bits")
    )


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow", blocks: int = BLOCKS) -> DataFrame:
    """Host, path, winning rule and verdict of every row of `pages` (page_id, url).

    `rules` has host (lower case), path (as it begins, with its slash) and verdict (allow or block).
    """
    parsed = pages.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    listed = rule_keys(rules)
    # Lengths of listed paths, one row with at most as many numbers as the longest listed path has characters.
    lengths = listed.agg(F.collect_set(F.length("rule_path")).alias("lengths")).first()["lengths"]
    places = parsed.where(F.col("host") != "").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    beginnings = F.array(*[F.lit(int(n)) for n in sorted(lengths)]) if lengths else F.array().cast("array<int>")
    fitting = F.filter(beginnings, lambda n: n <= F.length("path"))
    probes = (
        places.select("host", "path", F.explode(suffixes).alias("rule_host"), fitting.alias("lengths"))
        .select("host", "path", "rule_host", F.explode("lengths").alias("length"))
        .withColumn("rule_path", F.expr("substring(path, 1, length)"))
        .withColumn("address", F.concat("rule_host", "rule_path"))
        .withColumn("block", _block(F.col("address"), blocks))
        .withColumn("mask", _mask(F.col("address")))
    )
    # The filter is bounded by the number of blocks, so it can always be broadcast.
    possible = (
        probes.join(F.broadcast(bloom_blocks(listed, blocks)), "block")
        .where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        .select("host", "path", "rule_host", "rule_path")
    )
    exact = possible.join(listed.drop("address"), ["rule_host", "rule_path"])
    rank = F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("long"),
        F.length("rule_host").alias("host_long"),
        F.col("rule_verdict").alias("verdict"),
        F.concat("rule_host", "rule_path").alias("rule"),
    )
    winner = exact.groupBy("host", "path").agg(F.max(rank).alias("won"))
    return (
        parsed.join(winner, ["host", "path"], "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("won.rule").alias("rule"),
            F.coalesce("won.verdict", F.lit(default)).alias("verdict"),
        )
    )
