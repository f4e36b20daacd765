"""Data-quality jobs: the constraints a file format does not enforce.

Every check returns (rule, violations) rows and, through the `*_rows` functions, the offending rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.sources.constraints import REFERENCES, REQUIRED, RULES, UNIQUE
from tillspan.sources.tables import Retail, literal_rows


def _all_set(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.filter(_all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_unique(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(rule).alias("rule"), "violations"
    )


def orphan_rows(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Child rows whose reference is set but points nowhere."""
    parents = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


def check_references(child: DataFrame, parent: DataFrame, column: str, parent_column: str, rule: str) -> DataFrame:
    """Number of rows that point nowhere. References are counted per value first, which removes hot values."""
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_column).alias(column))
    return values.join(parents, column, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("violations")
    ).select(F.lit(rule).alias("rule"), "violations")


def _broken(condition: str) -> Column:
    return ~F.coalesce(F.expr(condition), F.lit(True))


def _one_pass(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Count all conditions in one scan, then turn the one row into (rule, violations) rows."""
    counted = df.agg(*[F.count_if(test).alias(f"c{n}") for n, test in enumerate(tests.values())])
    entries = [F.struct(F.lit(rule).alias("rule"), F.col(f"c{n}").alias("violations")) for n, rule in enumerate(tests)]
    return counted.select(F.inline(F.array(*entries)))


def check_rules(df: DataFrame, rules: dict[str, str], prefix: str = "") -> DataFrame:
    return _one_pass(df, {prefix + name: _broken(condition) for name, condition in rules.items()})


def broken_rows(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that break a rule, with the names of the rules."""
    names = F.filter(
        F.array(*[F.when(_broken(condition), F.lit(name)) for name, condition in rules.items()]),
        lambda name: name.isNotNull(),
    )
    return df.withColumn("broken", names).filter(F.size("broken") > 0)


def check_required(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    return _one_pass(df, {prefix + c: F.col(c).isNull() for c in columns})


def table_counts(t: Retail, names: Sequence[str]) -> DataFrame:
    return _union([
        getattr(t, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in names
    ])


def all_unique(t: Retail) -> DataFrame:
    """Every declared key; the number of violations is NULL where the shop has no such table."""
    rules = [(name, keys, f"{name}({', '.join(keys)})") for name, key_lists in UNIQUE.items() for keys in key_lists]
    known = [check_unique(getattr(t, name), keys, rule) for name, keys, rule in rules if name in t.names()]
    return _with_unchecked(known, [rule for *_, rule in rules])


def all_references(t: Retail) -> DataFrame:
    """Every reference, all of them in one scan per table; the number of violations is NULL where a table is missing.

    The values of references and the keys they point to go into one table of (key column, value), in which rows of one
    value combine before and after the only shuffle: a value without a key counts for the references that have it.
    """
    rules = [(child, column, f"{parent}.{key}", f"{child}.{column} -> {parent}.{key}") for child, column, parent, key in REFERENCES]
    targets = sorted({target for _, _, target, _ in rules})
    # Rules are numbered within the key they point to.
    numbers = {rule: sum(r[2] == target for r in rules[:n]) for n, (_, _, target, rule) in enumerate(rules)}
    places = max(numbers.values()) + 1
    known = set(t.names())
    parts = []
    for name in sorted(known & ({child for child, *_ in rules} | {target.split(".")[0] for target in targets})):
        entries = [_entry(target, target.split(".")[1], None) for target in targets if target.split(".")[0] == name]
        entries += [_entry(target, column, numbers[rule]) for child, column, target, rule in rules if child == name]
        parts.append(getattr(t, name).select(F.inline(F.array(*entries))).filter("value is not null"))
    values = _union(parts).groupBy("target", "value").agg(
        F.max(F.col("rule").isNull()).alias("known"), *[F.count_if(F.col("rule") == n).alias(f"n{n}") for n in range(places)]
    )
    lost = values.filter("not known").groupBy("target").agg(*[F.sum(f"n{n}").alias(f"n{n}") for n in range(places)])
    checked = [(target, numbers[rule], rule) for child, _, target, rule in rules if {child, target.split(".")[0]} <= known]
    listed = literal_rows(_spark(t), checked, ["target", "number", "rule"])
    count = F.coalesce(F.get(F.array(*[F.col(f"n{n}") for n in range(places)]), F.col("number")), F.lit(0))
    found = listed.join(lost, "target", "left").select("rule", count.cast("bigint").alias("violations"))
    return _with_unchecked([found], [rule for *_, rule in rules])


def _entry(target: str, column: str, rule: int | None) -> Column:
    """A value of a reference, or a key where `rule` is None."""
    return F.struct(
        F.lit(target).alias("target"), F.col(column).cast("string").alias("value"), F.lit(rule).cast("int").alias("rule")
    )


def all_rules(t: Retail) -> DataFrame:
    """Every value rule; the number of violations is NULL where the shop has no such table."""
    known = [check_rules(getattr(t, name), rules, f"{name}.") for name, rules in RULES.items() if name in t.names()]
    return _with_unchecked(known, [f"{name}.{rule}" for name, rules in RULES.items() for rule in rules])


def all_required(t: Retail, also: dict[str, list[str]] | None = None) -> DataFrame:
    """The declared required columns, and those in `also`; NULL violations where the shop has no such table."""
    also = also or {}
    columns = {name: needed + also.get(name, []) for name, needed in REQUIRED.items()}
    known = [check_required(getattr(t, name), needed, f"{name}.") for name, needed in columns.items() if name in t.names()]
    return _with_unchecked(known, [f"{name}.{c}" for name, needed in columns.items() for c in needed])


def _with_unchecked(found: Sequence[DataFrame], rules: Sequence[str]) -> DataFrame:
    """All rules, those that could not be checked with NULL: a complete list shows what is missing."""
    checked = _union(found)
    listed = literal_rows(checked.sparkSession, [(rule,) for rule in rules], ["rule"])
    return listed.join(checked, "rule", "left").select("rule", "violations")


def _spark(t: Retail) -> SparkSession:
    return getattr(t, t.names()[0]).sparkSession


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
