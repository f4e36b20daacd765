import random
import re

from tests.helpers import rows
from tillspan.functions.text import trigrams
from tillspan.operators.matching import name_matches
from tillspan.plans import joins
from tillspan.plans.inspect import final_plan


def grams(name):
    words = "".join(c if c.isalnum() else " " for c in name.lower()).split()
    return {f"  {w} "[i:i + 3] for w in words for i in range(len(w) + 1)}


def test_trigrams(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("Ação-cat",), ("",), ("  x",)], "name string").select(trigrams(F.col("name")).alias("g"))
    assert [set(r["g"]) for r in df.collect()] == [grams("acao cat"), set(), grams("x")]


def test_equals_all_pairs(spark):
    draw = random.Random(1)
    words = ["star", "stars", "wars", "war", "hero", "heroes", "figure", "figurine", "a", "box"]
    left = [" ".join(draw.sample(words, draw.randrange(1, 4))) for _ in range(60)]
    right = [" ".join(draw.sample(words, draw.randrange(1, 4))) for _ in range(60)] + [None, "--"]
    frames = [spark.createDataFrame([(n,) for n in names], "name string") for names in (left, right)]
    for least in (0.2, 0.3, 0.5, 0.75, 1.0):
        want = {}
        for a in set(left):
            for b in {b for b in right if b and grams(b)}:
                share = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
                if share >= least:
                    want[(a, b)] = share
        found = name_matches(*frames, least).collect()
        assert len(found) == len(want)
        assert {(r["left_name"], r["right_name"]): r["similarity"] for r in found} == want


def test_repeated_names_are_compared_once(spark):
    df = spark.createDataFrame([("same name",)] * 500, "name string")
    assert rows(name_matches(df, df, 0.3)) == [("same name", "same name", 1.0)]


def test_numbered_names_stay_apart(spark):
    # Every trigram of a number is common; single ones would bring most names together.
    names = [f"Customer#{k:09d}" for k in range(3000)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = name_matches(df, df, 0.9)
    sets = {}
    for name in names:
        sets.setdefault(frozenset(grams(name)), []).append(name)
    want = {(a, b) for one in sets for other in sets if one == other or (
        abs(len(one) - len(other)) < 2 and len(one & other) / len(one | other) >= 0.9
    ) for a in sets[one] for b in sets[other]}
    assert {(r["left_name"], r["right_name"]) for r in found.collect()} == want
    # Keys are made behind the last estimate the planner has; neither side may go to the driver.
    assert "SortMergeJoin [count" in found._jdf.queryExecution().executedPlan().toString()


def test_names_are_never_broadcast(spark, tmp_path, monkeypatch):
    # A file of names is small; with their trigrams they are many times that.
    names = [f"Customer#{k:09d}" for k in range(300)] + ["Same name", "same-name", "--", "", None]
    spark.createDataFrame([(n,) for n in names], "name string").write.parquet(f"{tmp_path}/names")
    df, none = spark.read.parquet(f"{tmp_path}/names"), spark.createDataFrame([], "name string")
    for least in (0.9, 0.4):
        found = {}
        for most in (joins.MAX_BROADCAST_ROWS, 0):
            monkeypatch.setattr(joins.checked, "__defaults__", (most,))
            matches = name_matches(df, df, least)
            plan = matches._jdf.queryExecution().executedPlan().toString() + final_plan(matches)
            broadcast = re.findall(r"BroadcastExchange[^\n]*\n(?:[^\n]*\n){0,6}?[^\n]*FileScan parquet \[(.*?)\]", plan)
            # Only trigrams that were counted, and few of them.
            assert bool(broadcast) == (most > 0) == ("BroadcastExchange" in plan)
            assert all(re.sub(r"#\d+L?", "", columns) == "gram,freq" for columns in broadcast)
            assert "BuildLeft" not in plan
            found[most] = rows(matches)
        assert found[0] == found[joins.MAX_BROADCAST_ROWS] and ("Same name", "same-name", 1.0) in found[0]
        assert not name_matches(none, df, least).collect() and not name_matches(none, none, least).collect()
