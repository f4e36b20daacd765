"""Operator 6: passages of a benchmark in training documents, through a positional index. Only DataFrame functions.

A test window is `WINDOW` consecutive words of an item, or a shorter item as a whole. How often each test word occurs
in all documents is counted first. Then postings (document, position, word) are stored of those words alone that are
the rarest or second rarest of some window: two short lists per window, and no row ever carries a text. The lists are
intersected at their offsets, rarest first; what is left names the documents that may hold a window. Of these few the
postings of all test words are stored, too, and the lists of the other words must meet at their own offsets.

`slack` also finds near passages: all words of a full window, each as often as in the window, in any order among
`WINDOW + slack` consecutive words that begin with one of them and don't hold the window itself. Postings that have the
window's second rarest word nearby are candidates; the other lists are joined in blocks of positions, so that nothing
grows with the square of a word's occurrences.

Defined results: NULL and texts without words have no words and no hits; NULL and empty items have no windows; an item
without id hits, but isn't listed; documents that repeat an id keep their own results, equal rows get equal results;
a place covered by several windows counts once; extra columns of any name are kept by `clean` and ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillspan.llm.common import Scratch, ascii_lower

WINDOW = 10
# Words that may stand between those of a near passage.
SLACK = 2
# What ends a word, in texts whose A-Z are still in upper case: any ASCII but letters and digits. Single characters are
# looked up in a table, which is faster than comparing with ranges.
SEPARATORS = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
# So many windows, at about 300 bytes, may be broadcast; more are joined by shuffling postings.
BROADCAST_WINDOWS = 200_000
# So many keys of documents, of about 40 bytes, may be broadcast.
BROADCAST_KEYS = 500_000


def _split(text: Column) -> Column:
    """Words of a text; the first and the last part may be empty."""
    return F.split(text, SEPARATORS, -1)


def _leads(parts: Column) -> Column:
    return F.when(F.try_element_at(parts, F.lit(1)) == "", 1).otherwise(0)


def word_count(parts: Column) -> Column:
    trails = F.when((F.try_element_at(parts, F.lit(-1)) == "") & (F.size(parts) > 1), 1).otherwise(0)
    return F.size(parts) - _leads(parts) - trails


def document_key(id: Column, text: Column) -> Column:
    """One key for rows of the same id and text; the id may be NULL."""
    return F.concat(F.coalesce(F.concat(F.lit("="), id.cast("string")), F.lit("-")), F.lit(":"), F.xxhash64(text).cast("string"))


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, words) of every window of every item."""
    parts = F.filter(_split(ascii_lower(F.col("text"))), lambda w: w != "")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), parts.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    cut = items.select("item", "words", F.explode(starts).alias("start"))
    return cut.select("item", F.slice("words", F.col("start"), F.lit(window)).alias("words"))


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", document_key(F.col("doc_id"), F.col("text")).alias("key"), "text")


def postings(keyed: DataFrame, words: DataFrame, small: bool) -> DataFrame:
    """(key, pos, word) of the given words in documents (doc_id, key, text); positions count words from 0."""
    spread = _spread(keyed.where(F.col("text").isNotNull()), _split(F.col("text")))
    return spread.join(_small(words, small), "word", "left_semi").select("key", "pos", "word")


def postings_and_counts(keyed: DataFrame, words: DataFrame, small: bool) -> DataFrame:
    """As `postings`, and for every document, also a NULL one, a row (doc_id, key) without word: `pos` is its number of words."""
    parts = F.coalesce(_split(F.col("text")), F.array().cast("array<string>"))
    # One part more than there are stands for the document.
    spread = _spread(keyed, F.array_append(parts, F.lit("")), F.coalesce(word_count(parts), F.lit(0)))
    last = F.col("at") == F.col("n_parts") - 1
    known = spread.join(_small(words.withColumn("known", F.lit(True)), small), "word", "left").where(last | F.col("known"))
    return known.select(
        F.when(last, F.col("doc_id")).alias("doc_id"), "key", F.when(last, F.col("n_words")).otherwise(F.col("pos")).alias("pos"), F.when(~last, F.col("word")).alias("word")
    )


def _spread(keyed: DataFrame, parts: Column, n_words: Column | None = None) -> DataFrame:
    """Every part with its place; a document's array of parts is not on the rows."""
    cut = keyed.select("doc_id", "key", parts.alias("parts"), *([] if n_words is None else [n_words.alias("n_words")]))
    spread = cut.select(
        *[c for c in cut.columns if c != "parts"],
        _leads(F.col("parts")).alias("lead"),
        F.size("parts").alias("n_parts"),
        F.posexplode("parts").alias("at", "word"),
    )
    return spread.withColumn("pos", F.col("at") - F.col("lead")).withColumn("word", ascii_lower(F.col("word")))


def _small(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


@dataclass(frozen=True)
class Spotted:
    """Windows that occur: `exact` and `near` (None without slack) as (key, wid, start); `windows` and `items` by wid."""

    exact: DataFrame
    near: DataFrame | None
    windows: DataFrame
    items: DataFrame
    few: bool
    counts: DataFrame | None  # (doc_id, key, n_words) of every document, if asked for


def spot(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int | None = None, counted: bool = False) -> Spotted:
    """Where windows of the items occur in `documents` (doc_id, text)."""
    scratch = Scratch(documents.sparkSession, "postings")
    cut = scratch.save(test_windows(benchmark, window))
    numbered = cut.select("words").distinct().select(F.monotonically_increasing_id().alias("wid"), "words", F.size("words").alias("length"))
    windows = scratch.save(numbered)  # numbers hold once they are written
    few = windows.count() <= BROADCAST_WINDOWS
    items = cut.join(_small(windows, few), "words").select("wid", "item").distinct()
    keyed = _keyed(documents)
    spread = windows.select("wid", "length", F.posexplode("words").alias("offset", "word"))
    vocabulary = spread.select("word").distinct()
    counts = scratch.save(postings(keyed, vocabulary, few).groupBy("word").agg(F.count(F.lit(1)).alias("times")))
    # The lists of a window from its rarest word on; a window with a word that no document has can't occur.
    ranked = spread.join(_small(counts, few), "word").groupBy("wid", "length").agg(F.array_sort(F.collect_list(F.struct("times", "offset", "word"))).alias("lists"))
    ranked = ranked.where(F.size("lists") == F.col("length")).select("wid", "length", F.posexplode("lists").alias("rank", "list"))
    lists = scratch.save(ranked.select("wid", "length", "rank", "list.offset", "list.word"))
    anchors = lists.where("rank < 2").select("word").distinct()
    index = scratch.save((postings_and_counts if counted else postings)(keyed, anchors, few))
    n_words = index.where("word IS NULL").select("doc_id", "key", F.col("pos").alias("n_words")) if counted else None
    index = index.where("word IS NOT NULL")
    found = scratch.save(_both_rarest(index, lists, few).distinct())  # rows that repeat id and text share a key
    nearby = None
    if slack is not None:
        nearby = scratch.save(_second_nearby(index, lists.where(F.col("length") == window), window + slack, few).distinct())
    candidates = (found if nearby is None else found.select("key").unionByName(nearby.select("key"))).select("key").distinct()
    candidates = scratch.save(candidates)
    whole = scratch.save(postings(keyed.join(_small(candidates, candidates.count() <= BROADCAST_KEYS), "key", "left_semi"), vocabulary, few))
    exact = scratch.save(_others_in_place(found, whole, lists, few))
    near = None if nearby is None else scratch.save(_others_around(nearby, exact, whole, lists, window, slack, few))
    return Spotted(exact, near, windows, items, few, n_words)


def _both_rarest(index: DataFrame, lists: DataFrame, few: bool) -> DataFrame:
    """(key, wid, length, start) where the rarest and the second rarest word of a window stand at their offsets."""

    def starts(rank: int) -> DataFrame:
        of_rank = lists.where(F.col("rank") == rank).select("word", "wid", "length", "offset")
        return index.join(_small(of_rank, few), "word").select("key", "wid", "length", (F.col("pos") - F.col("offset")).alias("start")).where("start >= 0")

    first = starts(0)
    return first.where("length > 1").join(starts(1).drop("length"), ["key", "wid", "start"], "left_semi").unionByName(first.where("length = 1"))


def _others_in_place(found: DataFrame, whole: DataFrame, lists: DataFrame, few: bool) -> DataFrame:
    """(key, wid, start) of those places where all other words stand at their offsets, too."""
    rest = found.join(_small(lists.where("rank > 1").select("wid", "offset", "word"), few), "wid")
    wanted = rest.select("key", "wid", "length", "start", (F.col("start") + F.col("offset")).alias("pos"), "word")
    met = wanted.join(whole, ["key", "pos", "word"], "left_semi").groupBy("key", "wid", "length", "start").agg(F.count(F.lit(1)).alias("met"))
    return met.where("met = length - 2").select("key", "wid", "start").unionByName(found.where("length <= 2").select("key", "wid", "start"))


def _second_nearby(index: DataFrame, lists: DataFrame, span: int, few: bool) -> DataFrame:
    """(key, wid, pos) of rarest words that have the second rarest word of their window less than `span` words away."""
    of_rank = lambda rank: _small(lists.where(F.col("rank") == rank).select("word", "wid"), few)
    block = F.floor(F.col("pos") / span)
    first = index.join(of_rank(0), "word").select("key", "wid", "pos", block.alias("block"))
    around = F.explode(F.array(block - 1, block, block + 1)).alias("block")
    second = index.join(of_rank(1), "word").select("key", "wid", F.col("pos").alias("other"), around)
    close = F.abs(F.col("first.pos") - F.col("second.other")) < span
    same = [F.col(f"first.{c}") == F.col(f"second.{c}") for c in ("key", "wid", "block")]
    return first.alias("first").join(second.alias("second"), [*same, close], "left_semi").select("key", "wid", "pos")


def _others_around(nearby: DataFrame, exact: DataFrame, whole: DataFrame, lists: DataFrame, window: int, slack: int, few: bool) -> DataFrame:
    """(key, wid, start) of the near passages around the given postings."""
    span = window + slack
    needs = lists.groupBy("wid", "word").agg(F.count(F.lit(1)).alias("times"))
    block = F.floor(F.col("pos") / span)
    around = F.explode(F.array(block - 1, block, block + 1)).alias("block")
    wanted = nearby.select("key", "wid", "pos", around).join(_small(needs.select("wid", "word"), few), "wid")
    there = whole.select("key", "word", F.col("pos").alias("at"), F.floor(F.col("pos") / span).alias("block"))
    met = wanted.join(there, ["key", "word", "block"]).where(F.abs(F.col("at") - F.col("pos")) < span)
    # At most 2 * span - 1 positions each.
    met = met.groupBy("key", "wid", "pos").agg(F.collect_set(F.struct("at", "word")).alias("met"))
    needed = needs.groupBy("wid").agg(F.collect_list(F.struct("word", "times")).alias("needed"))
    met = met.join(_small(needed, few), "wid")

    def enough(start: Column) -> Column:
        inside = F.filter("met", lambda m: (m["at"] >= start) & (m["at"] < start + span))
        return F.forall("needed", lambda n: F.size(F.filter(inside, lambda m: m["word"] == n["word"])) >= n["times"])

    begins = F.transform(F.filter("met", lambda m: (m["at"] <= F.col("pos")) & (m["at"] > F.col("pos") - span)), lambda m: m["at"])
    starts = met.select("key", "wid", F.explode(F.filter(begins, enough)).alias("start")).distinct()
    holding = exact.select("key", "wid", F.explode(F.sequence(F.col("start") - slack, F.col("start"))).alias("start"))
    return starts.join(holding, ["key", "wid", "start"], "left_anti")


def _listed(hits: DataFrame, items: DataFrame, few: bool) -> DataFrame:
    """(key, items) with the ids of all items that hit a document."""
    pairs = hits.select("key", "wid").distinct().join(_small(items, few), "wid")
    return pairs.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of `documents` (doc_id, text): words, words inside windows, items found, their digest."""
    documents = documents.select("doc_id", "text")
    found = spot(documents, benchmark, window, counted=True)
    places = found.exact.join(_small(found.windows.select("wid", "length"), found.few), "wid")
    places = places.groupBy("key", "start").agg(F.max("length").alias("length"))
    earlier = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = places.select("key", "start", end.alias("end"), F.max(end).over(earlier).alias("before"))
    new = F.greatest(F.col("end") - F.greatest("start", F.coalesce("before", "start")), F.lit(0))
    n_hit = covered.groupBy("key").agg(F.sum(new).alias("n_hit"))
    named = found.counts.join(n_hit, "key", "left").join(_listed(found.exact, found.items, found.few), "key", "left")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return named.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def near_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """Per row of `documents` (doc_id, text): places where windows are only near, and the items they come from."""
    documents = documents.select("doc_id", "text")
    found = spot(documents, benchmark, window, slack)
    n_near = found.near.groupBy("key").agg(F.count_distinct("start").alias("n_near"))
    base = documents.select("doc_id", document_key(F.col("doc_id"), F.col("text")).alias("key"))
    named = base.join(n_near, "key", "left").join(_listed(found.near, found.items, found.few), "key", "left")
    return named.select(
        "doc_id", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("items", F.array().cast("array<string>")).alias("near_items")
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int | None = None) -> DataFrame:
    """`documents` without those that hold a window, or with `slack` one that is only near; all columns."""
    found = spot(documents.select("doc_id", "text"), benchmark, window, slack)
    bad = found.exact.select("key") if found.near is None else found.exact.select("key").unionByName(found.near.select("key"))
    own = "_bad"
    while own in documents.columns:
        own += "_"
    bad = Scratch(documents.sparkSession, "contaminated").save(bad.select(F.col("key").alias(own)).distinct())
    bad = _small(bad, bad.count() <= BROADCAST_KEYS)
    return documents.join(bad, document_key(documents["doc_id"], documents["text"]) == bad[own], "left_anti")
