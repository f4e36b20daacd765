"""Operator 2: which documents share so many word n-grams that their Jaccard similarity reaches a threshold.

Equal sets are one class from the start. A class puts the rarest part of its set, so long that two similar sets must
share something in it, into an inverted index with the positions. How rare a shingle is comes from a sketch of the
counts of all shingles of all documents; the result is exact whatever the sketch says, it only orders the sets.

Set relations spare work:
* Index lists are cut into blocks by set size. An entry of size n at position i can only have partners of at most
  (n - i) * (1 + t) / t - n shingles, so blocks behind that are skipped, as are pairs whose positions leave too little.
* Parity sketches of the sets, 1024 bits each, bound from below what two sets differ in; pairs that differ in too much
  are settled by them, without their sets.
* Every list is first compared with its first entry and with neighbours only. These answers, kept as the differences to
  the first entry, say whether two members of a list are similar without their sets: the common part of x and y is
  |L| - |Lx union Ly| + |xL intersect yL|, with Lx what L has and x has not, and xL the opposite. While lists of
  near copies still hold many more pairs of different components than all lists have entries, pairs drawn from them are
  compared and components put together, until few of those drawn fit by size, position and parity. Then only lists that still hold more than one component are joined in full, without pairs that are
  linked already.

Links are found between classes; groups of copies are never expanded into pairs.

Defined results: NULL and texts without words are empty sets and linked with nothing; fewer words than n are one
shingle; rows that repeat an id are documents of their own with that id; equal texts have equal rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillspan.llm.common import Scratch, give_back, map_batches, worker_state
from tillspan.llm.components import components, with_links

# Defaults of the arguments `n` and `percent`: words of a shingle, and the threshold in hundredths.
N = 4
PERCENT = 85
# Counters of the sketch, as a power of two, and the parts it is merged in. A shingle of many documents is told apart
# where they are more than all shingles share a counter.
SKETCH_BITS = 24
SLICES = 64
# Bits of a class's parity sketch.
PARITY_BITS = 1024
# Rows a worker handles at a time.
ROWS = 1000
# Sets, and rows of list entries or pairs, that one task writes where their number is known.
SETS_PER_TASK = 1000
PAIRS_PER_TASK = 20_000
# Pairs are drawn while lists hold so many open pairs for each entry, as long as those drawn let expect more than so many
# rows for each entry in the join, and from lists where neighbours have put together this share of the entries, so many
# for each entry and turn; a turn that leaves more than the last share is the last.
OPEN_PAIRS = 10
EXPECTED_ROWS = 0.1
OFTEN = 0.1
DRAWN = 2
LEAST_GAIN = 0.9
# So many ids may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

_U = np.uint64
_random = np.random.default_rng(20240229)
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE, _PLACE = 0x9E3779B97F4A7C15 | 1, _random.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables = [_powers(_BASE, 1 << 15), _powers(_INVERSE, 1 << 15)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def shingle_set(text: str | None, n: int = N) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    space = np.concatenate(([True], _SPACE[raw], [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    if len(raw) >= len(_tables[0]):
        _tables[:] = _powers(_BASE, 2 * len(raw)), _powers(_INVERSE, 2 * len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * _tables[0][: len(raw)])))
    words = _mixed((sums[ends] - sums[starts]) * _tables[1][starts] + (ends - starts).astype(np.uint64))
    length = min(n, len(words))
    count = len(words) - length + 1
    made = np.full(count, length, np.uint64)
    for k in range(length):
        made = made + words[k : k + count] * _PLACE[k]
    return np.unique(_mixed(made))


def _small_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: sets of a whole batch would need memory for all its texts at once."""
    worker_state("ngrams", None, lambda: None)  # what an operator before has left in this worker goes
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            yield batch.slice(k, ROWS)
    give_back()  # the worker may have nothing to do in the stages to come


def _texts(batch: pa.RecordBatch, place: int) -> Iterator[str | None]:
    return (t.as_py() for t in batch.column(place))


def sketch_levels(documents: DataFrame, n: int = N, bits: int = SKETCH_BITS) -> np.ndarray:
    """For every bucket of shingle hashes how often its shingles occur in all documents, as a power of two.

    Fixed in size. Tasks count for themselves, up to 255 a counter, and send compressed slices of their counters;
    these are added up in two steps so that no group grows with the number of tasks alone. The driver gets levels.
    """
    width = (1 << bits) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in _small_batches(batches):
            for text in _texts(batch, 0):
                np.add.at(counts, (shingle_set(text, n) >> _U(64 - bits)).astype(np.int64), np.uint32(1))
        if counts.any():
            salt = int(counts.sum(dtype=np.int64)) % 64
            np.minimum(counts, 255, out=counts)
            for k in range(SLICES):
                part = counts[k * width : (k + 1) * width]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([salt], pa.int32()), pa.array([_packed(part, np.uint8)], pa.binary())],
                    ["slice", "salt", "counts"],
                )

    def total(table: pa.Table, kind: type) -> np.ndarray:
        return sum((_unpacked(part.as_py(), kind) for part in table.column("counts")), np.zeros(width, np.uint32))

    def add(table: pa.Table) -> pa.Table:
        made = [_packed(total(table, np.uint8), np.uint32)]
        return pa.table({"slice": table["slice"][:1], "salt": table["salt"][:1], "counts": pa.array(made, pa.binary())})

    def level(table: pa.Table) -> pa.Table:
        made = [_packed(np.log2(total(table, np.uint32) + 1.0), np.uint8)]
        return pa.table({"slice": table["slice"][:1], "salt": table["salt"][:1], "counts": pa.array(made, pa.binary())})

    schema = "slice int, salt int, counts binary"
    parts = map_batches(documents.select("text"), count, schema)
    parts = parts.groupBy("slice", "salt").applyInArrow(add, schema).groupBy("slice").applyInArrow(level, schema)
    levels = np.zeros(1 << bits, np.uint8)
    for row in parts.select("slice", "counts").collect():  # SLICES rows, one byte a counter
        levels[row["slice"] * width : (row["slice"] + 1) * width] = _unpacked(row["counts"], np.uint8)
    return levels


def _packed(counts: np.ndarray, kind: type) -> bytes:
    return zstandard.compress(counts.astype(kind).tobytes(), 1)


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _class_key(found: np.ndarray) -> bytes:
    """128 bits of a set."""
    halves = [_mixed(found + _U(salt)).sum(dtype=np.uint64) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return np.array([halves[0] + _U(len(found)), halves[1]], ">u8").tobytes()


def _parities(found: np.ndarray) -> np.ndarray:
    """For each of PARITY_BITS buckets whether an odd number of shingles falls into it, packed.

    Every bit in which two sets differ stands for at least one shingle that only one of them has.
    """
    places = (_mixed(found ^ _U(0x2545F4914F6CDD1D)) % _U(PARITY_BITS)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=PARITY_BITS).astype(np.uint8) & 1).view(np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def indexed(documents: DataFrame, levels: np.ndarray, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, number of shingles, key of the set and its rarest shingles, those that have to be in the index."""
    known = documents.sparkSession.sparkContext.broadcast(levels)  # one byte per counter of the sketch
    shift = _U(65 - len(levels).bit_length())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small_batches(batches):
            sizes, keys, prefixes, parities = [], [], [], []
            for text in _texts(batch, 1):
                found = shingle_set(text, n)
                size = len(found)
                order = np.lexsort((found, known.value[(found >> shift).astype(np.int64)]))
                sizes.append(size)
                keys.append(_class_key(found) if size else None)
                parities.append(_parities(found))
                prefixes.append(found[order[: size - (percent * size + 99) // 100 + 1]] if size else found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(prefixes), _lists(parities)],
                ["doc_id", "n_shingles", "key", "prefix", "parity"],
            )

    id_type = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(
        documents.select("doc_id", "text"), work, f"doc_id {id_type}, n_shingles long, key binary, prefix array<long>, parity array<long>"
    )


def class_sets(documents: DataFrame, wanted: DataFrame, n: int = N) -> DataFrame:
    """(cls, shingles) of the wanted classes, read from the one document of each that `wanted` (cls, key, doc_id) names."""
    ids = wanted.select(F.col("doc_id")).distinct()
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    ids = F.broadcast(ids) if few else ids
    # Ids may be NULL, too.
    plain = documents.select(F.col("doc_id").alias("_id"), "text")
    asked = plain.join(ids, F.col("_id").eqNullSafe(F.col("doc_id")), "left_semi").select("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small_batches(batches):
            found = [s for s in (shingle_set(t, n) for t in _texts(batch, 0)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_class_key(s) for s in found], pa.binary()), _lists(found)], ["key", "shingles"]
            )

    sets = map_batches(asked, work, "key binary, shingles array<long>")
    # An id may stand for several documents; whatever is not wanted goes here.
    return sets.join(wanted.select("key", "cls"), "key").select("cls", "shingles").dropDuplicates(["cls"])


def _reaches(size_a: Column, size_b: Column, common: Column, percent: int) -> Column:
    """100 * intersection >= percent * union."""
    return common * (100 + percent) >= F.lit(percent) * (size_a + size_b)


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two index entries of one list can belong to similar sets, from their sizes and positions."""
    most = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return _reaches(F.col(f"{a}.n"), F.col(f"{b}.n"), most, percent)


def _pairs(joined: DataFrame, *added: str) -> DataFrame:
    """Distinct pairs of classes with their sizes, smaller class first, and sums of the columns `added`."""
    swap = F.col("x.cls") < F.col("y.cls")
    pick = lambda name, first: F.when(swap == F.lit(first), F.col(f"x.{name}")).otherwise(F.col(f"y.{name}"))
    pairs = joined.select(
        pick("cls", True).alias("a"), pick("n", True).alias("a_n"), pick("cls", False).alias("b"), pick("n", False).alias("b_n"), *added
    )
    return pairs.groupBy("a", "a_n", "b", "b_n").agg(*[F.sum(c).alias(c) for c in added]) if added else pairs.distinct()


def _not_apart(pairs: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """Pairs without those whose parity sketches already differ in more places than similar sets may."""
    parity = entries.select("cls", "parity")
    both = pairs.join(parity.withColumnsRenamed({"cls": "a", "parity": "a_parity"}), "a")
    both = both.join(parity.withColumnsRenamed({"cls": "b", "parity": "b_parity"}), "b")
    near = _parities_fit(F.col("a_parity"), F.col("b_parity"), F.col("a_n") + F.col("b_n"), percent)
    return both.where(near).select(*pairs.columns)


def _parities_fit(a: Column, b: Column, sizes: Column, percent: int) -> Column:
    """Whether parity sketches of sets with these sizes together differ in no more places than similar sets may."""
    differing = sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(PARITY_BITS // 64)), F.lit(0))
    return differing * (100 + percent) <= sizes * (100 - percent)


def _with_differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with what only a has and what only b has."""
    left = sets.withColumnsRenamed({"cls": "a", "shingles": "a_set"})
    right = sets.withColumnsRenamed({"cls": "b", "shingles": "b_set"})
    return pairs.join(left, "a").join(right, "b").select(
        "a", "a_n", "b", "b_n", F.array_except("a_set", "b_set").alias("only_a"), F.array_except("b_set", "a_set").alias("only_b")
    )


def _open_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(token, cls, n, pos, root) of the lists that hold several components."""
    labelled = lists.select("token", "y.cls", "y.n", "y.pos").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "cls"))
    mixed = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return labelled.join(mixed.select("token"), "token", "left_semi")


def _crowded(open_lists: DataFrame, band: Callable[[Column], Column]) -> DataFrame:
    """(token, open): parts of like size whose entries often are similar, and their pairs of different components."""
    of_root = open_lists.groupBy("token", band(F.col("n")).alias("band"), "root").agg(F.count(F.lit(1)).cast("double").alias("size"))
    of_list = of_root.groupBy("token", "band").agg(
        F.sum("size").alias("all"), F.sum(F.col("size") * F.col("size")).alias("within"), F.count(F.lit(1)).alias("roots")
    )
    together = F.col("all") - F.col("roots") >= F.col("all") * OFTEN
    return of_list.where(together & (F.col("roots") > 1)).select("token", ((F.col("all") * F.col("all") - F.col("within")) / 2).alias("open"))


def _drawn(open_lists: DataFrame, turn: int, band: Callable[[Column], Column]) -> DataFrame:
    """(x, y, stands_for): a few pairs of every entry of a list with others of like size but another component.

    Every list and turn has an order of its own, and every other turn the sizes are parted elsewhere. `stands_for`: the
    pairs of the entries of like size for each one drawn; summed over those that fit, what a join of them would make.
    """
    entry = F.struct("cls", "n", "pos", "root")
    like = band(F.col("n") * (1 + turn % 2 * 0.08)).alias("like")
    order = Window.partitionBy("token", "like").orderBy(F.xxhash64("cls", "token", F.lit(turn)))
    others = F.array(*[F.lag(entry, k).over(order) for k in range(1, DRAWN + 1)])
    many = F.count(F.lit(1)).over(Window.partitionBy("token", "like"))
    drawn = open_lists.withColumn("like", like).select(entry.alias("y"), others.alias("others"), ((many - 1) / (2 * DRAWN)).alias("stands_for"))
    return drawn.select("y", F.explode("others").alias("x"), "stands_for").where(F.col("x.root") != F.col("y.root"))


def similar_classes(documents: DataFrame, entries: DataFrame, scratch: Scratch, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(node, root) of the classes that have links: the components they make.

    `entries`: cls, key, n, doc_id, prefix and parity of every class.
    """
    postings = entries.select("cls", "n", F.posexplode("prefix").alias("pos", "token"))
    entry = F.struct("cls", "n", "pos")
    by_size = Window.partitionBy("token").orderBy("n", "cls")
    # A list of one entry has no pairs; all others are kept.
    lists = postings.select(
        "token",
        entry.alias("y"),
        F.first(entry).over(by_size).alias("first"),
        F.lag(entry).over(by_size).alias("before"),
        F.lead("cls").over(by_size).alias("after"),
    )
    lists = scratch.save(lists.where("before IS NOT NULL OR after IS NOT NULL").drop("after"))
    entered = lists.count()

    def save(rows: DataFrame, at_most: int, a_task: int = PAIRS_PER_TASK) -> DataFrame:
        """A table of a known number of rows at most, in no more tasks than these need."""
        return scratch.save(rows.coalesce(max(1, -(-at_most // a_task))))

    # First every list against its first entry and each entry against the one before.
    near = lists.where("before IS NOT NULL").select("y", F.explode(F.array("first", "before")).alias("x"))
    near = near.where(_possible("x", "y", percent))
    pairs = save(_not_apart(_pairs(near), entries, percent), 2 * entered)
    names = entries.select("cls", "key", "doc_id")
    members = lambda p: p.select(F.col("a").alias("cls")).union(p.select(F.col("b").alias("cls"))).distinct()
    band = lambda size: F.floor(F.log(size) / F.lit(log(100 / percent)) + 1e-9)

    def compared_by_sets(asked: DataFrame, at_most: int) -> DataFrame:
        """The pairs with their differences."""
        sets = save(class_sets(documents, names.join(members(asked), "cls", "left_semi"), n), 2 * at_most, SETS_PER_TASK)
        return _with_differences(asked, sets)

    def similar(compared: DataFrame) -> DataFrame:
        common = F.col("a_n") - F.size("only_a")
        return compared.where(_reaches(F.col("a_n"), F.col("b_n"), common, percent)).select("a", "b")

    count = pairs.count()
    compared = save(compared_by_sets(pairs, count), count, SETS_PER_TASK)
    roots = components(similar(compared), scratch, count)
    open_lists = save(_open_lists(lists, roots), entered)
    # A group of near copies may still be in many components: draw other pairs while the join in full would be large.
    known, turn, before = pairs.select("a", "b"), 0, float("inf")
    while True:
        crowded = save(_crowded(open_lists, band), entered)
        work = crowded.agg(F.sum("open")).first()[0] or 0.0
        if work <= OPEN_PAIRS * entered or work > before * LEAST_GAIN:
            break
        turn, before = turn + 1, work
        near = _drawn(open_lists.join(crowded.select("token"), "token", "left_semi"), turn, band).where(_possible("x", "y", percent))
        drawn = _not_apart(_pairs(near, "stands_for").join(known, ["a", "b"], "left_anti"), entries, percent)
        drawn = save(drawn, DRAWN * entered)
        count, expected = drawn.agg(F.count("a"), F.sum("stands_for")).first()
        if (expected or 0.0) <= EXPECTED_ROWS * entered:
            break  # the other open pairs don't fit either; the join finds that out by itself
        drawn = drawn.drop("stands_for")
        roots = with_links(roots, similar(compared_by_sets(drawn, count)), scratch, count)
        known = known.union(drawn.select("a", "b"))
        open_lists = save(_open_lists(lists, roots), entered)

    # Lists that still hold several components, in blocks of similar sizes; blocks out of reach are skipped.
    reach = (F.col("n") - F.col("pos")) * (100 + percent) / percent - F.col("n")
    blocks = F.sequence(band(F.col("n")), F.greatest(band(F.greatest(reach, F.lit(1))), band(F.col("n"))))
    # Entries carry their parity sketch, so that pairs of different sets that share a passage don't leave the join.
    open_lists = open_lists.join(entries.select("cls", "parity"), "cls")
    entry = F.struct("cls", "n", "pos", "root", "parity")
    x = open_lists.where(reach >= F.col("n")).select("token", entry.alias("x"), F.explode(blocks).alias("block"))
    y = open_lists.select("token", entry.alias("y"), band(F.col("n")).alias("block"))
    ordered = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.cls") < F.col("y.cls")))
    fit = _parities_fit(F.col("x.parity"), F.col("y.parity"), F.col("x.n") + F.col("y.n"), percent)
    rest = x.join(y, ["token", "block"]).where(ordered & (F.col("x.root") != F.col("y.root")) & _possible("x", "y", percent) & fit)
    rest = scratch.save(_pairs(rest).join(known, ["a", "b"], "left_anti"))

    # Answers that follow from the differences to a set both have been compared with.
    seen = compared.select(F.col("a").alias("lead"), F.col("a_n").alias("lead_n"), F.col("b").alias("cls"), F.col("only_a").alias("lost"), F.col("only_b").alias("gained"))
    back = compared.select(F.col("b").alias("lead"), F.col("b_n").alias("lead_n"), F.col("a").alias("cls"), F.col("only_b").alias("lost"), F.col("only_a").alias("gained"))
    asked = members(rest)
    seen = seen.union(back).join(asked, "cls", "left_semi")
    xs = seen.withColumnsRenamed({"cls": "a", "lost": "a_lost", "gained": "a_gained"})
    ys = seen.withColumnsRenamed({"cls": "b", "lost": "b_lost", "gained": "b_gained"}).drop("lead_n")
    shared = F.col("lead_n") - F.size(F.array_union("a_lost", "b_lost")) + F.size(F.array_intersect("a_gained", "b_gained"))
    derived = rest.join(xs, "a").join(ys, ["b", "lead"]).select("a", "a_n", "b", "b_n", shared.alias("common"))
    count = rest.count()
    derived = save(derived.groupBy("a", "a_n", "b", "b_n").agg(F.max("common").alias("common")), count)
    open_pairs = rest.join(derived.select("a", "b"), ["a", "b"], "left_anti")
    derived = derived.where(_reaches(F.col("a_n"), F.col("b_n"), F.col("common"), percent)).select("a", "b")
    return with_links(roots, derived.union(similar(compared_by_sets(open_pairs, count))), scratch, count)


def near_duplicates(documents: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `documents` (doc_id, text)."""
    documents = documents.select("doc_id", "text")
    scratch = Scratch(documents.sparkSession, "ngram-join")
    rows = indexed(documents, sketch_levels(documents, n), n, percent)
    classes = rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.first("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"), F.first("prefix").alias("prefix"), F.first("parity").alias("parity")
    )
    # Short ids for classes; they hold because the table is written.
    classes = scratch.save(classes.withColumn("cls", F.monotonically_increasing_id()))
    roots = similar_classes(documents, classes, scratch, n, percent)
    labelled = classes.select("cls", "key", "doc_id").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    labelled = labelled.select("key", "doc_id", F.coalesce("root", "cls").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(smallest, "root").select("key", "component_id")
    return rows.select("doc_id", "n_shingles", "key").join(named, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(documents: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """`documents` with one of each group of near duplicates, the one with the smallest id; all columns.

    Documents without words are copies of nothing and stay. Rows that repeat an id are one document: one of them stays,
    and none if one of them belongs to a group with a smaller id. Rows without id stay.
    """
    found = near_duplicates(documents, n, percent)
    scratch = Scratch(documents.sparkSession, "one-of-each")
    gone = scratch.save(found.where(F.col("doc_id") > F.col("component_id")).select("doc_id").distinct())
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    kept = documents.join(gone, "doc_id", "left_anti").select(*documents.columns)
    if documents.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id IS NULL"))
