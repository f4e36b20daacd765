"""Operator 11: importance resampling towards a target distribution, over hashed word n-grams.

The texts of a batch are joined with a separator no word contains, and one pass of a regular expression finds all
words. Where a word stands, searched among the offsets of the documents, tells its document; an n-gram whose first and
last word belong to different documents is masked out. Bucket numbers of all n-grams are then counted by one bincount:
per task for the two distributions, per document for the weights. Counts of a task are one row per bucket in use, and
add up before and after the shuffle.

Documents are drawn without replacement, by the largest of weight plus Gumbel noise that depends on seed and id alone.
Ranks come from one distributed sort in ranges.

Defined results: NULL and texts without words have no features and weight 0; a document without id has the noise of an
empty id and comes behind equal scores; documents that repeat an id are drawn one by one, in any order if their scores
agree; empty tables count nothing, and every bucket's gain then follows from the other table alone; extra columns are
left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspan.plans.ordered import in_ranges, numbered

BUCKETS = 10_000
SHORTEST, LONGEST = 1, 1
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
# Words in the bytes of a lower-cased text: every byte beyond ASCII belongs to a word.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\n"
# Texts of a batch are joined up to so many bytes; a longer one stands alone.
TOGETHER = 8_000_000


class Features:
    """Buckets of the n-grams of joined texts."""

    def __init__(self, shortest: int = SHORTEST, longest: int = LONGEST, buckets: int = BUCKETS):
        self.shortest, self.longest, self.buckets = shortest, longest, buckets
        self.known: dict[bytes, int] = {}

    def _bucket(self, gram: bytes) -> int:
        bucket = self.known.get(gram)
        if bucket is None:
            bucket = crc32(gram) % self.buckets
            if len(gram) <= 32:
                if len(self.known) >= 500_000:
                    self.known.clear()
                self.known[gram] = bucket
        return bucket

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, bucket) of every n-gram, and the number of words of every document."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + len(SEPARATOR)
        ends = np.cumsum(lengths)
        starts, words = [], []
        for match in WORD.finditer(SEPARATOR.join(texts).lower()):
            starts.append(match.start())
            words.append(match[0])
        document = np.searchsorted(ends, np.array(starts, np.int64), "right")
        owners, found = [], []
        for n in range(self.shortest, self.longest + 1):
            if len(words) < n:
                break
            first = document[: len(words) - n + 1]
            inside = first == document[n - 1 :]
            if n == 1:
                grams = words
            else:
                grams = [b" ".join(words[k : k + n]) for k in np.flatnonzero(inside).tolist()]
            found.append(np.fromiter(map(self._bucket, grams), np.int64, len(grams)))
            owners.append(first[inside])
        empty = np.zeros(0, np.int64)
        n_words = np.bincount(document, minlength=len(texts))
        return np.concatenate([empty, *owners]), np.concatenate([empty, *found]), n_words


def _groups(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a batch as bytes, in groups to be joined."""
    group, size = [], 0
    for text in column.cast(pa.binary()).to_pylist():
        text = text or b""
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def bucket_counts(df: DataFrame, features: Callable[[], Features] = Features, text: str = "text") -> DataFrame:
    """(bucket, n) of all n-grams of a table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = features()
        counts = np.zeros(find.buckets, np.int64)
        for batch in batches:
            for group in _groups(batch.column(0)):
                counts += np.bincount(find(group)[1], minlength=find.buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    return df.select(text).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, features: Callable[[], Features] = Features, text: str = "text") -> np.ndarray:
    """Thousandths of the log ratio of target to source share of every bucket, each bucket counted once more.

    The counts of all buckets, a fixed number, come to the driver.
    """
    size = features().buckets
    both = bucket_counts(source, features, text).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        bucket_counts(target, features, text).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    s, t = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for row in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"], row["t"]
    ratio = ((t + 1) * float(s.sum() + size)) / ((s + 1) * float(t.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(df: DataFrame, gain: np.ndarray, features: Callable[[], Features] = Features, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row; weight is the sum of the gains of its n-grams."""
    known = df.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = features()
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], []]
            for group in _groups(batch.column(1)):
                owner, bucket, n_words = find(group)
                # Whole numbers: doubles add them exactly.
                weight = np.bincount(owner, known.value[bucket].astype(np.float64), len(group))
                for column, made in zip(columns, (n_words, np.bincount(owner, minlength=len(group)), weight), strict=True):
                    column.append(made.astype(np.int64))
            made = [pa.array(np.concatenate([np.zeros(0, np.int64), *column])) for column in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], [id, "n_words", "n_features", "weight"])

    kind = df.schema[id].dataType.simpleString()
    return df.select(id, text).mapInArrow(work, f"`{id}` {kind}, n_words long, n_features long, weight long")


def noise(id: Column, seed: str = SEED) -> Column:
    """Thousandths of Gumbel noise that depends on seed and id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    documents: DataFrame,
    target: DataFrame,
    features: Callable[[], Features] = Features,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank is NULL where it isn't drawn."""
    weighed = weigh(documents, gains(documents, target, features, text), features, id, text)
    scored = weighed.select(
        id, "n_features", "weight", (F.col("weight") + noise(F.col(id), seed)).alias("score"), (F.col("n_words") >= least_words).alias("_long")
    )
    # Documents that can't be drawn come last, so the others are numbered from 1.
    ordered = in_ranges(scored, [F.desc("_long"), F.desc("score"), F.col(id).asc_nulls_last()], "resampling")
    drawn = ordered.agg(F.floor(F.count_if("_long") * percent / 100).alias("_drawn"))
    result = numbered(ordered, "_number").crossJoin(F.broadcast(drawn))  # one row
    rank = F.when(F.col("_long") & (F.col("_number") <= F.col("_drawn")), F.col("_number"))
    return result.select(id, "n_features", "weight", "score", rank.alias("rank"))
