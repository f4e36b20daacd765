"""Operator 3: fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: at line ends, at the ends of sentences, and inside a sentence after every PIECE
characters. The digest of a paragraph and of its how-manieth occurrence goes into HASHES cells of a sketch, each with
a count, the XOR of digests and the XOR of checksums. The difference of two sketches holds what only one text has:
cells with a single digest are read and taken out of the others until none is left. If that fails, the two versions
are sketched again with four times the cells and other places, until it works.

A fingerprint is the number of paragraphs and the sketch of CELLS cells; equal texts have equal fingerprints. The
likeness of two is 1 - differing digests / all digests of both.

Defined results: NULL is an empty text; empty texts have no paragraphs and are alike (1.0); rows are ordered by
descending id, NULL ids last, equal ids by the hash of their text; a single row is its own successor.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CELLS = 24
HASHES = 3
PIECE = 160
# Documents one bucket of the ordered pass should hold, and the number of buckets that may be told apart by literals.
BUCKET_ROWS = 20_000
MAX_BUCKETS = 2_000

# The end of a sentence belongs to it; ends without a sentence stand for themselves. White space around is no part.
_PARAGRAPH = re.compile(rf"(?:[^\n.!?]|[.!?](?=[^\s.!?])){{1,{PIECE}}}[.!?]*|[.!?]+")
_U = np.uint64
_MIXES = np.array([[0xBF58476D1CE4E5B9], [0x94D049BB133111EB], [0xD6E8FEB86659FD95]], np.uint64)
_PARTS = np.arange(HASHES)[:, None]


def paragraphs(text: str | None) -> np.ndarray:
    """Digests of a text's paragraphs; repeated ones differ by their number."""
    seen: Counter[str] = Counter()
    out = []
    for part in _PARAGRAPH.findall(text or ""):
        part = part.strip()
        if part:
            seen[part] += 1
            out.append(xxhash.xxh64_intdigest(part if seen[part] == 1 else f"{seen[part]}\n{part}"))
    return np.array(out, np.uint64)


class Sketch:
    def __init__(self, cells: int):
        self.part = max(1, cells // HASHES)
        self.count = np.zeros(self.part * HASHES, np.int64)
        self.keys = np.zeros(self.part * HASHES, np.uint64)
        self.checks = np.zeros(self.part * HASHES, np.uint64)

    def _places(self, digests: np.ndarray) -> np.ndarray:
        """One place in each part of the cells, from 32 bits of its own. One product spreads digests anew for every size."""
        spread = digests * _U((0x9E3779B97F4A7C15 * (2 * self.part + 1)) % 2**64)
        bits = ((spread ^ (spread >> _U(29))) * _MIXES) >> _U(32)
        return ((bits * _U(self.part)) >> _U(32)).astype(np.int64) + self.part * _PARTS

    def add(self, digests: np.ndarray, times: np.ndarray | int = 1) -> Sketch:
        if len(digests):
            places = self._places(digests).ravel()
            np.add.at(self.count, places, np.tile(times, HASHES) if isinstance(times, np.ndarray) else times)
            np.bitwise_xor.at(self.keys, places, np.tile(digests, HASHES))
            np.bitwise_xor.at(self.checks, places, np.tile(_check(digests), HASHES))
        return self

    def minus(self, other: Sketch) -> Sketch:
        out = Sketch(len(self.count))
        out.count = self.count - other.count
        out.keys, out.checks = self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Digests only the first and only the second text has; None if some can't be read."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (self.checks == _check(self.keys)))
            if not len(pure):
                break
            digests, first = np.unique(self.keys[pure], return_index=True)
            signs = self.count[pure][first]
            found.append((digests, signs))
            self.add(digests, -signs)
            if len(found) > len(self.count):
                return None
        if self.count.any() or self.keys.any() or self.checks.any():
            return None
        if not found:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        digests, signs = (np.concatenate(x) for x in zip(*found, strict=True))
        return digests[signs > 0], digests[signs < 0]

    def packed(self) -> bytes:
        return self.count.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes() + self.checks.astype("<u4").tobytes()


def _check(digests: np.ndarray) -> np.ndarray:
    return (digests * _U(0xD6E8FEB86659FD93)) >> _U(32)


class Version:
    """A text's digests, its sketches by size, and its fingerprint."""

    def __init__(self, text: str | None):
        self.digests = paragraphs(text)
        self.sketches: dict[int, Sketch] = {}

    def sketch(self, cells: int) -> Sketch:
        if cells not in self.sketches:
            self.sketches[cells] = Sketch(cells).add(self.digests)
        return self.sketches[cells]

    def fingerprint(self) -> str:
        return f"{len(self.digests)}:{base64.b64encode(self.sketch(CELLS).packed()).decode()}"


def difference(a: Version, b: Version) -> tuple[np.ndarray, np.ndarray, int]:
    """Digests only a and only b has, and the cells it took."""
    cells = CELLS
    while True:
        read = a.sketch(cells).minus(b.sketch(cells)).peel()
        if read is not None:
            return *read, cells
        # No use in sizes that can't hold the difference of the numbers of paragraphs.
        cells = max(4 * cells, abs(len(a.digests) - len(b.digests)))


def likeness(a: Version, b: Version) -> float:
    total = len(a.digests) + len(b.digests)
    if not total:
        return 1.0
    only_a, only_b, _ = difference(a, b)
    return 1.0 - (len(only_a) + len(only_b)) / total


def edit(text: str, following: str) -> str:
    """The last third of a text replaced by the beginning of another."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def in_order(documents: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """`documents` (doc_id, text) in buckets of descending ids: bucket, extra, doc_id, text.

    Each bucket is closed by an extra row, the first one of the next bucket (after the last: of the first), so that
    every row finds its successor behind it. Texts are shuffled once. Bounds come from quantiles of the ids alone.
    """
    documents = documents.select("doc_id", "text")
    numbered = documents.where(F.col("doc_id").isNotNull())
    rows = numbered.count()
    wanted = max(1, -(-rows // bucket_rows), min(rows, 2 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    wanted = min(wanted, MAX_BUCKETS)  # buckets grow beyond that; they are sorted and streamed, never held
    shares = [k / wanted for k in range(1, wanted)]
    bounds = sorted(set(numbered.approxQuantile("doc_id", shares, 0.2 / wanted))) if rows and shares else []
    bucket = F.when(F.col("doc_id").isNull(), len(bounds) + 1)
    if bounds:
        place = F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b < F.col("doc_id")))
        bucket = bucket.otherwise(F.lit(len(bounds)) - place)
    else:
        bucket = bucket.otherwise(0)
    keyed = documents.select(bucket.cast("int").alias("bucket"), "doc_id", F.xxhash64("text").alias("text_key"), "text")
    rank = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), (-F.col("text_key")).alias("turned"), "doc_id", "text_key")
    heads = keyed.groupBy("bucket").agg(F.max(rank).alias("head"))
    # As many rows as buckets.
    around = Window.orderBy("bucket")
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    closing = heads.select(
        "bucket", F.coalesce(F.lead("head").over(around), F.first("head").over(whole)).alias("head")
    ).select("bucket", F.col("head.doc_id").alias("head_id"), F.col("head.text_key").alias("head_key"))
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("text_key") == F.col("head_key"))
    extra = keyed.drop("bucket").join(F.broadcast(closing), same).select("bucket", F.lit(1).alias("extra"), "doc_id", "text_key", "text")
    every = keyed.select("bucket", F.lit(0).alias("extra"), "doc_id", "text_key", "text").union(extra)
    order = ["bucket", "extra", F.col("doc_id").desc_nulls_last(), "text_key"]
    return every.repartition(len(bounds) + 2, "bucket").sortWithinPartitions(*order).select("bucket", "extra", "doc_id", "text")


OUT = "doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(documents: DataFrame) -> DataFrame:
    """Per row of `documents`: fingerprints of the text and of its edited version, and their likeness."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):  # few texts at a time as Python objects
                few = batch.slice(start, 100)
                yield from zip(*(column.to_pylist() for column in few.columns), strict=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, []
        for bucket, extra, doc_id, text in rows(batches):
            text = text or ""
            version = Version(text)
            if held and held[0] == bucket:
                _, last_id, last_text, last = held
                after = edit(last_text, text)
                edited = Version(after)
                done.append(
                    (
                        last_id,
                        len(last_text),
                        hashlib.sha256(after.encode()).hexdigest(),
                        last.fingerprint(),
                        edited.fingerprint(),
                        likeness(last, edited),
                        likeness(last, version),
                    )
                )
            held = None if extra else (bucket, doc_id, text, version)
            if len(done) >= 200:
                yield batch_of(done)
                done = []
        if done:
            yield batch_of(done)

    id_type = documents.schema["doc_id"].dataType
    schema = OUT.format(id=id_type.simpleString())
    arrow = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), arrow, strict=True)], names)

    return in_order(documents).mapInArrow(work, schema)
