"""Operator 1: the language of a text is the one whose dictionary compresses it best.

Learning: per language a bounded sample of labelled texts becomes raw-content zstandard dictionaries. Prediction: the
text, reduced to its letters, is compressed in blocks against every dictionary; the language with the smallest sum
wins. Blocks keep a long text from becoming its own dictionary. Several dictionaries per language are read for short
texts, where a single byte decides. A prediction whose lead over the second language is narrow is marked as rejected.

Defined results: NULL or a text without a letter is `und` with score 0 and rejected; of equal sums the language that is
first by name wins (score 1/number of languages or more, rejected); without any labelled text everything is `und`.
Equal texts get equal rows. Labels, sources and ids are no inputs of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillspan.llm.common import map_batches, worker_state

# The bound of the sample: texts per language and characters of each. A language's dictionaries stay below
# SAMPLE_TEXTS * SAMPLE_CHARS characters, whatever the size of the corpus.
SAMPLE_TEXTS = 256
SAMPLE_CHARS = 600
# Dictionaries per language; a long text needs but one.
SHARDS = 8
BLOCK = 2048
# Texts up to so many bytes are read with all dictionaries.
SHORT = 512
# Bytes saved per dictionary and 100 bytes of text that a lead has to exceed to be trusted.
MARGIN = 0.15
LEVEL = 6

_NO_LETTERS = re.compile(r"[\W\d_]+")

Model = dict[str, list[bytes]]


def letters(text: str) -> str:
    """The words of a text in lower case, with one space around each."""
    return f" {_NO_LETTERS.sub(' ', text).strip().lower()} "


def learn(labelled: DataFrame) -> Model:
    """Dictionaries by language from a bounded sample of (text, lang).

    The sample takes the distinct texts with the smallest hashes, so it does not depend on order, partitions or ids.
    The first filter leaves a few times the sample; only that is ranked.
    """
    usable = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    usable = usable.withColumn("hash", F.xxhash64("text"))
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("hash").alias("texts"))
    share = F.least(F.lit(1.0), F.lit(4.0 * SAMPLE_TEXTS) / F.col("texts"))
    spread = F.pmod(F.col("hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = usable.join(F.broadcast(sizes), "lang").where(spread <= share)  # one row per language
    cut = F.substring("text", 1, 4 * SAMPLE_CHARS)
    few = few.select("lang", "hash", spread.alias("spread"), cut.alias("text")).dropDuplicates(["lang", "hash"])
    order = Window.partitionBy("lang").orderBy("spread", "hash")
    sample = few.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_TEXTS)
    parts: dict[str, list[list[str]]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["place"])):
        text = letters(row["text"])[:SAMPLE_CHARS]
        if text.strip():
            shards = parts.setdefault(row["lang"], [[] for _ in range(SHARDS)])
            shards[row["place"] % SHARDS].append(text)
    return {lang: [" ".join(shard).encode() for shard in shards if shard] for lang, shards in parts.items()}


class Classifier:
    def __init__(self, model: Model):
        self.langs = sorted(model)
        self.coders = []
        for lang in self.langs:
            coders = []
            for content in model[lang]:
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(level=LEVEL)
                options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
                coders.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=known, **options))
            self.coders.append(coders)

    def sizes(self, data: bytes) -> list[float]:
        """Compressed bytes by language, per dictionary."""
        blocks = [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]
        found = []
        for coders in self.coders:
            used = coders if len(data) <= SHORT else coders[:2]
            found.append(sum(len(c.compress(b)) for c in used for b in blocks) / len(used))
        return found

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the lead is too narrow to be trusted."""
        words = letters(text or "")
        # Signs like superscripts and fractions count as word characters, but are no letters.
        if not self.langs or not any(map(str.isalpha, words)):
            return "und", 0.0, True
        data = words.encode()
        sizes = self.sizes(data)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        # A byte less is eight bits of evidence; dictionaries are alike, so evidence counts a quarter of that.
        weights = [2.0 ** max(-60.0, -2.0 * (size - sizes[best])) for size in sizes]
        lead = min((size - sizes[best] for k, size in enumerate(sizes) if k != best), default=float(len(data)))
        return self.langs[best], 1.0 / sum(weights), lead <= MARGIN * len(data) / 100


def predict(documents: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """The given columns of every row (by default doc_id), `lang_pred`, `score` and `rejected`."""
    columns = ["doc_id"] if columns is None else columns
    # At most languages * SAMPLE_TEXTS * SAMPLE_CHARS characters.
    known = documents.sparkSession.sparkContext.broadcast(model)
    asked = documents.select(*columns, F.col("text").alias("_asked"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = worker_state("language", known.value, lambda: Classifier(known.value))
        for batch in batches:
            found = [classifier.predict(t.as_py()) for t in batch.column(len(columns))]
            langs, scores, rejected = zip(*found, strict=True) if found else ((), (), ())
            made = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], *made], [*columns, "lang_pred", "score", "rejected"]
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields[:-1])
    return map_batches(asked, work, f"{kept}, lang_pred string, score double, rejected boolean".removeprefix(", "))


def keep_known(documents: DataFrame, model: Model) -> DataFrame:
    """`documents` without the rows whose language is not told with a lead; all columns as they are."""
    known = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = worker_state("language", known.value, lambda: Classifier(known.value))
        for batch in batches:
            yield batch.filter(pa.array([not classifier.predict(t.as_py())[2] for t in batch.column(place)], pa.bool_()))

    return map_batches(documents, work, documents.schema)


def held_out(doc_id):
    """Every third document, by the checksum of its id."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1
