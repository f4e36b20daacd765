"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillspan.plans.lineage import run_dir

# Operator, what it has learnt from, and what it has learnt.
_STATE: list[tuple[str, object, object]] = []


def worker_state[T](operator: str, source: object, make: Callable[[], T]) -> T:
    """What a Python worker has learnt for one operator from one source, made if it isn't there.

    Workers serve the tasks of many stages. They keep the state of one operator at a time: whoever comes next makes
    room first, so that the stages of a pipeline don't add up in a worker's memory.
    """
    if not _STATE or _STATE[0][0] != operator or _STATE[0][1] is not source:
        _STATE.clear()
        give_back()
        _STATE.append((operator, source, make()))
    return _STATE[0][2]


def give_back() -> None:
    """What this process has freed goes back to the system, where the C library can do that."""
    gc.collect()
    give_back_freed()


def give_back_freed() -> None:
    """As `give_back` without a search for garbage; quick enough for every batch."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# Rows of a batch that the JVM and a Python worker hand each other.
BATCH_ROWS = 1000


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """`df.mapInArrow` with BATCH_ROWS rows at a time: JVM and worker both hold the texts of a batch several times over.

    After each batch the worker gives back what it has freed; Arrow and the C library would keep several batches' worth.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))

    def giving_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in work(batches):
            yield batch
            give_back_freed()

    return df.mapInArrow(giving_back, schema)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: what is made of a whole batch would need memory for all its texts at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is. `lower` does the same, faster, on plain ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(*columns: Column) -> Column:
    """A key of a row's values that tells NULL from empty; equal rows have equal keys."""
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def ended(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Exactly these columns; whatever else the input carries is gone before names can clash."""
    return df.select(*[c.alias(name) for name, c in columns.items()])


class Scratch:
    """Tables of one run in the folder all executors share; each is written once and read back.

    Unlike a checkpoint a written table is compressed and tells the planner its true size, and estimates don't
    multiply from round to round. The result of a run reads some of them, so they stay until the folder is removed.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = run_dir(spark, name)
        self.count = 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
