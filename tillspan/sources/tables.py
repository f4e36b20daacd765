"""Reading, writing and analysing retail tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillspan.functions.dates import DateLike, as_date, instant
from tillspan.plans.lineage import run_dir
from tillspan.sources.schemas import FACT_LAYOUT, KEYED_LAYOUT, RETAIL_DDL, schema_of

# Folder column of the fact tables written by `write_table`.
MONTH = "month"
MONTH_FORMAT = "yyyy-MM"
# Folder column of the tables in KEYED_LAYOUT, and the number of their folders: fixed, so that a key keeps its folder.
PART = "part"
PARTS = 64


class Retail:
    """Retail tables by name: `t.orders`, `t.products`. A table is built on first use only."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, **frames: DataFrame) -> Retail:
        return cls({name: (lambda frame=frame: frame) for name, frame in frames.items()})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            if name not in self._builders:
                raise AttributeError(f"no table {name!r}")
            self._built[name] = self._builders[name]()
        return self._built[name]

    def names(self) -> list[str]:
        return list(self._builders)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A few constant rows as part of the plan.

    Spark knows the size of such a table exactly and broadcasts it; rows handed over through
    `createDataFrame` have no known size, and a join with them would shuffle the other side.
    """

    def text(value: object) -> str:
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return "null" if value is None else str(value)

    values = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS rows({', '.join(columns)})")


def literal_table(spark: SparkSession, name: str, rows: Sequence[tuple]) -> DataFrame:
    """Constant rows with the declared types of a table."""
    fields = schema_of(name).fields
    raw = literal_rows(spark, rows, [field.name for field in fields])
    return raw.select(*[F.col(field.name).cast(field.dataType) for field in fields])


def load_tables(spark: SparkSession, directory: str, names: Iterable[str] | None = None) -> Retail:
    """Parquet tables under `directory/<name>`, read with their declared schema (no inference job)."""

    def reader(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(stored_schema(name)).parquet(f"{directory}/{name}").drop(PART)

    return Retail({name: reader(name) for name in (names or RETAIL_DDL)})


def with_month(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order items with the month folder of their order; NULL where the order is unknown."""
    months = orders.select("order_id", F.date_format("order_ts", MONTH_FORMAT).alias(MONTH))
    return items.join(months, "order_id", "left")


def part_of(key: Column) -> Column:
    """The folder of a key in the tables of KEYED_LAYOUT."""
    return F.pmod(F.hash(key), F.lit(PARTS))


def _placed(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Rows with their folder, those of one folder together and sorted, and the folder's column.

    The rows are rebalanced: Spark cuts a month that holds most of the data into files of the advisory partition size
    and puts small months together in one task. The sort keeps row-group statistics selective.
    """
    if name in KEYED_LAYOUT:
        folder, hot_key = PART, KEYED_LAYOUT[name]
        df = df.withColumn(PART, part_of(F.col(hot_key)))
    else:
        folder, (ts, hot_key) = MONTH, FACT_LAYOUT[name]
        if MONTH not in df.columns:
            if ts is None:
                raise ValueError(f"{name} carry no time: add the month of their order by with_month()")
            df = df.withColumn(MONTH, F.date_format(ts, MONTH_FORMAT))
    return df.hint("rebalance", F.col(folder)).sortWithinPartitions(folder, hot_key), folder


def write_table(df: DataFrame, directory: str, name: str, mode: str = "overwrite") -> None:
    """Write one table as Parquet.

    Facts are split by month, so that a date filter skips whole folders; large tables that are updated by key are split
    by a hash of the key, so that an update leaves most folders alone.
    """
    if name not in FACT_LAYOUT and name not in KEYED_LAYOUT:
        df.write.mode(mode).parquet(f"{directory}/{name}")
        return
    placed, folder = _placed(df, name)
    placed.write.mode(mode).partitionBy(folder).parquet(f"{directory}/{name}")


def replace_folders(df: DataFrame, directory: str, name: str) -> None:
    """Replace those months, or folders of keys, that `df` has rows of; the files of all others stay as they are.

    `df` may read the stored table itself. Its rows are written beside it first, and the new folders take the place of
    the old ones only when all of them are complete, so a job that dies on the way changes nothing.
    """
    spark = df.sparkSession
    staged = f"{run_dir(spark, 'folders')}/{name}"
    df.write.parquet(staged)
    placed, folder = _placed(spark.read.schema(df.schema).parquet(staged), name)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(f"{directory}/{name}")


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save a catalogue table in buckets of a join key.

    Two tables saved in the same number of buckets of the same key join, and group by it, without a shuffle.
    Orders and order items by order id are the pair most reports join.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def bucketed_tables(spark: SparkSession, frames: Mapping[str, DataFrame], key: str, buckets: int) -> Retail:
    """The frames saved in buckets of one key, under fresh names and in a fresh folder of shared storage."""
    run = uuid.uuid4().hex
    names = {name: f"{name}_{run}" for name in frames}
    for name, frame in frames.items():
        save_bucketed(frame, names[name], key, buckets, f"{run_dir(spark, 'buckets')}/{name}")
    return catalog_tables(spark, names)


def catalog_tables(spark: SparkSession, names: Mapping[str, str]) -> Retail:
    """Retail tables that live in the catalogue: `{"orders": "shop.orders", ...}`."""
    return Retail({name: (lambda table=table: spark.table(table)) for name, table in names.items()})


def analyze_table(spark: SparkSession, table: str, columns: Iterable[str] | None = None) -> None:
    """Column statistics for a catalogue table, used by Spark's size checks and join choices."""
    target = f"COLUMNS {', '.join(columns)}" if columns else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {target}")


# What DESCRIBE tells of an analysed column, and the type it is read back as.
STATISTICS = {"num_nulls": "bigint", "distinct_count": "bigint", "min": "string", "max": "string"}


def column_statistics(spark: SparkSession, table: str, columns: Iterable[str]) -> DataFrame:
    """(column, num_nulls, distinct_count, min, max) as the planner knows them; NULL where a column isn't analysed.

    The distinct count is Spark's estimate. One row per column asked for: metadata, not data.
    """
    found = []
    for column in columns:
        facts = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
        found.append((column, *[None if facts.get(k) in (None, "NULL") else facts[k] for k in STATISTICS]))
    rows = literal_rows(spark, found, ["column", *STATISTICS])
    return rows.select("column", *[F.col(name).cast(kind).alias(name) for name, kind in STATISTICS.items()])


def in_period(df: DataFrame, ts: str, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Rows with start <= ts < end.

    On a table written by `write_table` the same period also limits the month folders that are read.
    """
    if start is not None:
        df = df.filter(F.col(ts) >= instant(start))
    if end is not None:
        df = df.filter(F.col(ts) < instant(end))
    if MONTH in df.columns:
        if start is not None:
            df = df.filter(F.col(MONTH) >= as_date(start).strftime("%Y-%m"))
        if end is not None:
            df = df.filter(F.col(MONTH) <= as_date(end).strftime("%Y-%m"))
    return df


def stored_schema(name: str) -> StructType:
    """The declared columns of a table and the one of its folders."""
    schema = schema_of(name)
    if name in KEYED_LAYOUT:
        return schema.add(PART, "integer")
    return schema.add(MONTH, "string") if name in FACT_LAYOUT else schema
