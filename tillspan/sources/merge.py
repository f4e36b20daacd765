"""Updates of stored tables: the folders that hold an updated row are written anew, all others stay as they are."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspan.sources.schemas import KEYED_LAYOUT
from tillspan.sources.tables import MONTH, PART, part_of, replace_folders, stored_schema

# The last batch a folder was written by; the readers of the tables don't ask for this column.
BATCH = "_batch"


def apply_updates(
    spark: SparkSession,
    directory: str,
    name: str,
    updates: DataFrame,
    keys: Sequence[str],
    changes: Callable[[Column], dict[str, Column]],
    batch: str,
) -> None:
    """Change the rows of a stored table whose keys are in `updates`, one row per key.

    `changes` gets the row of updates as a struct and returns the new values of columns, which may refer to the stored
    ones. Keys compare null-safely; keys that no row has are ignored. A folder takes the place of its old version when
    it is complete, and remembers the batch: if a job dies between two folders and runs again with the same batch, or
    if a batch is sent twice, finished folders are left alone and no delta counts twice. Batches have to come one after
    the other.

    A key that occurs twice among the updates is refused, as its rows would be.
    """
    if not updates.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"several updates of one key of {name}")
    folder = PART if name in KEYED_LAYOUT else MONTH
    schema = stored_schema(name).add(BATCH, "string")
    stored = spark.read.schema(schema).parquet(f"{directory}/{name}").filter(~F.col(BATCH).eqNullSafe(batch))
    update = updates.select(F.struct(*updates.columns).alias("_u"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_u.{k}")) for k in keys])
    if folder == PART and list(keys) == [KEYED_LAYOUT[name]]:
        touched = updates.select(part_of(F.col(keys[0])).alias(PART))  # told by the key alone
    elif folder in updates.columns:
        touched = updates.select(folder)
    else:
        touched = stored.select(folder, *keys).join(update, same, "left_semi").select(folder)
    # One row per folder.
    touched = F.broadcast(touched.distinct().withColumnRenamed(folder, "_touched"))
    rows = stored.join(touched, F.col(folder).eqNullSafe(F.col("_touched")), "left_semi").join(update, same, "left")
    new = changes(F.col("_u"))
    unknown = set(new) - set(stored.columns)
    if unknown:
        raise KeyError(f"{name} has no columns {sorted(unknown)}")
    found = F.col("_u").isNotNull()
    columns = [F.when(found, new[c]).otherwise(F.col(c)).cast(schema[c].dataType).alias(c) if c in new else F.col(c) for c in stored.columns if c != BATCH]
    replace_folders(rows.select(*columns, F.lit(batch).alias(BATCH)), directory, name)
