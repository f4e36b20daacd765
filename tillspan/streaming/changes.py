"""Change log of a keyed table fed by a stream of row versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillspan.operators.jobs import change_log

# The versions of the initial snapshot, before batch 0.
INITIAL = -1
# Column of the stored versions for the feed's order.
VERSION = "_version"
# Batches after which their versions are merged with the last base into a new one.
MERGE_EVERY = 16


class ChangeLog:
    """Keeps a table's versions and its change log in one folder.

    `base=N` of `bases` holds the last version of every key after batch N, the deleted ones too, `batch=N` of `versions`
    the rows batch N changed, of `log` what it logged, and of `late` what it left out. A batch reads the last base and
    the versions after it; every `merge_every` batches these become the next base. A base counts once it is listed
    among the complete ones, so one that was half written is never read, and written anew when its turn comes again.
    A batch overwrites its own folders and reads only what earlier batches left, so a batch that is run again after a
    failure leaves the same files behind.

    A row of the feed is a full row plus `deleted`; `seq`, a whole number, tells the later of two versions, and only
    the last of them counts. A version that comes in a later batch than a newer one is late; at equal numbers the later
    batch counts. Versions of the snapshot come before all others.
    """

    def __init__(
        self, directory: str, schema: StructType, key: str, table_name: str, seq: str = "seq",
        ignore: Sequence[str] = (), merge_every: int = MERGE_EVERY,
    ):
        self.versions, self.log, self.late = f"{directory}/versions", f"{directory}/log", f"{directory}/late"
        self.bases, self.complete = f"{directory}/bases", f"{directory}/complete"
        self.columns = schema.fieldNames()
        self.stored = StructType(list(schema.fields)).add("deleted", "boolean").add(VERSION, "long").add("batch", "long")
        self.key, self.table_name, self.seq, self.ignore = key, table_name, seq, tuple(ignore)
        self.merge_every = merge_every

    def start(self, snapshot: DataFrame) -> None:
        spark = snapshot.sparkSession
        rows = snapshot.select(*self.columns).withColumns({"deleted": F.lit(False), VERSION: F.lit(None).cast("long")})
        rows.withColumn("batch", F.lit(INITIAL).cast("long")).write.mode("overwrite").parquet(f"{self.bases}/base={INITIAL}")
        # No versions yet; from now on the folder can be read.
        rows.limit(0).write.mode("overwrite").parquet(f"{self.versions}/batch={INITIAL}")
        self._list(spark, INITIAL, "overwrite")

    def current(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The table as it stands, or as it stood before a batch."""
        return self._latest(self._stored(spark, before), self._age()).filter("not deleted").select(*self.columns)

    def apply(self, feed: DataFrame, batch_id: int) -> None:
        """Write the versions and the log of one batch; the argument of `foreachBatch`."""
        spark = feed.sparkSession
        feed = feed.withColumn(VERSION, F.col(self.seq).cast("long"))
        newest = self._latest(feed, F.col(VERSION))
        before = self._stored(spark, batch_id).join(newest.select(self.key), self.key, "left_semi")
        before = self._latest(before, self._age())
        known = before.select(self.key, F.col(VERSION).alias("_known"))
        on_time = F.col("_known").isNull() | (F.col(VERSION) >= F.col("_known"))
        judged = newest.join(known, self.key, "left")
        latest = judged.filter(on_time).drop("_known")
        old = before.filter("not deleted").select(*self.columns).join(latest.select(self.key), self.key, "left_semi")
        new = latest.filter("not deleted").select(*self.columns)
        logged = change_log(old, new, self.key, self.table_name, self.ignore)
        logged.write.mode("overwrite").parquet(f"{self.log}/batch={batch_id}")
        judged.filter(~on_time).write.mode("overwrite").parquet(f"{self.late}/batch={batch_id}")
        latest.write.mode("overwrite").parquet(f"{self.versions}/batch={batch_id}")
        if (batch_id + 1) % self.merge_every == 0:
            self.merge(spark, batch_id)

    def merge(self, spark: SparkSession, batch_id: int) -> None:
        """Make the base after a batch from the last one and the versions since then."""
        merged = self._latest(self._stored(spark, batch_id + 1), self._age())
        merged = merged.withColumn("batch", F.lit(batch_id).cast("long"))
        merged.write.mode("overwrite").parquet(f"{self.bases}/base={batch_id}")
        self._list(spark, batch_id, "append")

    def entries(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.log)

    def late_versions(self, spark: SparkSession) -> DataFrame:
        """The versions that were left out, with the newer version known when they came as `_known`."""
        return spark.read.parquet(self.late)

    def drain(self, feed: DataFrame, checkpoint_dir: str) -> None:
        query = (
            feed.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def _list(self, spark: SparkSession, base: int, mode: str) -> None:
        spark.range(1).select(F.lit(base).cast("long").alias("base")).write.mode(mode).parquet(self.complete)

    def _last_base(self, spark: SparkSession, before: int | None) -> int:
        """The last base; before a batch, without the one of the batch right before it. That base is made from what is
        stored before this batch, again if the other is run again, and must not be read for itself."""
        listed = spark.read.schema("base long").parquet(self.complete)
        listed = listed if before is None else listed.filter(F.col("base") < max(before - 1, INITIAL + 1))
        return listed.agg(F.max("base")).collect()[0][0]

    def _stored(self, spark: SparkSession, before: int | None) -> DataFrame:
        """The last base and all versions after it, before a batch."""
        base = self._last_base(spark, before)
        rows = spark.read.schema(self.stored).parquet(f"{self.bases}/base={base}")
        since = spark.read.schema(self.stored).parquet(self.versions).filter(F.col("batch") > base)
        return rows.unionByName(since if before is None else since.filter(F.col("batch") < before))

    @staticmethod
    def _age() -> Column:
        return F.struct(VERSION, "batch")

    def _latest(self, rows: DataFrame, order: Column) -> DataFrame:
        kept = [c for c in (*self.columns, "deleted", VERSION) if c != self.key]
        last = F.max_by(F.struct(*kept), order).alias("last")
        return rows.groupBy(self.key).agg(last).select(self.key, "last.*")


def stream_change_log(feed: DataFrame, log: ChangeLog, checkpoint_dir: str) -> DataFrame:
    """Merge all available versions into the table and return the whole log."""
    log.drain(feed, checkpoint_dir)
    return log.entries(feed.sparkSession)
