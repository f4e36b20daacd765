"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# All of these are runtime settings, so they can be applied to a session somebody else has built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Bytes one shuffle task should handle.
BYTES_PER_TASK = 200 * 1024 * 1024


def size_shuffles(spark: SparkSession, shuffled_bytes: int, cores: int) -> None:
    """Set the number of shuffle partitions for the amount of data a job moves.

    Adaptive execution only ever merges partitions, so the number to begin with has to be large enough: at least
    two tasks per core, and no task above BYTES_PER_TASK.
    """
    by_size = -(-shuffled_bytes // BYTES_PER_TASK)
    spark.conf.set("spark.sql.shuffle.partitions", str(max(by_size, 2 * cores)))


# Stored bytes of facts that give one more shuffle partition to begin with, and shuffled bytes a merged one may have.
# Ids and sums compress well: in a task that joins, sorts and groups them they take about fifty times that memory.
STORED_BYTES_PER_PARTITION = 4 * 1024 * 1024
MERGED_BYTES = 16 * 1024 * 1024


def size_merging(spark: SparkSession, paths: list[str]) -> None:
    """Let adaptive execution begin with partitions for the size of these files, and merge them to MERGED_BYTES.

    The memory of a task then stays as it is while the files grow. The session's own number is the least.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    stored = files.agg({"length": "sum"}).first()[0] or 0  # sizes only; no file is read
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = max(least, -(-stored // STORED_BYTES_PER_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(MERGED_BYTES))


def local_session(
    cores: str = "8", app: str = "tillspan", shuffle_partitions: int = 8, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and local runs. A cluster brings its own session; see `tune`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
