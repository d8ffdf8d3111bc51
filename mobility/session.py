"""Session helpers.

Library code never sets a master: a cluster's ``spark-submit`` decides it.
``local_session`` is for tests, tools and the benchmark only.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter at scale; all are session-level SQL confs.
SCALE_CONF = {
    # Re-plan at run time: coalesce small shuffle partitions, split skewed
    # join partitions, turn a join into a broadcast when one side turns out
    # small after filtering.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Queries read 2-4 of a trip table's columns, so a split of 512 MB of
    # file holds only tens of MB of column data: fewer, fuller scan tasks.
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    # Broadcast only what is counted or measured: no broadcast chosen from
    # file-size estimates before a query runs (dimensions are hinted after a
    # row count, see operators.dimension); AQE may still turn a shuffle join
    # into a broadcast once a side's shuffled size is known.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}
# The session zone is left alone: it decides the wall clock a zoned pickup
# time is read as at the source (e.g. America/New_York for NYC trips); every
# operator after that works on wall-clock (timestamp_ntz) values.


# Target size of one shuffle partition before AQE coalescing.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = SHUFFLE_PARTITION_BYTES) -> int:
    """Initial shuffle partition count for a job reading ``input_bytes``.

    One partition per ``partition_bytes`` of input (at least 200); AQE then
    merges the ones that turn out small after partial aggregation, so the
    count is an upper bound that keeps each reducer's share in memory.
    """
    return max(200, -(-input_bytes // partition_bytes))


# Local runs: one shuffle partition per this much input, between 2 and the
# core count.  Past partial aggregation the shuffled data is a small fraction
# of the input; more partitions than that only add task overhead.
LOCAL_PARTITION_BYTES = 16 * 1024 * 1024


def local_shuffle_partitions(input_bytes: int, cores: int) -> int:
    return max(2, min(cores, -(-input_bytes // LOCAL_PARTITION_BYTES)))


def apply_scale_conf(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Set ``SCALE_CONF`` and, given the input size, the shuffle partitions."""
    for key, value in SCALE_CONF.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(input_bytes)))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_PARTITION_BYTES // 2))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The setting is read from the session and left as it is; a session without
    one is refused, since a folder of one machine would be lost with it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
    return current


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below ``paths``, from the store's own listing (any store Spark can read)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    return sum(hadoop(p).getFileSystem(conf).getContentSummary(hadoop(p)).getLength() for p in paths)


def local_session(app: str = "mobility", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and tools (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MOBILITY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        # Documented static switch: skip collecting the Python call site of
        # every Column call (error messages lose that context; building a
        # plan gets several times cheaper on the driver).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
