"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Joins carry no broadcast hints: a side is broadcast only when its measured size is under
# spark.sql.autoBroadcastJoinThreshold. Larger joins shuffle, and adaptive execution splits the
# partitions of hot keys, also where that needs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dates in the tables have no zone; a fixed one keeps casts the same everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Call sites are recorded for every column otherwise, which slows down building long plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        raise ValueError(f"{CHECKPOINT_DIR} is not set and no folder was given")
    return folder


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write what a later step reads and read it back.

    The shuffle files of the write go with its end, so the disk holds those of one step at a time.
    """
    spark = df.sparkSession
    before = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of input for which a shuffle gets one more partition to start with.
BYTES_A_PARTITION = 1 << 20


def with_shuffles_for(spark: SparkSession, folder: str) -> None:
    """Let shuffles start with partitions in proportion to the tables, merged up to 16 MB.

    With the session's fixed number, what a task sorts and groups in memory grows with the tables. Rows
    take over twenty times their shuffled size there.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = str(max(least, size // BYTES_A_PARTITION))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", first)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
