"""Helpers the operators share: tables, words, and frames that outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# One white-space character between words: space, tab, newline, vertical tab, form feed, return.
SPACE = r"[ \t\n\x0B\f\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file, which every executor has."""
    import public_tokenizers

    return public_tokenizers.path(name)


def split_at_spaces(text: Column) -> Column:
    """Parts between single white-space characters; empty parts stay. Null text: one empty part."""
    return F.split(F.coalesce(text, F.lit("")), SPACE)


def words(text: Column) -> Column:
    """The words of a text, unchanged; null or blank text has none."""
    return F.filter(split_at_spaces(text), lambda w: w != "")


def word_hashes(text: Column) -> Column:
    """64-bit hash of every word, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Where it is unset, a local session gets a folder of its own; a cluster has to name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_DIR, None)
        if not folder and not context.master.startswith(("local[", "local-cluster")) and context.master != "local":
            raise ValueError(f"{CHECKPOINT_DIR} is not set")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


#: The folder of saved steps by application; without one they lie in the shared folder itself.
_SCRATCH: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    return _SCRATCH.get(spark.sparkContext.applicationId) or shared_folder(spark)


def end_scratch(spark: SparkSession) -> None:
    """Delete the folder of saved steps and have none from now on."""
    old = _SCRATCH.pop(spark.sparkContext.applicationId, None)
    if old is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(old)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_scratch(spark: SparkSession, docs: DataFrame) -> None:
    """Give saved steps a new folder, and delete the last one unless `docs` are read from it.

    For chains whose steps are written one after the other: what an operator saved is of no use once
    its result is written.
    """
    application = spark.sparkContext.applicationId
    old = _SCRATCH.get(application)
    if old is not None and not any(old.rsplit("/", 1)[1] in f for f in docs.inputFiles()):
        end_scratch(spark)
    _SCRATCH[application] = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"


def held(docs: DataFrame) -> DataFrame:
    """doc_id, text and `row`, a struct of all columns, so that no column's name can clash."""
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)))
    return docs.select("doc_id", "text", row.alias("row"))


def released(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that `held` put into `row`."""
    return rows.select(*(F.col(f"row.c{i}").alias(c) for i, c in enumerate(columns)))


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame) -> DataFrame:
    """Write a frame as a table in the shared checkpoint folder and read it back from there.

    That ends its lineage, so a lost executor costs no earlier step. The shuffle files of this one
    run go with its end; the table stays until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.saved_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more; what came of them has to be saved itself."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.saved_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
