from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerloom.session import CHECKPOINT_DIR, configured  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        configured(SparkSession.builder.master("local[8]"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config(CHECKPOINT_DIR, shared)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def tables(spark):
    from standin.tables import Tables

    return Tables(spark, SF)


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of an expression over a column of inputs, in input order."""

    def run(build, values, data_type="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {data_type}")
        rows = df.select("i", build(F.col("v")).alias("r")).collect()
        return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
