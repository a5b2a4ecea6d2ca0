"""Scope documents, run history and reports on files (SRC5, SNK2-SNK5)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import quality, scope
from ledgerloom.sources import schemas
from ledgerloom.sources.catalog import TargetStore


def save_scope(store: TargetStore, ids: DataFrame) -> DataFrame:
    """SNK2: the (dimension, id) table without nulls, sorted inside its files."""
    clean = ids.filter(F.col("id").isNotNull()).distinct()
    return store.write("scope", schemas.conform(clean, "scope").sortWithinPartitions("dimension", "id"))


def load_scope(store: TargetStore) -> DataFrame | None:
    """SRC5: the saved scope; None means unrestricted."""
    return store.read("scope")


def merge_sheet_scope(
    store: TargetStore, contract_ids: DataFrame, reset_dependent: bool = False
) -> DataFrame:
    """SNK3: put the sheet's contracts into the saved scope."""
    saved = load_scope(store)
    if saved is None:
        saved = store.spark.createDataFrame([], schemas.schema("scope"))
    return save_scope(store, scope.merge_scope(saved, contract_ids, reset_dependent))


def save_run(
    store: TargetStore,
    target: str,
    run_at: dt.datetime | str,
    seconds: float,
    measures: Mapping[str, int],
) -> DataFrame:
    """SNK4: add a run to the history and keep the newest ones."""
    entry = store.spark.createDataFrame(
        [(dt.datetime.fromisoformat(str(run_at)), target, float(seconds), dict(measures))],
        schemas.schema("run_history"),
    )
    history = store.read("run_history")
    both = entry if history is None else history.unionByName(entry)
    kept = both.orderBy(F.col("run_at").desc(), "target", "seconds").limit(quality.KEPT_RUNS)
    return store.write("run_history", kept)


def write_report(report: DataFrame, path: str) -> None:
    """SNK5: a discrepancy report as CSV files with a header."""
    report.write.mode("errorifexists").csv(path, header=True)
