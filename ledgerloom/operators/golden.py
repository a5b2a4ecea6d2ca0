"""Golden-record merge (AGG5): one record per shared tax id, filled from its duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import arrays, keys, text
from ledgerloom.operators import match

# Ids per array of ``chunked_ids``.
CHUNK_IDS = 1000


def with_merge_key(records: DataFrame) -> DataFrame:
    """STR23: the key that records merge on."""
    return records.withColumn("merge_key", keys.merge_key(F.col("tax_id"), F.col("record_id")))


def merge_records(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG5: one row per merge key.

    Every column takes the first filled value by record id, so the smallest id (the canonical
    record) wins conflicts and its blanks are filled from the next record. ``min_by`` is a partial
    aggregate: one shuffle, and a tax id shared by a third of all records sends one row per task.
    The ids of a group stay rows (``merged_ids``); here they are only counted. ``records`` needs
    record_id, code and tax_id, the zero id standing for none; ``columns`` includes tax_id.
    """
    types = dict(records.dtypes)
    filled = [
        F.min_by(
            F.when(arrays.is_filled(F.col(c), types[c]), F.col(c)),
            F.when(arrays.is_filled(F.col(c), types[c]), F.col("record_id")),
        ).alias(c)
        for c in columns
    ]
    return (
        with_merge_key(records)
        .groupBy("merge_key")
        .agg(
            F.min("record_id").alias("record_id"),
            F.min_by("code", "record_id").alias("code"),
            F.count("*").alias("id_count"),
            *filled,
        )
    )


def with_unique_tax_id(golden: DataFrame) -> DataFrame:
    """STR22 + STR24: records left with the zero id get a synthetic one, after their status is set.

    Only records that merged with nothing keep the zero id, so the tuple holds their single id.
    """
    synthetic = keys.synthetic_tax_id(keys.single_id_text(F.col("record_id")))
    status = keys.tax_id_status(F.col("tax_id"))
    unique = F.when(F.col("tax_id") == text.DEFAULT_TAX_ID, synthetic).otherwise(F.col("tax_id"))
    return golden.withColumns({"tax_id_status": status, "tax_id": unique})


def golden_id(merge_key: Column) -> Column:
    return keys.surrogate_key("customer", merge_key)


def merged_ids(records: DataFrame) -> DataFrame:
    """RSH11 / JOI4: legacy id -> golden id, one row per source record.

    The golden id is a function of the merge key, so the map needs neither a join nor a shuffle.
    """
    return with_merge_key(records).select(
        F.col("record_id").alias("legacy_id"), golden_id(F.col("merge_key")).alias("id")
    )


def chunked_ids(key_rows: DataFrame, width: int = CHUNK_IDS) -> DataFrame:
    """ARR3: sorted arrays of ids by id range, at most ``width`` ids each, for groups of any size."""
    return (
        key_rows.withColumn("chunk", F.floor(F.col("legacy_id") / F.lit(width)).cast("bigint"))
        .groupBy("id", "chunk")
        .agg(F.array_sort(F.collect_set("legacy_id")).alias("legacy_ids"))
    )


def totals(golden: DataFrame, key_rows: DataFrame) -> DataFrame:
    """AGG12 / VAL2 for groups of any size: golden records, the ids they stand for, ids merged away.

    Counted over the key map, so no group is ever gathered in one place.
    """
    ids = key_rows.agg(F.count("*").alias("ids"))
    rows = golden.agg(F.count("*")).scalar()
    return ids.select(rows.alias("rows"), "ids").withColumn(
        "merged", F.greatest(F.lit(0), F.col("ids") - F.col("rows"))
    )


def broken_groups(golden: DataFrame, key_rows: DataFrame) -> DataFrame:
    """ARR4: golden records without a single legacy id."""
    return match.without(golden, key_rows, ["id"])


def require_ids(golden: DataFrame, key_rows: DataFrame) -> DataFrame:
    """ARR4: stop when a golden record has no legacy id."""
    if not broken_groups(golden, key_rows).isEmpty():
        raise ValueError("golden records without legacy ids")
    return golden
