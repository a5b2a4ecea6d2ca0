"""Roll-ups and counts (AGG1-AGG4, AGG6-AGG13)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import arrays
from ledgerloom.operators.reshape import CHARGE_AMOUNTS

# Columns of a contract roll-up that come from the lines and from the contract master.
CONTRACT_LINE_MAX = (
    "customer_name", "billing_day", "due_day", "status", "start_at", "contract_created_at",
    "contract_updated_at", "store_id", "brand_id", "chain_id", "notice_at",
)
CONTRACT_MASTER_COLUMNS = (
    "billing_mode", "operation", "thirteenth_rule", "trade_marketing",
)
SCENARIO_KEYS = (
    "contract_id", "frequency", "hours", "price", "task_name", "customer_name", "status",
    "task_id", "customer_id",
)
SCENARIO_MAX = ("start_day", "notice_day", "line_created_at", "line_updated_at")


def contract_rollup(lines: DataFrame, master: DataFrame) -> DataFrame:
    """JOI1 + AGG1: one row per contract in scope.

    The lines are aggregated before they meet the master, whose key is the contract: the join then
    handles one row per contract instead of one per line, and ``max`` over a functionally
    dependent column is that column.
    """
    rolled = lines.groupBy("contract_id").agg(
        F.min("customer_id").alias("customer_id"),
        *[F.max(c).alias(c) for c in CONTRACT_LINE_MAX],
    )
    parents = master.select("contract_id", *CONTRACT_MASTER_COLUMNS)
    return rolled.join(parents, "contract_id")


def customer_of_contract(lines: DataFrame) -> DataFrame:
    """AGG19: contract -> smallest customer and largest name."""
    return lines.groupBy("contract_id").agg(
        F.min("customer_id").alias("customer_id"), F.max("customer_name").alias("customer_name")
    )


def scenario_rollup(lines: DataFrame) -> DataFrame:
    """AGG2: lines grouped on the nine scenario columns with the latest dates."""
    dated = lines.filter(F.col("customer_id").isNotNull()).withColumns(
        {"start_day": F.to_date("start_at"), "notice_day": F.to_date("notice_at")}
    )
    return dated.groupBy(*SCENARIO_KEYS).agg(*[F.max(c).alias(c) for c in SCENARIO_MAX])


def scenario_by_day(lines: DataFrame, rate: Column) -> DataFrame:
    """AGG3: lines grouped with their dates cut to days, with the number of stores."""
    return lines.groupBy(
        "contract_id",
        "frequency",
        "hours",
        rate.alias("rate"),
        F.to_date("start_at").alias("start_day"),
        F.to_date("notice_at").alias("notice_day"),
    ).agg(
        F.max("task_name").alias("task_name"),
        F.max("customer_name").alias("customer_name"),
        F.max("status").alias("status"),
        F.max("line_created_at").alias("line_created_at"),
        F.max("line_updated_at").alias("line_updated_at"),
        F.max("task_id").alias("task_id"),
        F.max("customer_id").alias("customer_id"),
        F.count("*").alias("stores"),
    )


def count_groups(df: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """AGG4: number of distinct keys, as a one-row table."""
    return df.select(*keys).distinct().agg(F.count("*").alias(name))


def composite_key(*parts: Column) -> Column:
    """AGG6: key text with '|' between the parts, missing parts empty."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def count_ids(df: DataFrame, column: str, limit: int = 0) -> DataFrame:
    """AGG8: distinct ids, optionally among the first ``limit`` ids in order."""
    ids = df.select(column).filter(F.col(column).isNotNull()).distinct()
    if limit > 0:
        ids = ids.orderBy(column).limit(limit)
    return ids.agg(F.count("*").alias("ids"))


def id_bitmaps(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """AGG16: exact bitmaps of whole-number columns, all in one pass.

    A row is (name, word, bits, rows): the 64 ids of one word of one column as bits, and the rows that
    hold them; rows without an id have no word. The bits are a plain number, so both halves of the
    aggregate are hash aggregates, and a map task sends one row for up to 64 ids of a column.
    """
    ids = [
        F.struct(F.lit(name).alias("name"), F.col(c).cast("bigint").alias("id"))
        for name, c in columns.items()
    ]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("id").bitwiseAND(F.lit(63)).cast("int"))
    return (
        df.select(F.inline(F.array(*ids)))
        .groupBy("name", F.shiftright("id", 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("rows"))
    )


def distinct_counts(df: DataFrame, columns: Mapping[str, str], rows: str | None = None) -> DataFrame:
    """AGG8 / AGG16: the distinct ids of several columns in one row, and the number of rows.

    One scan and no expansion into one set of rows per distinct count.
    """
    first = next(iter(columns))
    found = [
        F.coalesce(F.sum(F.when(F.col("name") == name, F.bit_count("bits"))), F.lit(0)).cast("bigint").alias(name)
        for name in columns
    ]
    if rows is not None:
        counted = F.sum(F.when(F.col("name") == first, F.col("rows")))
        found.insert(0, F.coalesce(counted, F.lit(0)).alias(rows))
    return id_bitmaps(df, columns).agg(*found)


def count_when(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """AGG7 / AGG11: one count per condition, all in one pass; ``rows`` counts everything."""
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(condition).alias(name) for name, condition in conditions.items()],
    )


def count_charges(master: DataFrame) -> DataFrame:
    """AGG7: number of charge rows the contracts give, as a sum of conditional counts."""
    first, *others = CHARGE_AMOUNTS
    total = F.count_if((F.col(first) > 0) | F.coalesce(F.col("equipment_charged"), F.lit(False)))
    for c in others:
        total = total + F.count_if(F.col(c) > 0)
    return master.agg(total.alias("rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], top: int = 10) -> DataFrame:
    """AGG9: the most repeated keys."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .orderBy(F.col("rows").desc(), *keys)
        .limit(top)
    )


def key_range(df: DataFrame, key: str) -> DataFrame:
    """AGG10: smallest, largest and number of distinct keys."""
    return df.agg(
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
        F.countDistinct(key).alias("keys"),
    )


def array_ids(chunks: DataFrame, ids: str) -> DataFrame:
    """ARR2: summed lengths of the id arrays."""
    return chunks.agg(F.coalesce(F.sum(arrays.length(F.col(ids))), F.lit(0)).alias("ids"))


def array_totals(golden: DataFrame, chunks: DataFrame, ids: str) -> DataFrame:
    """AGG12: records, the ids in their arrays (any number of arrays each) and the ids merged away."""
    rows = golden.agg(F.count("*")).scalar()
    return array_ids(chunks, ids).select(rows.alias("rows"), "ids").withColumn(
        "merged", F.greatest(F.lit(0), F.col("ids") - F.col("rows"))
    )


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """AGG13: distinct pairs without missing parts."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b).distinct()
