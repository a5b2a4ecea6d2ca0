"""Reconciliation, diffs, profiles and reject lists (VAL, AGG17, AGG18, AGG20, SET3, SNK4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.operators import golden, match, rollup


# Fixed value: entries kept in a run history.
KEPT_RUNS = 20


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """SET4."""
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return stacked


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """AGG17 / SET4: one labelled count per table."""
    return union_all(
        [
            df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
            for name, df in tables.items()
        ]
    )


def _known_count(target: DataFrame | int) -> Column:
    return F.lit(target).cast("bigint") if isinstance(target, int) else target.scalar()


def _with_difference(counts: DataFrame) -> DataFrame:
    diff = F.col("source_count") - F.col("target_count")
    return counts.withColumns({"diff": diff, "ok": diff == 0})


def reconcile(steps: Mapping[str, tuple[DataFrame, DataFrame | int]]) -> DataFrame:
    """VAL1: source and target counts of every step; a side is a one-row, one-column table.

    A target may be a number, as the store knows the rows of what it wrote.
    """
    rows = [
        source.toDF("source_count").select(
            F.lit(step).alias("step"), "source_count", _known_count(target).alias("target_count")
        )
        for step, (source, target) in steps.items()
    ]
    return _with_difference(union_all(rows))


def reconcile_row(source: DataFrame, targets: Mapping[str, DataFrame | int]) -> DataFrame:
    """VAL1 for steps whose source counts are the columns of one row, so one pass gives them all."""
    entries = [
        F.struct(
            F.lit(step).alias("step"), F.col(step).alias("source_count"),
            _known_count(target).alias("target_count"),
        )
        for step, target in targets.items()
    ]
    return _with_difference(source.select(F.inline(F.array(*entries))))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def count_array_ids(chunks: DataFrame, ids: str) -> DataFrame:
    """VAL2: customers reconcile on the ids they stand for, not on rows."""
    return rollup.array_ids(chunks, ids)


def reconcile_billing(contracts: DataFrame, billings: DataFrame) -> DataFrame:
    """VAL1: every customer with a contract has a billing row."""
    source = contracts.select(F.countDistinct("customer_id").alias("rows"))
    return reconcile({"billings": (source, billings.select(F.countDistinct("customer_id")))})


def require_mapped(unmapped: DataFrame, what: str, shown: int = 25) -> None:
    """VAL3: stop with the first unmapped names; reads at most ``shown`` rows."""
    names = [str(r[0]) for r in unmapped.orderBy(unmapped.columns[0]).limit(shown).collect()]
    if names:
        raise ValueError(f"{what} without a match: {names}")


def field_diff(
    source: DataFrame, target: DataFrame, keys: Sequence[str], fields: Mapping[str, Column]
) -> DataFrame:
    """VAL4: one row per field that differs between two versions of a record.

    ``fields`` maps a field name to its normal form as an expression over one table; both sides
    are normalised the same way and compared with nulls equal.
    """

    def normal(df: DataFrame, side: str) -> DataFrame:
        cells = [c.cast("string").alias(name) for name, c in fields.items()]
        return df.select(*keys, F.struct(*cells).alias(side))

    joined = normal(source, "s").join(normal(target, "t"), list(keys))
    pairs = [
        F.struct(
            F.lit(name).alias("field"),
            F.col(f"s.{name}").alias("source_value"),
            F.col(f"t.{name}").alias("target_value"),
        )
        for name in fields
    ]
    different = ~F.col("source_value").eqNullSafe(F.col("target_value"))
    return joined.select(*keys, F.inline(F.array(*pairs))).filter(different)


def line_rejects(lines: DataFrame, scenarios: DataFrame, stores: DataFrame) -> DataFrame:
    """JOI6 / VAL5 / VAL9: why a line gets no scenario store.

    ``lines`` and ``scenarios`` carry the four scenario key columns; ``scenarios`` one row per key
    with its stored frequency label. Reasons go in the order they are tested: no scenario with the
    key, the scenario's label does not stand for the line's frequency, unknown store.
    """
    key = ["contract_id", "frequency_key", "hours_key", "rate_key"]
    found = match.left_lookup(
        lines,
        scenarios.select(*key, "scenario_id", F.col("frequency").alias("label")),
        key,
        by="line_id",
    )
    known = stores.select("store_id", F.lit(True).alias("_known_store"))
    found = match.left_lookup(found, known, ["store_id"], by="line_id")
    fits = F.array_contains(codes.frequency_texts(F.col("label")), F.col("frequency_key"))
    reason = (
        F.when(F.col("scenario_id").isNull(), "missing scenario")
        .when(~fits, "incompatible scenario")
        .when(F.col("_known_store").isNull(), "missing store")
    )
    return (
        found.withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .drop("label", "_known_store")
    )


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """SET3: keys only one of two tables has, labelled missing (left only) or extra."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    missing = match.without(a, b, [key]).select(key, F.lit("missing").alias("side"))
    extra = match.without(b, a, [key]).select(key, F.lit("extra").alias("side"))
    return missing.unionByName(extra)


PROFILE_METRICS = ("rows", "non_null", "distinct", "min", "max")


def column_profile(df: DataFrame) -> DataFrame:
    """AGG20: rows, non-null, distinct, smallest and largest value of every column.

    Counts, minima and maxima are one global aggregate. Distinct values are counted over narrow
    (column, value) rows that are aggregated before the shuffle, which costs far less than one
    distinct aggregate per column over full-width rows. Floats are normalised so that -0.0 and
    0.0 are one value.
    """

    def value(name: str, data_type: str) -> Column:
        c = F.col(name)
        return (c + F.lit(0.0) if data_type in ("float", "double") else c).cast("string")

    cells = F.array(
        *[
            F.struct(F.lit(i).alias("position"), value(name, data_type).alias("value"))
            for i, (name, data_type) in enumerate(df.dtypes)
        ]
    )
    distinct = (
        df.select(F.inline(cells))
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("position")
        .agg(F.count("*").alias("distinct"))
    )
    totals = df.agg(
        F.count("*").alias("rows"),
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(name).alias("column"),
                    F.count(name).alias("non_null"),
                    F.min(name).cast("string").alias("min"),
                    F.max(name).cast("string").alias("max"),
                )
                for i, name in enumerate(df.columns)
            ]
        ).alias("columns"),
    ).select("rows", F.inline("columns"))
    profile = totals.join(distinct, "position", "left").fillna({"distinct": 0})
    metrics = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value"))
        for m in PROFILE_METRICS
    ]
    return profile.select("column", F.inline(F.array(*metrics)))


def required_check(df: DataFrame, required: Mapping[str, str]) -> DataFrame:
    """VAL6: per required column, the missing values and those that do not fit the type."""
    aggregates, entries = [], []
    for c, data_type in required.items():
        present = c in df.columns
        value = F.col(c) if present else F.lit(None)
        misfit = value.isNotNull() & value.cast("string").try_cast(data_type).isNull()
        aggregates += [
            F.count_if(value.isNull()).alias(f"{c}__missing"),
            F.count_if(misfit).alias(f"{c}__misfit"),
        ]
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                F.lit(data_type).alias("type"),
                F.lit(present).alias("present"),
                F.col(f"{c}__missing").alias("missing"),
                F.col(f"{c}__misfit").alias("misfit"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def error_types(errors: DataFrame, message: str) -> DataFrame:
    """AGG18: errors counted by the text before the first colon."""
    kind = F.substring_index(F.col(message), ":", 1).alias("error_type")
    return errors.groupBy(kind).agg(F.count("*").alias("errors"))


def run_history(history: DataFrame | None, entry: DataFrame, kept: int = KEPT_RUNS) -> DataFrame:
    """SNK4: the newest entries of a run history."""
    both = entry if history is None else history.unionByName(entry)
    return both.orderBy(F.col("run_at").desc(), *[c for c in both.columns if c != "run_at"]).limit(
        kept
    )


def snapshot(golden_rows: DataFrame, key_rows: DataFrame, billings: DataFrame) -> DataFrame:
    """VAL10: totals at the end of a run."""
    billing_rows = billings.agg(F.count("*")).scalar()
    return golden.totals(golden_rows, key_rows).withColumn("billings", billing_rows)
