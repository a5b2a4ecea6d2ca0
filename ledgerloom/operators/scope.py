"""Scope: which contracts, customers, stores, brands and chains a run covers (FIL, AGG14-16, SET)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.operators import match, rollup

# Dimension name in a scope table -> column of the contract lines.
DIMENSIONS = {
    "IdOrcamento": "contract_id",
    "IdCliente": "customer_id",
    "IdEstabelecimento": "store_id",
    "IdBandeira": "brand_id",
    "IdRede": "chain_id",
}
CONTRACT, CUSTOMER, STORE, BRAND, CHAIN = DIMENSIONS
CHANNEL = "IdCanalEstabelecimento"
SEGMENT = "IdSegmentoProduto"


@dataclass(frozen=True)
class ScopeParams:
    """What a run is restricted to. ``contract_ids`` is a one-column table of ids."""

    contract_ids: DataFrame | None = None
    notice_min: str | dt.date | None = None
    start_max: str | dt.date | None = None
    statuses: Sequence[int] = field(default_factory=tuple)
    limit: int = 0

    @property
    def is_restricted(self) -> bool:
        return bool(
            self.contract_ids is not None
            or self.notice_min is not None
            or self.start_max is not None
            or self.statuses
            or self.limit > 0
        )

    def with_ids(self, ids: DataFrame | None) -> ScopeParams:
        return replace(self, contract_ids=ids)


def id_table(spark: SparkSession, ids: Iterable[int]) -> DataFrame:
    """The ids a caller typed, as a table."""
    return spark.createDataFrame([(int(i),) for i in ids], "contract_id bigint")


def notice_from(c: Column, low: str | dt.date) -> Column:
    """FIL2: day on or after the bound; a missing date passes."""
    return (F.to_date(c) >= F.lit(str(low)).cast("date")) | c.isNull()


def start_until(c: Column, high: str | dt.date) -> Column:
    """FIL3: day on or before the bound; a missing date is dropped."""
    return F.to_date(c) <= F.lit(str(high)).cast("date")


def in_scope(lines: DataFrame, params: ScopeParams) -> DataFrame:
    """FIL1: the scope predicate, each part only when given.

    Date and status parts are plain comparisons and reach the scan. The id list is a semi join:
    Spark broadcasts it when it is small and shuffles it when it is not.
    """
    kept = lines
    if params.notice_min is not None:
        kept = kept.filter(notice_from(F.col("notice_at"), params.notice_min))
    if params.start_max is not None:
        kept = kept.filter(start_until(F.col("start_at"), params.start_max))
    if params.statuses:
        kept = kept.filter(F.col("status").isin(*params.statuses))
    if params.contract_ids is not None:
        ids = params.contract_ids.toDF("contract_id")
        kept = match.within(kept, ids, ["contract_id"])
    return kept


def sample(df: DataFrame, params: ScopeParams, *order: str) -> DataFrame:
    """SRT1 / SRT2: the first rows by key when a limit is set."""
    return df.orderBy(*order).limit(params.limit) if params.limit > 0 else df


def scope_ids(lines: DataFrame, dimensions: Mapping[str, str] = DIMENSIONS) -> DataFrame:
    """AGG14: distinct (dimension, id) of every dimension in one pass over the lines."""
    pairs = [
        F.struct(F.lit(name).alias("dimension"), F.col(column).cast("bigint").alias("id"))
        for name, column in dimensions.items()
    ]
    return (
        lines.select(F.inline(F.array(*pairs))).filter(F.col("id").isNotNull()).distinct()
    )


def dimension(scope: DataFrame, name: str, column: str) -> DataFrame:
    """The ids of one dimension."""
    return scope.filter(F.col("dimension") == name).select(F.col("id").alias(column))


def channel_ids(scope: DataFrame, stores: DataFrame) -> DataFrame:
    """AGG15: distinct channels of the stores in scope."""
    wanted = dimension(scope, STORE, "store_id")
    found = match.within(stores.withColumnRenamed("id", "store_id"), wanted, ["store_id"])
    return (
        found.filter(F.col("channel_id").isNotNull())
        .select(F.lit(CHANNEL).alias("dimension"), F.col("channel_id").cast("bigint").alias("id"))
        .distinct()
    )


def first_source(sources: Sequence[DataFrame], column: str) -> DataFrame:
    """FIL13 / SET5: rows of the first source that has the column and any value in it.

    Whether a source holds anything is asked with a one-row read, in order, so later sources are
    not read at all.
    """
    usable = [s for s in sources if column in s.columns]
    if not usable:
        raise ValueError(f"no source has the column {column}")
    for source in usable[:-1]:
        found = source.select(column).filter(F.col(column).isNotNull())
        if not found.isEmpty():
            return found.distinct()
    return usable[-1].select(column).filter(F.col(column).isNotNull()).distinct()


def precedence(candidates: Sequence[DataFrame], column: str) -> DataFrame:
    """FIL13 / SET5 as one plan: the ids of the first candidate that holds any.

    Runs no job while the plan is built. Every id is grouped with the best rank it has, and the best
    rank of all is asked of the same groups, so each candidate is read once.
    """
    ranked = [
        c.select(F.lit(rank).alias("_rank"), F.col(column).cast("bigint").alias(column)).filter(
            F.col(column).isNotNull()
        )
        for rank, c in enumerate(candidates)
    ]
    everything = ranked[0]
    for r in ranked[1:]:
        everything = everything.unionByName(r)
    found = everything.groupBy(column).agg(F.min("_rank").alias("_rank"))
    # Ids of the first candidate have its rank whatever others hold them, too.
    best = found.agg(F.min("_rank")).scalar()
    return found.filter(F.col("_rank") == best).select(column)


def intersect_sheet(requested: DataFrame | None, sheet_ids: DataFrame) -> DataFrame:
    """SET1: requested ids that the sheet lists; with no request, every id of the sheet."""
    wanted = sheet_ids.select("contract_id").distinct()
    if requested is None:
        return wanted
    return match.within(requested.select("contract_id").distinct(), wanted, ["contract_id"])


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """SET1: stop when a scope is empty; a one-row read."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def billing_scope(
    requested: DataFrame | None, sheet_ids: DataFrame, contract_keys: DataFrame
) -> DataFrame:
    """SET2: requested and listed; with no request, listed and already loaded."""
    wanted = (
        requested
        if requested is not None
        else contract_keys.select(F.col("legacy_id").alias("contract_id"))
    )
    return intersect_sheet(wanted, sheet_ids)


def scope_counts(lines: DataFrame, dimensions: Mapping[str, str] = DIMENSIONS) -> DataFrame:
    """AGG16: distinct base rows and distinct ids per dimension, in one row and one scan."""
    base = lines.select(*dimensions.values()).distinct()
    return rollup.distinct_counts(base, {f"{c}_count": c for c in dimensions.values()}, "base_rows")


def merge_scope(
    scope: DataFrame, contract_ids: DataFrame, reset_dependent: bool = False
) -> DataFrame:
    """SNK3: put new contract ids into a scope table; optionally drop the other dimensions."""
    fresh = contract_ids.select(
        F.lit(CONTRACT).alias("dimension"), F.col("contract_id").cast("bigint").alias("id")
    ).distinct()
    if reset_dependent:
        return fresh
    return scope.filter(F.col("dimension") != CONTRACT).unionByName(fresh)


def active_rows(df: DataFrame, *columns: str) -> DataFrame:
    """FIL9: keep active rows; the first of ``columns`` that exists decides, missing is active."""
    present = next((c for c in columns if c in df.columns), None)
    return df if present is None else df.filter(codes.safe_bool(F.col(present), True))


def exact_matches(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """FIL11: lines equal to a wanted scenario, two missing notice dates being equal.

    ``lines`` carry ``hours_number`` and ``rate``; ``wanted`` the six columns compared.
    """
    keyed = lines.withColumns(
        {"start_day": F.to_date("start_at"), "notice_day": F.to_date("notice_at")}
    )
    w, k = wanted.alias("w"), keyed.alias("k")
    same = (
        (F.col("k.contract_id") == F.col("w.contract_id"))
        & (F.col("k.frequency") == F.col("w.frequency"))
        & (F.col("k.hours_number") == F.col("w.hours_number"))
        & (F.col("k.rate") == F.col("w.rate"))
        & (F.col("k.start_day") == F.col("w.start_day"))
        & F.col("k.notice_day").eqNullSafe(F.col("w.notice_day"))
    )
    return k.join(w, same, "left_semi")


def near_matches(lines: DataFrame, wanted: DataFrame, n: int = 10) -> DataFrame:
    """FIL12: per wanted (contract, frequency, start day) the first ``n`` lines by line id.

    The rank is cut before the shuffle, so each map task sends at most ``n`` rows per key.
    """
    keys = ["contract_id", "frequency", "start_day"]
    keyed = lines.withColumn("start_day", F.to_date("start_at"))
    near = match.within(keyed, wanted.select(*keys).distinct(), keys)
    order = Window.partitionBy(*keys).orderBy("line_id", *[F.col(c) for c in lines.columns])
    ranked = near.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")
