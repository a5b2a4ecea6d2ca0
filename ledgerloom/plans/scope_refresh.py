"""Scope refresh (PIP28, PIP29): the ids of every dimension a run covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import match, scope
from ledgerloom.operators.scope import ScopeParams


def segment_ids(
    lines: DataFrame, segments: DataFrame, master: DataFrame, parties: DataFrame
) -> DataFrame:
    """FIL13: segments named on the lines, else on their contracts, else on their customers.

    ``lines`` are already in scope.
    """
    sources = [match.segments_by_name(lines, segments)]
    if "segment_id" in lines.columns:
        sources.append(lines)
    if "segment_id" in master.columns:
        sources.append(match.segments_through(lines, master, "contract_id"))
    if "segment_id" in parties.columns:
        owners = parties.withColumnRenamed("id", "customer_id")
        sources.append(match.segments_through(lines, owners, "customer_id"))
    found = scope.precedence(sources, "segment_id")
    return found.select(
        F.lit(scope.SEGMENT).alias("dimension"), F.col("segment_id").cast("bigint").alias("id")
    )


def refresh(
    lines: DataFrame,
    master: DataFrame,
    stores: DataFrame,
    segments: DataFrame,
    parties: DataFrame,
    params: ScopeParams,
) -> DataFrame:
    """PIP28: the whole scope table under the given parameters."""
    scoped = match.within(scope.in_scope(lines, params), master, ["contract_id"])
    ids = scope.scope_ids(scoped)
    channels = scope.channel_ids(ids, stores)
    return ids.unionByName(channels).unionByName(segment_ids(scoped, segments, master, parties))


def fill_dependencies(saved: DataFrame, lines: DataFrame, stores: DataFrame) -> DataFrame:
    """PIP29: add the dimensions a saved scope of contracts lacks.

    Dimensions that are present stay as they are.
    """
    contracts = scope.dimension(saved, scope.CONTRACT, "contract_id")
    derived = scope.scope_ids(match.within(lines, contracts, ["contract_id"]))
    derived = derived.unionByName(scope.channel_ids(derived, stores))
    # At most one entry per dimension name, so this is a constant of a few words, not a join.
    names = [*scope.DIMENSIONS, scope.CHANNEL, scope.SEGMENT]
    present = saved.filter(F.col("dimension").isin(*names)).agg(F.collect_set("dimension"))
    missing = ~F.array_contains(present.scalar(), F.col("dimension"))
    return saved.unionByName(derived.filter(missing))


def segments_in_scope(
    saved: DataFrame, lines: DataFrame, segments: DataFrame, master: DataFrame, parties: DataFrame
) -> DataFrame:
    """PIP1: the segments a saved scope covers, as ids.

    Those it names; else those of the lines in scope; else all. A scope that names neither contracts
    nor customers covers none. ``lines`` are already in scope.
    """
    named = scope.dimension(saved, scope.SEGMENT, "segment_id")
    derived = segment_ids(lines, segments, master, parties).select(F.col("id").alias("segment_id"))
    owners = saved.filter(F.col("dimension").isin(scope.CONTRACT, scope.CUSTOMER)).agg(F.count("*"))
    covered = owners.scalar() > 0
    every = segments.select(F.col("id").alias("segment_id"))
    return scope.precedence([named, derived.filter(covered), every.filter(covered)], "segment_id")
