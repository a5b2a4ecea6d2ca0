"""Load modes (LOD1-LOD10): the new content of a target table as a DataFrame.

Nothing is changed in place. The result is written next to the old content and swapped in, so a
lost executor or a failed job never leaves a half-loaded table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import match


def replace_all(incoming: DataFrame) -> DataFrame:
    """LOD1."""
    return incoming


def append_all(kept: DataFrame, incoming: DataFrame) -> DataFrame:
    """The kept rows and all incoming ones."""
    return kept.unionByName(incoming.select(*kept.columns))


def replace_by_key(
    existing: DataFrame, incoming: DataFrame, removed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """LOD2 / LOD5: drop the rows whose (legacy or parent) key is in ``removed``, add incoming."""
    return append_all(match.without(existing, removed.select(*keys), keys), incoming)


def replace_in_buckets(
    existing: DataFrame, incoming: DataFrame, removed: DataFrame, key: str, buckets: int
) -> DataFrame:
    """LOD2 for a target bucketed by a unique key: neither the join nor the write shuffles old rows.

    The removed keys and the incoming rows are dealt into the target's buckets. A plain anti join, as
    a second join column for null keys would not fit the buckets; rows with a null key are kept.
    """
    gone = removed.select(key).repartition(buckets, key).distinct()
    kept = existing.join(gone, key, "left_anti")
    return append_all(kept, incoming.repartition(buckets, key))


def with_any_element(key_rows: DataFrame, ids: DataFrame) -> DataFrame:
    """ARR1 for long lists: the records that stand for any of the legacy ids.

    ``key_rows`` holds one row per (legacy_id, id), so groups of any size are read alike.
    """
    wanted = ids.select(F.col(ids.columns[0]).alias("legacy_id"))
    return match.within(key_rows, wanted, ["legacy_id"]).select("id").distinct()


def replace_by_array_key(
    existing: DataFrame, incoming: DataFrame, key_rows: DataFrame, ids: DataFrame
) -> DataFrame:
    """LOD3: drop the records that stand for any of the legacy ids, add incoming."""
    return replace_by_key(existing, incoming, with_any_element(key_rows, ids), ["id"])


def replace_by_type(
    existing: DataFrame, incoming: DataFrame, type_column: str, owner_type: str
) -> DataFrame:
    """LOD4: replace the rows of one owner type of a shared child table."""
    return append_all(existing.filter(~F.col(type_column).eqNullSafe(owner_type)), incoming)


def new_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming rows whose key the target does not hold yet."""
    return match.without(incoming, existing.select(*keys), keys)


def append_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LOD6 / LOD9: existing rows stay, rows with a new key are added."""
    return append_all(existing, new_rows(existing, incoming, keys))


def insert_ignore(existing: DataFrame, incoming: DataFrame, pair: Sequence[str]) -> DataFrame:
    """LOD7: add each new pair once."""
    return append_new(existing, incoming.dropDuplicates(list(pair)), pair)


@dataclass(frozen=True)
class LoadPolicy:
    """LOD8: how a target is cleared. ``keep_without_ids`` is the rule of the contract tables."""

    clear: bool = False
    keep_without_ids: bool = True

    def mode(self, restricted: bool, has_ids: bool) -> str:
        if self.clear:
            return "replace_all"
        if has_ids and (restricted or not self.keep_without_ids):
            return "replace_by_key"
        if restricted and self.keep_without_ids:
            return "append"
        return "replace_all"


def apply_policy(
    policy: LoadPolicy,
    restricted: bool,
    existing: DataFrame | None,
    incoming: DataFrame,
    removed: DataFrame | None,
    keys: Sequence[str],
) -> DataFrame:
    """LOD8: new content of a target under the policy of the run."""
    mode = policy.mode(restricted, removed is not None)
    if existing is None or mode == "replace_all":
        return replace_all(incoming)
    if mode == "replace_by_key":
        return replace_by_key(existing, incoming, removed, keys)
    return append_all(existing, incoming)


def placeholders(
    owners: DataFrame, existing: DataFrame, key: str, constants: dict[str, Column]
) -> DataFrame:
    """LOD10: one constant row for every owner that has none."""
    missing = match.without(owners.select(key).distinct(), existing, [key])
    return missing.select(key, *[c.alias(name) for name, c in constants.items()])


def map_through(owned: DataFrame, target: DataFrame, key: str, target_id: str) -> DataFrame:
    """LOD10: every owned row with the smallest target id of its owner."""
    chosen = target.groupBy(key).agg(F.min("id").alias(target_id))
    return owned.join(chosen, key)
