"""Keys: surrogate ids and the identifiers of merged records (STR22-STR24)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import DEFAULT_TAX_ID

_SYNTHETIC_MODULUS = 10**13


def surrogate_key(entity: str, *parts: Column) -> Column:
    """Deterministic 36-character id of an entity from its natural key.

    The same input gives the same id in every run and on every executor, so lost tasks can be
    recomputed and no key has to be read back from the target. Every part is written behind its
    length and a null part as a dash, so different keys never give the same text.
    """
    texts = [p.cast("string") for p in parts]
    cells = [
        F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ]
    key = F.md5(F.concat(F.lit(f"{entity}|"), *cells))
    for dash in (9, 14, 19, 24):
        key = F.overlay(key, F.lit("-"), dash, 0)
    return key


def merge_key(tax_id: Column, record_id: Column) -> Column:
    """STR23: a 14-digit id that is not all zeros, else a key of the record alone."""
    shared = tax_id.rlike("^[0-9]{14}$") & (tax_id != DEFAULT_TAX_ID)
    return F.when(shared, tax_id).otherwise(
        F.concat(F.lit("__id_"), record_id.cast("string"))
    )


def tax_id_status(tax_id: Column) -> Column:
    """STR24."""
    return F.when((tax_id != "") & (tax_id != DEFAULT_TAX_ID), "valid").otherwise("invalid")


def id_tuple_text(ids: Column) -> Column:
    """Sorted ids as tuple text: ``(5,)`` for one id, ``(3, 7)`` for more."""
    joined = F.array_join(F.transform(F.array_sort(ids), lambda i: i.cast("string")), ", ")
    return F.concat(F.lit("("), joined, F.when(F.size(ids) == 1, ",").otherwise(""), F.lit(")"))


def single_id_text(record_id: Column) -> Column:
    """``id_tuple_text`` of a record that was not merged with others."""
    return F.concat(F.lit("("), record_id.cast("string"), F.lit(",)"))


def synthetic_tax_id(tuple_text: Column) -> Column:
    """STR22: '9' and 13 digits from the SHA-256 of the tuple text, modulo 10^13.

    The 256-bit number is folded four hex digits at a time, which always fits a bigint.
    """
    h = F.sha2(tuple_text, 256)
    chunks = [
        F.conv(F.substring(h, i * 4 + 1, 4), 16, 10).cast("bigint") for i in range(16)
    ]
    folded = reduce(lambda acc, chunk: (acc * 65536 + chunk) % _SYNTHETIC_MODULUS, chunks)
    return F.concat(F.lit("9"), F.lpad(folded.cast("string"), 13, "0"))
