"""Array rules (ARR1-ARR5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import not_blank


def any_in(ids: Column, wanted: list[int]) -> Column:
    """ARR1: any element in a short literal list (long lists: ``load.with_any_element``)."""
    return F.arrays_overlap(ids, F.array(*[F.lit(i) for i in wanted]))


def length(ids: Column) -> Column:
    """ARR2: number of elements, 0 for null."""
    return F.when(ids.isNull(), 0).otherwise(F.size(ids))


def is_empty(ids: Column) -> Column:
    """ARR4: the rows that break the non-empty rule."""
    return ids.isNull() | (F.size(ids) == 0)


def is_filled(c: Column, data_type: str) -> Column:
    """ARR5: a value that counts as present when records are merged."""
    return not_blank(c) if data_type == "string" else c.isNotNull()
