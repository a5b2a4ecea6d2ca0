"""Date rules (DAT1-DAT3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_timestamp(run_ts: dt.datetime | str) -> Column:
    """The one "now" of a run, as a constant."""
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def day(c: Column) -> Column:
    """DAT1."""
    return F.to_date(c)


def changed_at(updated: Column, created: Column) -> Column:
    """DAT2: change date, else creation date."""
    return F.coalesce(updated, created)


def first_timestamp(run_ts: dt.datetime | str, *candidates: Column) -> Column:
    """DAT2: first timestamp present, else the run time."""
    return F.coalesce(*candidates, run_timestamp(run_ts))


def first_day(run_ts: dt.datetime | str, *candidates: Column) -> Column:
    """DAT3: first date present, else the run date."""
    return F.to_date(first_timestamp(run_ts, *candidates))
