"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.scope import ScopeParams, in_scope
from standin import rules
from standin.tables import Tables, duckdb_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PARAMS = ScopeParams(
    notice_min=rules.NOTICE_MIN, start_max=rules.START_MAX, statuses=rules.STATUSES
)


def scoped(t: Tables) -> DataFrame:
    return t.shared("scoped", lambda t: in_scope(t["contract_lines"], PARAMS))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and arrays as text, so both engines print values alike."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def check(name: str, sql: str | None):
    """Register a query with the SQL that gives its expected rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(build(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = duckdb_sql(sql)
        return build

    return register


def shared(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Plan a helper frame once per query, however many parts of the query use it."""
    return lambda t: t.shared(f"{build.__module__}.{build.__name__}", build)
