"""Checks that write target tables, documents and reports, and read them back.

Every check writes below a new folder of the shared one, so runs never meet.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ledgerloom.operators import load, scope
from ledgerloom.session import CHECKPOINT_DIR
from ledgerloom.sources import reports
from ledgerloom.sources.catalog import TargetStore
from standin.load_checks import _NEW, _OLD, _old_new, field_diff
from standin.registry import ORACLES, check
from standin.scope_checks import V
from standin.tables import Tables


def folder_of(t: Tables) -> str:
    """A new folder; where no shared one is named, as in a local test, a temporary one."""
    shared = t.spark.conf.get(CHECKPOINT_DIR, None) or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{shared}/checks/{uuid.uuid4().hex}"


def store_of(t: Tables) -> TargetStore:
    return TargetStore(t.spark, folder_of(t))


@check("stored_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM {orders}")
def stored_table(t):
    """SNK1: a table written as a new version and read back."""
    store = store_of(t)
    store.write("orders", t["nation"])
    return store.write(
        "orders", t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    )


@check("stored_append", f"{_OLD} UNION ALL SELECT * FROM ({_NEW}) n WHERE o_orderkey % 2 <> 0")
def stored_append(t):
    """LOD6 / LOD9: rows of new keys are added as a folder of their own."""
    old, new = _old_new(t)
    store = store_of(t)
    existing = store.write("orders", old)
    return store.append("orders", load.new_rows(existing, new, ["o_orderkey"]))


_PAIRS = "SELECT DISTINCT l_suppkey, l_linenumber FROM {lineitem}"


@check("stored_pairs", _PAIRS)
def stored_pairs(t):
    """LOD7: pairs that conflict with stored ones are left out of what is written."""
    pair = ["l_suppkey", "l_linenumber"]
    pairs = t["lineitem"].select(*pair, "l_returnflag")
    store = store_of(t)
    existing = store.write("pairs", pairs.filter("l_returnflag = 'A'").select(*pair).distinct())
    incoming = pairs.select(*pair).dropDuplicates(pair)
    return store.append("pairs", load.new_rows(existing, incoming, pair))


@check(
    "stored_parts",
    """SELECT event_id, event_type, 'old' AS version FROM {events} WHERE event_type <> 'view'
    UNION ALL SELECT event_id, event_type, 'new' FROM {events} WHERE event_type = 'view'""",
)
def stored_parts(t):
    """LOD4: every event type is a part, loaded by itself; one of them is loaded again."""
    events = t["events"].select("event_id", "event_type")
    store = store_of(t)
    with store.step("all types"):
        for kind in ("view", "click", "error", "purchase", "signup"):
            rows = events.filter(F.col("event_type") == kind)
            store.write("events", rows.withColumn("version", F.lit("old")), part=kind)
        rest = events.filter("event_type NOT IN ('view', 'click', 'error', 'purchase', 'signup')")
        store.write("events", rest.withColumn("version", F.lit("old")), part="other")
    again = events.filter("event_type = 'view'").withColumn("version", F.lit("new"))
    return store.write("events", again, part="view")


@check(
    "stored_rows",
    """SELECT 'orders' AS "table", CAST(NULL AS VARCHAR) AS part, count(*) AS rows FROM {orders}
    UNION ALL SELECT 'lines', l_returnflag, count(*) FROM {lineitem} GROUP BY l_returnflag""",
)
def stored_rows(t):
    """SNK4 / VAL10: rows counted while they were written, read from the version alone."""
    store = store_of(t)
    with store.step("counted", "run"):
        store.write("orders", t["orders"])
        for flag in ("A", "N", "R"):
            store.write("lines", t["lineitem"].filter(F.col("l_returnflag") == flag), part=flag)
    content = store.content()
    rows = [(name, f.part, f.rows) for name in content.tables for f in content.folders(name)]
    return t.spark.createDataFrame(rows, '`table` string, part string, rows long')


@check(
    "scope_document",
    f"""{V} SELECT DISTINCT 'IdOrcamento' AS dimension, CAST(contract_id AS BIGINT) AS id FROM v
      WHERE contract_id IS NOT NULL
    UNION SELECT DISTINCT 'IdCliente', CAST(customer_id AS BIGINT) FROM v WHERE customer_id IS NOT NULL
    UNION SELECT DISTINCT 'IdEstabelecimento', CAST(store_id AS BIGINT) FROM v WHERE store_id IS NOT NULL
    UNION SELECT DISTINCT 'IdBandeira', CAST(brand_id AS BIGINT) FROM v WHERE brand_id IS NOT NULL
    UNION SELECT DISTINCT 'IdRede', CAST(chain_id AS BIGINT) FROM v WHERE chain_id IS NOT NULL""",
)
def scope_document(t):
    """SNK2 and SRC5: the scope of the lines saved, with nulls and repeats, and loaded again."""
    from standin.registry import scoped

    store = store_of(t)
    ids = scope.scope_ids(scoped(t))
    reports.save_scope(store, ids.unionByName(ids).unionByName(ids.withColumn("id", F.lit(None).cast("long"))))
    return reports.load_scope(store)


@check("discrepancy_report", ORACLES["field_diff"])
def discrepancy_report(t):
    """SNK5: the differences of VAL4 as a report on files, read back."""
    path = folder_of(t)
    found = field_diff(t)
    reports.write_report(found, path)
    return t.spark.read.schema(found.schema).csv(path, header=True)
