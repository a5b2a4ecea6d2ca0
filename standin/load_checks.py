"""Checks of load modes, diffs, profiles and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import keys, text
from ledgerloom.operators import golden, load, match, quality, rollup
from ledgerloom.plans import billing, customers, users
from standin import record_checks as records
from standin import rules as r
from standin.registry import check

# Old content: even keys as they were. New content: keys divisible by 3 as they are now.
_OLD = "SELECT o_orderkey, o_custkey, 'old' AS version FROM {orders} WHERE o_orderkey % 2 = 0"
_NEW = "SELECT o_orderkey, o_custkey, 'new' AS version FROM {orders} WHERE o_orderkey % 3 = 0"


def _version(t, every: int, name: str):
    return t["orders"].filter(F.col("o_orderkey") % every == 0).select(
        "o_orderkey", "o_custkey", F.lit(name).alias("version")
    )


def _old_new(t):
    return _version(t, 2, "old"), _version(t, 3, "new")


@check("replace_all", _NEW)
def replace_all(t):
    """LOD1."""
    return load.replace_all(_old_new(t)[1])


@check(
    "replace_by_key",
    f"SELECT * FROM ({_OLD}) o WHERE o_orderkey % 3 <> 0 UNION ALL {_NEW}",
)
def replace_by_key(t):
    """LOD2 and LOD8 of a restricted run."""
    old, new = _old_new(t)
    return load.apply_policy(load.LoadPolicy(), True, old, new, new, ["o_orderkey"])


@check(
    "replace_by_parent",
    f"""SELECT * FROM ({_OLD}) o WHERE o_custkey NOT IN
      (SELECT c_custkey FROM {{customer}} WHERE c_mktsegment = 'BUILDING')
    UNION ALL SELECT * FROM ({_NEW}) n WHERE o_custkey IN
      (SELECT c_custkey FROM {{customer}} WHERE c_mktsegment = 'BUILDING')""",
)
def replace_by_parent(t):
    """LOD5."""
    old, new = _old_new(t)
    parents = t["customer"].filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey")
    )
    fresh = new.join(parents, "o_custkey", "left_semi")
    return load.replace_by_key(old, fresh, parents, ["o_custkey"])


@check(
    "replace_by_type",
    """SELECT event_id, event_type, 'old' AS version FROM {events} WHERE event_type <> 'view'
    UNION ALL SELECT event_id, event_type, 'new' FROM {events}
    WHERE event_type = 'view' AND event_id % 2 = 0""",
)
def replace_by_type(t):
    """LOD4."""
    events = t["events"].select("event_id", "event_type")
    old = events.withColumn("version", F.lit("old"))
    new = events.filter("event_type = 'view' AND event_id % 2 = 0").withColumn(
        "version", F.lit("new")
    )
    return load.replace_by_type(old, new, "event_type", "view")


_GOLDEN = f"WITH {records.ALL_PARTIES}, {records.GOLDEN}"


@check(
    "replace_by_array_key",
    f"""{_GOLDEN}, touched AS (SELECT DISTINCT {r.key('customer', 'merge_key')} AS id
      FROM keyed_parties WHERE record_id % 7 = 0)
    SELECT id, id_count FROM golden_customers WHERE id NOT IN (SELECT id FROM touched)""",
)
def replace_by_array_key(t):
    """LOD3 and ARR1: golden records that hold any of the ids go, whatever other ids they hold."""
    records_now = customers.golden_customers(t["parties"]).select("id", "id_count")
    key_rows = customers.customer_keys(t["parties"])
    ids = t["customer"].filter("c_custkey % 7 = 0").select("c_custkey")
    return load.replace_by_array_key(records_now, records_now.limit(0), key_rows, ids)


@check(
    "append_new",
    f"{_OLD} UNION ALL SELECT * FROM ({_NEW}) n WHERE o_orderkey % 2 <> 0",
)
def append_new(t):
    """LOD6."""
    old, new = _old_new(t)
    return load.append_new(old, new, ["o_orderkey"])


@check(
    "insert_ignore",
    """SELECT l_suppkey, l_linenumber FROM {lineitem} WHERE l_returnflag = 'A'
      GROUP BY l_suppkey, l_linenumber
    UNION SELECT l_suppkey, l_linenumber FROM {lineitem}""",
)
def insert_ignore(t):
    """LOD7."""
    pair = ["l_suppkey", "l_linenumber"]
    old = t["lineitem"].filter("l_returnflag = 'A'").select(*pair).distinct()
    return load.insert_ignore(old, t["lineitem"].select(*pair), pair)


@check(
    "load_policy",
    f"""SELECT 'clear' AS run, * FROM ({_NEW}) a
    UNION ALL SELECT 'restricted', * FROM (SELECT * FROM ({_OLD}) o WHERE o_orderkey % 3 <> 0
      UNION ALL {_NEW}) b
    UNION ALL SELECT 'unrestricted', * FROM ({_NEW}) c
    UNION ALL SELECT 'restricted without ids', * FROM ({_OLD} UNION ALL {_NEW}) d
    UNION ALL SELECT 'ids only', * FROM (SELECT * FROM ({_OLD}) o WHERE o_orderkey % 3 <> 0
      UNION ALL {_NEW}) e""",
)
def load_policy(t):
    """LOD8: every branch of both policies."""
    old, new = _old_new(t)
    usual, by_ids = load.LoadPolicy(), load.LoadPolicy(keep_without_ids=False)
    runs = {
        "clear": (load.LoadPolicy(clear=True), True, new),
        "restricted": (usual, True, new),
        "unrestricted": (usual, False, new),
        "restricted without ids": (usual, True, None),
        "ids only": (by_ids, False, new),
    }
    content = None
    for name, (policy, restricted, removed) in runs.items():
        part = load.apply_policy(policy, restricted, old, new, removed, ["o_orderkey"])
        part = part.select(F.lit(name).alias("run"), "*")
        content = part if content is None else content.unionByName(part)
    return content


@check(
    "first_contract_of_customer",
    "SELECT o_custkey AS customer_id, min(o_orderkey) AS contract_id FROM {orders} GROUP BY 1",
)
def first_contract(t):
    """WIN3."""
    orders = t["orders"].select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("contract_id")
    )
    return match.first_per_key(orders, ["customer_id"], ["contract_id"])


_BILLED = """SELECT 'c' || c_custkey AS customer_id FROM {customer} WHERE c_acctbal > 5000"""


def _billing_frames(t):
    contracts = t["orders"].select(
        F.col("o_orderkey").alias("legacy_id"),
        keys.surrogate_key("contract", F.col("o_orderkey")).alias("id"),
        F.concat(F.lit("c"), F.col("o_custkey")).alias("customer_id"),
    )
    billed = t["customer"].filter("c_acctbal > 5000").select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("customer_id"), F.col("c_name").alias("name")
    )
    rows = billing.conform(
        billed.withColumn("id", keys.surrogate_key("billing", F.col("customer_id"))), "billings"
    )
    return contracts, rows


@check(
    "billing_placeholders",
    f"""WITH billed AS ({_BILLED})
    SELECT {r.key('billing', 'customer_id')} AS id, customer_id, FALSE AS placeholder FROM billed
    UNION ALL SELECT DISTINCT {r.key('billing', "'c' || o_custkey")}, 'c' || o_custkey, TRUE
    FROM {{orders}} WHERE 'c' || o_custkey NOT IN (SELECT customer_id FROM billed)""",
)
def billing_placeholders(t):
    """LOD9 and LOD10."""
    contracts, rows = _billing_frames(t)
    return billing.with_placeholders(rows, contracts, r.RUN_TS).select(
        "id", "customer_id", (F.col("name") == billing.PLACEHOLDER_NAME).alias("placeholder")
    )


@check(
    "billing_map",
    f"""SELECT o_orderkey AS contract_legacy_id, {r.key('contract', 'o_orderkey')} AS contract_id,
      {r.key('billing', "'c' || o_custkey")} AS billing_id
    FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey WHERE c_acctbal > 5000""",
)
def billing_map(t):
    """LOD10."""
    return billing.contract_billings(*_billing_frames(t))


_FIELDS = ("o_orderstatus", "o_totalprice", "o_orderday", "o_orderpriority", "o_custkey")


@check(
    "field_diff",
    """WITH s AS (SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS p,
        CAST(o_orderdate AS DATE) AS d, o_orderpriority AS pr, o_custkey AS c FROM {orders}),
    t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS st,
        CASE WHEN o_orderkey % 7 = 0 THEN p + 1 ELSE p END AS p2,
        CASE WHEN o_orderkey % 9 = 0 THEN d + 1 ELSE d END AS d2,
        CASE WHEN o_orderkey % 11 = 0 THEN ' x ' ELSE ' ' || pr || ' ' END AS pr2, c AS c2,
        o_orderstatus AS st1, p AS p1, d AS d1, pr AS pr1
      FROM s WHERE o_orderkey % 4 <> 0)
    SELECT o_orderkey, 'status' AS field, st1 AS source_value, st AS target_value FROM t
      WHERE st IS DISTINCT FROM st1
    UNION ALL SELECT o_orderkey, 'price', CAST(p1 AS VARCHAR), CAST(p2 AS VARCHAR) FROM t
      WHERE p1 <> p2
    UNION ALL SELECT o_orderkey, 'day', CAST(d1 AS VARCHAR), CAST(d2 AS VARCHAR) FROM t
      WHERE d1 <> d2
    UNION ALL SELECT o_orderkey, 'priority', pr1, trim(pr2) FROM t WHERE pr1 <> trim(pr2)""",
)
def field_diff(t):
    """VAL4: two versions of the orders, compared in normal form."""
    source = t["orders"]
    every = lambda n: F.col("o_orderkey") % n == 0
    target = source.filter("o_orderkey % 4 <> 0").select(
        "o_orderkey",
        "o_custkey",
        F.when(~every(5), F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice").cast("decimal(18,2)") + F.when(every(7), 1).otherwise(0)).alias(
            "o_totalprice"
        ),
        F.when(every(9), F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("o_orderdate"))
        .alias("o_orderdate"),
        F.when(every(11), " x ")
        .otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))
        .alias("o_orderpriority"),
    )
    fields = {
        "status": F.col("o_orderstatus"),
        "price": F.col("o_totalprice").cast("decimal(18,2)"),
        "day": F.to_date("o_orderdate"),
        "priority": text.strip(F.col("o_orderpriority")),
        "customer": F.col("o_custkey"),
    }
    return quality.field_diff(source, target, ["o_orderkey"], fields)


@check(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {{{name}}}"
        for name in ("customer", "orders", "lineitem", "part", "supplier", "events")
    ),
)
def table_counts(t):
    """AGG17 and SET4."""
    names = ("customer", "orders", "lineitem", "part", "supplier", "events")
    return quality.table_counts({n: t[n] for n in names})


@check(
    "set_difference",
    """SELECT o_custkey, 'missing' AS side FROM {orders} GROUP BY o_custkey
      HAVING max(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) = 1
        AND max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) = 0
    UNION ALL SELECT o_custkey, 'extra' FROM {orders} GROUP BY o_custkey
      HAVING max(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) = 0
        AND max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) = 1""",
)
def set_difference(t):
    """SET3: customers with pressing orders against those with low ones."""
    left = t["orders"].filter("o_orderpriority IN ('1-URGENT', '2-HIGH')")
    right = t["orders"].filter("o_orderpriority = '5-LOW'")
    return quality.set_difference(left, right, "o_custkey")


_PROFILED = ("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "notice")


@check(
    "column_profile",
    "WITH x AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS notice FROM {lineitem}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", m AS metric, v AS value FROM (SELECT unnest(['rows', 'non_null', "
        f"'distinct', 'min', 'max']) AS m, unnest([CAST(a AS VARCHAR), CAST(b AS VARCHAR), "
        f"CAST(d AS VARCHAR), CAST(lo AS VARCHAR), CAST(hi AS VARCHAR)]) AS v FROM (SELECT count(*) AS a, "
        f"count({c}) AS b, count(DISTINCT {c}) AS d, min({c}) AS lo, max({c}) AS hi FROM x) y) z"
        for c in _PROFILED
    ),
)
def column_profile(t):
    """AGG20."""
    lines = t["lineitem"].withColumn(
        "notice", F.when(F.col("l_linestatus") == "F", F.col("l_returnflag"))
    )
    return quality.column_profile(lines.select(*_PROFILED))


@check(
    "required_check",
    f"""SELECT 'frequency' AS "column", 'double' AS type, TRUE AS present,
      count(*) FILTER (frequency IS NULL) AS missing,
      count(*) FILTER (frequency IS NOT NULL AND {r.number('frequency')} IS NULL) AS misfit FROM {{contract_lines}}
    UNION ALL SELECT 'hours', 'int', TRUE, count(*) FILTER (hours IS NULL),
      count(*) FILTER (hours IS NOT NULL AND {r.whole('hours')} IS NULL) FROM {{contract_lines}}
    UNION ALL SELECT 'start_at', 'timestamp_ntz', TRUE, count(*) FILTER (start_at IS NULL), 0
      FROM {{contract_lines}}
    UNION ALL SELECT 'currency', 'string', FALSE, count(*), 0 FROM {{contract_lines}}""",
)
def required_check(t):
    """VAL6."""
    required = {
        "frequency": "double", "hours": "int", "start_at": "timestamp_ntz", "currency": "string",
    }
    return quality.required_check(t["contract_lines"], required)


@check(
    "error_types",
    """SELECT event_type || ' failed' AS error_type, count(*) AS errors FROM {events} GROUP BY 1""",
)
def error_types(t):
    """AGG18."""
    errors = t["events"].select(
        F.concat("event_type", F.lit(" failed: user "), "user_id", F.lit(": "), "props").alias("m")
    )
    return quality.error_types(errors, "m")


@check(
    "run_history",
    """SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS run_at, count(*) AS errors FROM {events}
    GROUP BY 1 ORDER BY run_at DESC LIMIT 20""",
)
def run_history(t):
    """SNK4: one run per day of events, the newest day being the run that just ended."""
    days = t["events"].groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("errors"))
    runs = days.select(F.col("day").cast("timestamp_ntz").alias("run_at"), "errors")
    last = days.agg(F.max("day").cast("timestamp_ntz")).scalar()
    return quality.run_history(runs.filter(F.col("run_at") < last), runs.filter(F.col("run_at") == last))


@check(
    "run_snapshot",
    f"""{_GOLDEN} SELECT count(*) AS rows, CAST(sum(id_count) AS BIGINT) AS ids,
      CAST(greatest(0, sum(id_count) - count(*)) AS BIGINT) AS merged,
      (SELECT count(*) FROM {{customer}} WHERE c_acctbal > 5000) AS billings FROM golden_customers""",
)
def run_snapshot(t):
    """VAL10."""
    parties = t["parties"]
    return quality.snapshot(
        customers.golden_customers(parties), customers.customer_keys(parties), _billing_frames(t)[1]
    )


@check(
    "reconcile_arrays",
    f"""{_GOLDEN} SELECT 'customers' AS step, (SELECT count(*) FROM {{parties}}) AS source_count,
      CAST(sum(id_count) AS BIGINT) AS target_count,
      CAST((SELECT count(*) FROM {{parties}}) - sum(id_count) AS BIGINT) AS diff,
      (SELECT count(*) FROM {{parties}}) = sum(id_count) AS ok FROM golden_customers""",
)
def reconcile_arrays(t):
    """VAL2: golden customers reconcile on summed array sizes."""
    chunks = golden.chunked_ids(customers.customer_keys(t["parties"]))
    return quality.reconcile(
        {
            "customers": (
                quality.count_rows(t["parties"]), quality.count_array_ids(chunks, "legacy_ids"),
            )
        }
    )


@check(
    "empty_groups",
    f"""{_GOLDEN} SELECT id FROM golden_customers WHERE id NOT IN (
      SELECT {r.key('customer', 'merge_key')} FROM keyed_parties WHERE record_id % 3 <> 0)""",
)
def empty_groups(t):
    """ARR4: golden records none of whose ids is in a reduced key map."""
    reduced = customers.customer_keys(t["parties"]).filter("legacy_id % 3 <> 0")
    return golden.broken_groups(customers.golden_customers(t["parties"]).select("id"), reduced)


@check(
    "role_choice",
    "SELECT (SELECT max(id) FROM {roles} WHERE id = 'role-asia') AS role_id, user_id "
    "FROM (SELECT DISTINCT user_id FROM {events}) x",
)
def role_choice(t):
    """SET5 for roles: the preferred role is missing, the default one exists."""
    everyone = t["events"].select(F.col("user_id").alias("id")).distinct()
    return users.user_roles(everyone, t["roles"], "role-none", "role-asia").select(
        "role_id", F.col("user_id").cast("bigint").alias("user_id")
    )


@check(
    "summed_conditions",
    """SELECT count(*) AS rows, count(*) FILTER (l_discount > 0) AS discounted,
      count(*) FILTER (l_tax > 0) AS taxed, count(*) FILTER (l_returnflag = 'R') AS returned
    FROM {lineitem}""",
)
def summed_conditions(t):
    """AGG7 over the lines."""
    return rollup.count_when(
        t["lineitem"],
        {
            "discounted": F.col("l_discount") > 0,
            "taxed": F.col("l_tax") > 0,
            "returned": F.col("l_returnflag") == "R",
        },
    )
