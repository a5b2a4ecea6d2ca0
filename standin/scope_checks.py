"""Checks of scope, roll-ups and key lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import codes, keys, text
from ledgerloom.operators import match, quality, rollup, scope
from ledgerloom.plans import contracts, scope_refresh, users
from ledgerloom.sources import sheet as sheets
from standin import rules as r
from standin.registry import PARAMS, check, scoped

V = f"WITH v AS ({r.SCOPED})"

SHEET_IDS = f"""SELECT DISTINCT CAST(id_orcamento AS BIGINT) AS contract_id FROM {{sheet}}
WHERE regexp_full_match(id_orcamento, '[0-9]+') AND {r.safe_bool('orcamento_ativo', 'TRUE')}"""
MARKED = f"{SHEET_IDS} AND {r.safe_bool('migrar', 'FALSE')}"


@check(
    "contract_rollup",
    f"""{V}
    SELECT v.contract_id, min(v.customer_id) AS customer_id, max(v.customer_name) AS customer_name,
      CAST(max(v.billing_day) AS DOUBLE) AS billing_day, CAST(max(v.due_day) AS DOUBLE) AS due_day,
      max(v.status) AS status, max(v.start_at) AS start_at,
      max(v.contract_created_at) AS contract_created_at,
      max(v.contract_updated_at) AS contract_updated_at, max(v.store_id) AS store_id,
      max(v.brand_id) AS brand_id, max(v.chain_id) AS chain_id, max(v.notice_at) AS notice_at,
      max(o.billing_mode) AS billing_mode, max(o.operation) AS operation,
      max(o.thirteenth_rule) AS thirteenth_rule, max(o.trade_marketing) AS trade_marketing
    FROM v JOIN {{contract_master}} o ON o.contract_id = v.contract_id GROUP BY v.contract_id""",
)
def contract_rollup(t):
    rolled = rollup.contract_rollup(scoped(t), t["contract_master"])
    return rolled.withColumns(
        {c: F.col(c).cast("double") for c in ("billing_day", "due_day")}
    )


def _dimensions_sql(source: str) -> str:
    return " UNION ".join(
        f"SELECT '{name}' AS dimension, CAST({column} AS BIGINT) AS id FROM {source} "
        f"WHERE {column} IS NOT NULL"
        for name, column in scope.DIMENSIONS.items()
    )


@check("scope_ids", f"{V} {_dimensions_sql('v')}")
def scope_ids(t):
    return scope.scope_ids(scoped(t))


_CHANNELS = """SELECT DISTINCT 'IdCanalEstabelecimento' AS dimension, channel_id AS id
FROM {store_records} WHERE channel_id IS NOT NULL AND id IN (SELECT store_id FROM v)"""


@check(
    "scope_refresh",
    f"""{V}, named AS (
      SELECT DISTINCT s.id FROM v JOIN {{segments}} s
        ON replace(trim(coalesce(v.segment_names, '')), ' ', '') = replace(trim(s.name), ' ', '')
      WHERE {r.filled('v.segment_names')})
    {_dimensions_sql('v')} UNION ALL {_CHANNELS}
    UNION ALL SELECT 'IdSegmentoProduto', id FROM named""",
)
def refresh(t):
    """PIP28 with AGG15, JOI7 and FIL13."""
    return scope_refresh.refresh(
        t["contract_lines"], t["contract_master"], t["store_records"], t["segments"],
        t["parties"], PARAMS,
    )


@check(
    "scope_dependencies",
    f"""WITH ids AS ({MARKED}),
    v AS (SELECT * FROM {{contract_lines}} WHERE contract_id IN (SELECT contract_id FROM ids))
    SELECT 'IdOrcamento' AS dimension, contract_id AS id FROM ids
    UNION ALL SELECT * FROM ({_dimensions_sql('v')}) d WHERE dimension <> 'IdOrcamento'
    UNION ALL {_CHANNELS}""",
)
def dependencies(t):
    """PIP29 and SNK3: a sheet scope of contracts completed with its dependent dimensions."""
    empty = t["contract_lines"].select(F.lit("").alias("dimension"), F.lit(0).alias("id")).limit(0)
    saved = scope.merge_scope(empty, sheets.marked_contracts(t["sheet"]), reset_dependent=True)
    return scope_refresh.fill_dependencies(saved, t["contract_lines"], t["store_records"])


@check(
    "scope_counts",
    f"""{V}, base AS (SELECT DISTINCT contract_id, customer_id, store_id, brand_id, chain_id FROM v)
    SELECT count(*) AS base_rows, count(DISTINCT contract_id) AS contract_id_count,
      count(DISTINCT customer_id) AS customer_id_count, count(DISTINCT store_id) AS store_id_count,
      count(DISTINCT brand_id) AS brand_id_count, count(DISTINCT chain_id) AS chain_id_count
    FROM base""",
)
def scope_counts(t):
    return scope.scope_counts(scoped(t))


@check(
    "scope_intersect",
    f"{V} SELECT contract_id FROM v INTERSECT {MARKED}",
)
def scope_intersect(t):
    """SET1 and SRC4."""
    return scope.intersect_sheet(scoped(t), sheets.marked_contracts(t["sheet"]))


@check(
    "billing_scope",
    f"""SELECT DISTINCT o_orderkey AS contract_id FROM {{orders}}
    WHERE o_orderstatus <> 'P' AND o_orderkey IN ({SHEET_IDS})""",
)
def billing_scope(t):
    """SET2 without a request: contracts the sheet lists that are already loaded."""
    loaded = t["orders"].filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("legacy_id"))
    return scope.billing_scope(None, sheets.sheet_terms(t["sheet"]), loaded)


@check(
    "scope_precedence",
    "SELECT DISTINCT doc_id AS contract_id FROM {labels} WHERE quality = 1",
)
def scope_precedence(t):
    """SET5: no saved ids, so the requested ids go before everything."""
    saved = t["labels"].filter("quality > 1").select(F.col("doc_id").alias("contract_id"))
    requested = t["labels"].filter("quality = 1").select(F.col("doc_id").alias("contract_id"))
    everything = t["orders"].select(F.col("o_orderkey").alias("contract_id"))
    return scope.precedence([saved, requested, everything], "contract_id")


@check(
    "first_source_with_rows",
    f"{V} SELECT DISTINCT chain_id FROM v WHERE chain_id IS NOT NULL",
)
def first_source(t):
    """FIL13: a source without the column and an empty one are passed over."""
    lines = scoped(t)
    return scope.first_source(
        [lines.drop("chain_id"), lines.filter("chain_id < 0"), lines], "chain_id"
    )


@check(
    "limit_sample",
    f"{V} SELECT DISTINCT contract_id FROM v ORDER BY contract_id LIMIT 100",
)
def limit_sample(t):
    limited = scope.ScopeParams(limit=100)
    return scope.sample(scoped(t).select("contract_id").distinct(), limited, "contract_id")


@check(
    "count_sampled_ids",
    f"""{V} SELECT count(*) AS ids FROM
    (SELECT DISTINCT customer_id FROM v ORDER BY customer_id LIMIT 250) x""",
)
def count_sampled(t):
    """AGG8 over an ordered, limited id list."""
    return rollup.count_ids(scoped(t), "customer_id", 250)


@check(
    "scenario_rollup",
    f"""{V} SELECT contract_id, frequency, hours, CAST(price AS DOUBLE) AS price, task_name,
      customer_name, status, task_id, customer_id,
      CAST(max(CAST(start_at AS DATE)) AS VARCHAR) AS start_day,
      CAST(max(CAST(notice_at AS DATE)) AS VARCHAR) AS notice_day,
      max(line_created_at) AS line_created_at, max(line_updated_at) AS line_updated_at
    FROM v WHERE customer_id IS NOT NULL
    GROUP BY contract_id, frequency, hours, v.price, task_name, customer_name, status, task_id,
      customer_id""",
)
def scenario_rollup(t):
    return rollup.scenario_rollup(scoped(t))


_RATE = r.rate("price", "frequency", "hours")


@check(
    "scenario_by_day",
    f"""{V}, d AS (SELECT *, {_RATE} AS rate0, CAST(start_at AS DATE) AS sd,
        CAST(notice_at AS DATE) AS nd FROM v)
    SELECT contract_id, frequency, hours, CAST(rate0 AS DOUBLE) AS rate,
      CAST(sd AS VARCHAR) AS start_day, CAST(nd AS VARCHAR) AS notice_day,
      max(task_name) AS task_name, max(customer_name) AS customer_name, max(status) AS status,
      max(line_created_at) AS line_created_at, max(line_updated_at) AS line_updated_at,
      max(task_id) AS task_id, max(customer_id) AS customer_id, count(*) AS stores
    FROM d GROUP BY contract_id, frequency, hours, rate0, sd, nd""",
)
def scenario_by_day(t):
    """AGG3 and NUM1."""
    return rollup.scenario_by_day(
        contracts.with_line_numbers(scoped(t)), contracts.line_rate()
    )


@check(
    "scenario_count",
    f"""{V} SELECT count(DISTINCT concat_ws('|', contract_id, coalesce(frequency, ''),
      coalesce(hours, ''), {_RATE})) AS scenarios FROM v""",
)
def scenario_count(t):
    """AGG4 and AGG6."""
    key = rollup.composite_key(
        F.col("contract_id"), F.col("frequency"), F.col("hours"), contracts.line_rate()
    )
    lines = contracts.with_line_numbers(scoped(t))
    return rollup.count_groups(lines, [key.alias("key")], "scenarios")


FIRST_SCENARIOS = r.first_rows(
    "SELECT * REPLACE (coalesce(price, CAST(0 AS DECIMAL(18,2))) AS price) FROM rolled",
    "contract_id, frequency, hours, price",
    ", ".join(
        f"{c} NULLS FIRST"
        for c in (
            "task_name", "customer_name", "status", "task_id", "customer_id", "start_day",
            "notice_day", "line_created_at", "line_updated_at",
        )
    ),
)

ROLLED = """rolled AS (
  SELECT contract_id, frequency, hours, price, task_name, customer_name, status, task_id,
    customer_id, max(CAST(start_at AS DATE)) AS start_day, max(CAST(notice_at AS DATE))
    AS notice_day, max(line_created_at) AS line_created_at, max(line_updated_at) AS line_updated_at
  FROM v WHERE customer_id IS NOT NULL
  GROUP BY contract_id, frequency, hours, price, task_name, customer_name, status, task_id,
    customer_id)"""

SCENARIO_ID = r.key("scenario", "contract_id", "frequency", "hours", "price")

KEYED_SCENARIOS = f"""{ROLLED}, first_scenarios AS ({FIRST_SCENARIOS}),
scenarios AS (
  SELECT *, {SCENARIO_ID} AS scenario_id, {r.frequency_key('frequency')} AS frequency_key,
    {r.hours_key('hours')} AS hours_key, {_RATE} AS rate_key,
    {r.frequency_label('frequency')} AS label
  FROM first_scenarios)"""

SCENARIO_KEYS = """scenario_keys AS (
  SELECT contract_id, frequency_key, hours_key, rate_key,
    arg_min(scenario_id, lpad(CAST(price AS VARCHAR), 25, '0') || scenario_id) AS scenario_id,
    arg_min(label, lpad(CAST(price AS VARCHAR), 25, '0') || scenario_id) AS label
  FROM scenarios GROUP BY contract_id, frequency_key, hours_key, rate_key)"""

LINE_KEYS = f"""lines_keyed AS (
  SELECT *, {r.frequency_key('frequency')} AS frequency_key, {r.hours_key('hours')} AS hours_key,
    {_RATE} AS rate_key FROM v WHERE customer_id IS NOT NULL)"""


@check(
    "scenario_dedup",
    f"""{V}, {KEYED_SCENARIOS}
    SELECT contract_id AS contract_legacy_id, scenario_id, label AS frequency,
      {r.comma_number('hours')} AS hours, CAST(rate_key AS DOUBLE) AS rate,
      coalesce({r.comma_number('hours')} * CAST(rate_key AS DOUBLE), 0.0) AS expected_amount,
      CASE WHEN coalesce(status, 0) IN (0, 11) THEN 0 ELSE 1 END AS status,
      frequency_key, hours_key FROM scenarios""",
)
def scenario_dedup(t):
    """WIN1 with NUM1 to NUM7 and BOO3."""
    hours = F.col("hours_number")
    return contracts.distinct_scenarios(scoped(t)).select(
        "contract_legacy_id",
        "scenario_id",
        codes.frequency_label(F.col("frequency_number")).alias("frequency"),
        hours.alias("hours"),
        F.col("rate_key").alias("rate"),
        codes.expected_amount(hours, F.col("rate_key")).alias("expected_amount"),
        codes.scenario_status(F.col("status")).alias("status"),
        "frequency_key",
        "hours_key",
    )


def _key_map(t):
    scenarios = contracts.distinct_scenarios(scoped(t)).withColumn(
        "frequency_label", codes.frequency_label(F.col("frequency_number"))
    )
    return contracts.scenario_key_map(scenarios)


@check(
    "scenario_store_join",
    f"""{V}, {KEYED_SCENARIOS}, {SCENARIO_KEYS}, {LINE_KEYS}
    SELECT k.scenario_id, count(*) AS stores, count(f.line_id) AS flagged
    FROM lines_keyed l JOIN scenario_keys k USING (contract_id, frequency_key, hours_key, rate_key)
    LEFT JOIN {{line_flags}} f ON f.line_id = l.line_id GROUP BY k.scenario_id""",
)
def scenario_store_join(t):
    """JOI5 and JOI2."""
    lines = contracts.keyed_lines(t["contract_lines"], PARAMS).withColumnRenamed(
        "contract_id", "contract_legacy_id"
    )
    linked = lines.join(_key_map(t).drop("frequency"), list(contracts.SCENARIO_KEY))
    flags = t["line_flags"].select("line_id", F.lit(1).alias("flag"))
    return (
        match.left_lookup(linked, flags, ["line_id"])
        .groupBy("scenario_id")
        .agg(F.count("*").alias("stores"), F.count("flag").alias("flagged"))
    )


def _fits_sql(label: str, frequency_key: str) -> str:
    whens = " ".join(
        f"WHEN '{name}' THEN {frequency_key} IN ({', '.join(map(r.quoted, texts))})"
        for name, texts in codes.FREQUENCY_TEXTS.items()
    )
    return f"(CASE {label} {whens} ELSE {frequency_key} = {label} END)"


FITS = _fits_sql("k.label", "l.frequency_key")


@check(
    "scenario_rejects",
    f"""{V}, {KEYED_SCENARIOS}, {SCENARIO_KEYS}, {LINE_KEYS},
    reduced AS (SELECT * FROM scenario_keys WHERE contract_id % 5 <> 0),
    known AS (SELECT id AS store_id FROM {{store_records}} WHERE channel_id IS NOT NULL),
    found AS (
      SELECT l.line_id, l.contract_id, l.store_id, l.frequency_key, l.hours_key,
        CAST(l.rate_key AS DOUBLE) AS rate_key,
        CASE WHEN k.scenario_id IS NULL THEN 'missing scenario'
          WHEN NOT {FITS} THEN 'incompatible scenario'
          WHEN s.store_id IS NULL THEN 'missing store' END AS reason
      FROM lines_keyed l
      LEFT JOIN reduced k USING (contract_id, frequency_key, hours_key, rate_key)
      LEFT JOIN known s ON s.store_id = l.store_id)
    SELECT * FROM found WHERE reason IS NOT NULL""",
)
def scenario_rejects(t):
    """JOI6, VAL5 and VAL9 against scenarios and stores of which some were not loaded."""
    loaded = _key_map(t).filter("contract_legacy_id % 5 <> 0")
    known = t["store_records"].filter("channel_id IS NOT NULL").select(
        F.col("id").alias("legacy_id")
    )
    return contracts.line_rejects(t["contract_lines"], loaded, known, PARAMS)


@check(
    "exact_scenario_lines",
    f"""{V}, {KEYED_SCENARIOS}, w AS (
      SELECT contract_id, frequency, {r.comma_number('hours')} AS hours_number,
        rate_key AS rate, start_day, notice_day FROM scenarios WHERE price > 50000)
    SELECT l.line_id, l.contract_id, CAST(l.rate AS DOUBLE) AS rate
    FROM (SELECT *, {_RATE} AS rate FROM v) l
    WHERE EXISTS (SELECT 1 FROM w WHERE w.contract_id = l.contract_id
      AND w.frequency = l.frequency AND w.hours_number = {r.comma_number('l.hours')}
      AND w.rate = l.rate AND w.start_day = CAST(l.start_at AS DATE)
      AND w.notice_day IS NOT DISTINCT FROM CAST(l.notice_at AS DATE))""",
)
def exact_matches(t):
    """FIL11: source lines of the dear scenarios, a missing notice date matching a missing one."""
    wanted = (
        contracts.distinct_scenarios(scoped(t))
        .filter("price > 50000")
        .select(
            F.col("contract_legacy_id").alias("contract_id"),
            "frequency",
            "hours_number",
            F.col("rate_key").alias("rate"),
            "start_day",
            "notice_day",
        )
    )
    lines = contracts.with_line_numbers(scoped(t)).withColumn("rate", contracts.line_rate())
    return scope.exact_matches(lines, wanted).select("line_id", "contract_id", "rate")


@check(
    "near_scenario_lines",
    f"""{V}, {KEYED_SCENARIOS}, missing AS (
      SELECT DISTINCT contract_id, frequency, start_day FROM scenarios WHERE price <= 50000)
    SELECT line_id, store_id, contract_id, frequency, CAST(sd AS VARCHAR) AS start_day FROM (
      SELECT l.*, row_number() OVER (PARTITION BY contract_id, frequency, sd
        ORDER BY line_id, status, customer_id, customer_name, system_name NULLS FIRST,
          store_client_id NULLS FIRST, store_client_name NULLS FIRST, billing_day NULLS FIRST,
          due_day NULLS FIRST, store_id) AS rn
      FROM (SELECT *, CAST(start_at AS DATE) AS sd FROM v) l
      WHERE (contract_id, frequency, sd) IN (SELECT contract_id, frequency, start_day FROM missing)) x
    WHERE rn <= 10""",
)
def near_matches(t):
    """FIL12: lines that resemble the cheap scenarios."""
    wanted = (
        contracts.distinct_scenarios(scoped(t))
        .filter("price <= 50000")
        .select(F.col("contract_legacy_id").alias("contract_id"), "frequency", "start_day")
    )
    return scope.near_matches(scoped(t), wanted).select(
        "line_id", "store_id", "contract_id", "frequency", "start_day"
    )


@check(
    "latest_rows",
    """SELECT o_orderkey, o_orderdate FROM {orders}
    ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 100""",
)
def latest_rows(t):
    """WIN4."""
    return match.latest(t["orders"].select("o_orderkey", "o_orderdate"), "o_orderdate", "o_orderkey", 100)


@check(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM {lineitem}
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    ORDER BY rows DESC, l_orderkey, l_linenumber LIMIT 10""",
)
def duplicate_keys(t):
    return rollup.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])


@check(
    "key_range",
    """SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key,
    count(DISTINCT o_orderkey) AS keys FROM {orders}""",
)
def key_range(t):
    return rollup.key_range(t["orders"], "o_orderkey")


@check(
    "coverage",
    """SELECT count(*) AS rows, count(l.doc_id) AS labelled,
    count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic_rows,
    count(*) FILTER (d.text IS NOT NULL AND d.text <> '') AS with_text
    FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
)
def coverage(t):
    """AGG11."""
    marked = t["labels"].withColumn("labelled", F.lit(True))
    joined = match.left_lookup(t["documents"].select("doc_id", "text"), marked, ["doc_id"])
    return rollup.count_when(
        joined,
        {
            "labelled": F.col("labelled"),
            "good": F.col("quality") == 1,
            "toxic_rows": F.col("toxic") == 1,
            "with_text": F.col("text") != "",
        },
    )


@check(
    "brand_store_pairs",
    """SELECT brand_id, channel_id FROM {store_records}
    WHERE brand_id IS NOT NULL AND channel_id IS NOT NULL GROUP BY brand_id, channel_id""",
)
def brand_store_pairs(t):
    """AGG13."""
    return rollup.distinct_pairs(t["store_records"], "brand_id", "channel_id")


@check(
    "segment_text_join",
    f"""SELECT DISTINCT s.id AS segment_id FROM {{contract_lines}} v JOIN {{segments}} s
      ON replace(trim(coalesce(v.segment_names, '')), ' ', '') = replace(trim(s.name), ' ', '')
    WHERE {r.filled('v.segment_names')}""",
)
def segment_text_join(t):
    return match.segments_by_name(t["contract_lines"], t["segments"])


@check(
    "segments_of_contracts",
    f"""{V} SELECT DISTINCT thirteenth_rule AS segment_id FROM {{contract_master}}
    WHERE contract_id IN (SELECT contract_id FROM v)""",
)
def segments_of_contracts(t):
    """JOI19 with a contract attribute in the part of the segment."""
    master = t["contract_master"].withColumnRenamed("thirteenth_rule", "segment_id")
    return match.segments_through(scoped(t), master, "contract_id")


PLACES = f"""SELECT st, ci, min(code) AS code FROM (
  SELECT {r.fold_name('state')} AS st, {r.fold_name('city')} AS ci, {r.place_code('code')} AS code
  FROM {{places}}) p WHERE code > 0 AND st <> '' AND ci <> '' GROUP BY st, ci"""


def placed(own: str, code: str) -> str:
    return f"coalesce(CASE WHEN {r.place_code(own)} > 0 THEN {r.place_code(own)} END, {code}, 0)"


@check(
    "place_lookup",
    f"""SELECT p.id, {placed('p.main_place_code', 'm.code')} AS municipal_code
    FROM {{parties}} p LEFT JOIN ({PLACES}) m
      ON m.st = {r.fold_name('p.main_state')} AND m.ci = {r.fold_name('p.main_city')}""",
)
def place_lookup(t):
    """JOI8 with STR11 and NUM9."""
    parties = t["parties"].select("id", "main_state", "main_city", "main_place_code")
    return match.add_place_code(
        parties, t["places"], "main_state", "main_city", "main_place_code", "municipal_code"
    ).select("id", "municipal_code")


@check(
    "brand_default_segment",
    """WITH c AS (SELECT brand_id, min(channel_id) AS channel_id FROM {store_records}
      WHERE brand_id IS NOT NULL AND channel_id IS NOT NULL GROUP BY brand_id)
    SELECT b.id AS brand_id, coalesce(s.name, 'none') AS segment FROM {brands} b
    LEFT JOIN c ON c.brand_id = b.id LEFT JOIN {channels} s ON s.id = c.channel_id""",
)
def brand_default_segment(t):
    """JOI10."""
    brands = t["brands"].select(F.col("id").alias("brand_id"))
    found = match.left_lookup(brands, match.brand_channels(t["store_records"]), ["brand_id"])
    names = t["channels"].select(F.col("id").alias("channel_id"), "name")
    return match.left_lookup(found, names, ["channel_id"]).select(
        "brand_id", F.coalesce("name", F.lit("none")).alias("segment")
    )


@check(
    "new_customer_ids",
    f"{V} SELECT c_custkey FROM {{customer}} WHERE c_custkey NOT IN (SELECT customer_id FROM v)",
)
def new_customer_ids(t):
    """JOI12."""
    seen = scoped(t).select(F.col("customer_id").alias("c_custkey"))
    return match.without(t["customer"], seen, ["c_custkey"]).select("c_custkey")


@check(
    "customers_in_scope",
    f"""{V} SELECT c_custkey, c_name FROM {{customer}}
    WHERE c_custkey IN (SELECT customer_id FROM v)""",
)
def customers_in_scope(t):
    """JOI11 and FIL5."""
    seen = scoped(t).select(F.col("customer_id").alias("c_custkey"))
    return match.within(t["customer"].select("c_custkey", "c_name"), seen, ["c_custkey"])


@check(
    "person_attached",
    """SELECT o_orderkey, (SELECT min(id) FROM {people}) AS person_id FROM {orders}""",
)
def person_attached(t):
    """JOI15."""
    return match.attach_one(t["orders"].select("o_orderkey"), t["people"], "id", "person_id")


SHEET_TERMS = r.first_rows(
    f"""SELECT CAST(id_orcamento AS BIGINT) AS contract_id, sheet_row, nome_cliente AS sheet_name,
      {r.whole('dia_faturamento')} AS sheet_billing_day, {r.whole('dia_vencimento')} AS sheet_due_day,
      contract_parameters_billing_type AS sheet_billing_type,
      contract_parameters_thirteenth_salary_type AS sheet_thirteenth_type,
      tipo_fat_descricao AS sheet_calculation,
      {r.safe_bool('orcamento_ativo', 'TRUE')} AS sheet_active,
      CASE WHEN upper({r.strip('farmer_login_user')}) <> '#TBD'
        THEN nullif({r.strip('farmer_login_user')}, '') END AS farmer_login,
      CASE WHEN upper({r.strip('hunter_login_user')}) <> '#TBD'
        THEN nullif({r.strip('hunter_login_user')}, '') END AS hunter_login
    FROM {{sheet}} WHERE regexp_full_match(id_orcamento, '[0-9]+')
      AND {r.safe_bool('orcamento_ativo', 'TRUE')}""",
    "contract_id",
    "sheet_row",
)


@check(
    "sheet_terms",
    f"""SELECT * EXCLUDE (sheet_row) REPLACE (CAST(sheet_billing_day AS DOUBLE) AS
      sheet_billing_day, CAST(sheet_due_day AS DOUBLE) AS sheet_due_day) FROM ({SHEET_TERMS}) s""",
)
def sheet_terms(t):
    """SRC3 with FIL9, STR17, STR18 and NUM12; the header row is the one of an exported sheet."""
    names = {
        "id_orcamento": "ID\nORÇAMENTO:", "migrar": " Migrar ", "orcamento_ativo": "Orcamento  Ativo",
        "nome_cliente": "Nome Cliente", "dia_faturamento": "DIA_FATURAMENTO",
        "dia_vencimento": "Dia\r\nVencimento:", "tipo_fat_descricao": "Tipo fat\nDescrição",
        "farmer_login_user": "Farmer (Login User)", "hunter_login_user": "-Hunter (Login User)",
    }
    raw = t["sheet"].withColumnsRenamed(names)
    terms = sheets.sheet_terms(sheets.headers.with_clean_headers(raw))
    return terms.withColumns(
        {c: F.col(c).cast("double") for c in ("sheet_billing_day", "sheet_due_day")}
    )


@check(
    "sheet_enrich",
    f"""WITH s AS ({SHEET_TERMS}), o AS (
      SELECT contract_id, max(billing_day) AS billing_day FROM {{contract_lines}} GROUP BY 1)
    SELECT o.contract_id, s.contract_id IS NOT NULL AS has_sheet,
      coalesce(CASE WHEN s.contract_id IS NOT NULL THEN s.sheet_billing_day ELSE o.billing_day END,
        1) AS day,
      {r.snake('s.sheet_billing_type', 'current')} AS billing_type
    FROM o LEFT JOIN s ON s.contract_id = o.contract_id""",
)
def sheet_enrich(t):
    """JOI16 and STR15."""
    days = t["contract_lines"].groupBy("contract_id").agg(F.max("billing_day").alias("billing_day"))
    found = contracts.enrich_from_sheet(days, sheets.sheet_terms(t["sheet"]))
    return found.select(
        "contract_id",
        "has_sheet",
        contracts.sheet_or_lines(F.col("sheet_billing_day"), F.col("billing_day"), 1).alias("day"),
        text.snake_case(F.col("sheet_billing_type"), codes.BILLING_TYPE).alias("billing_type"),
    )


LOGINS = f"""SELECT k, min(id) AS id FROM (
  SELECT id, unnest([lower({r.strip('user_name')}), lower({r.strip('normalized_user_name')}),
    lower({r.strip('email')})]) AS k FROM us) x WHERE k <> '' GROUP BY k"""

USERS = f"""SELECT {r.key('user', 'id')} AS id, id AS legacy_id, {r.clean('name')} AS name,
  {r.clean('login', 256)} AS user_name, upper({r.clean('login', 256)}) AS normalized_user_name,
  {r.clean('email', 256)} AS email, lower({r.clean('email', 256)}) AS normalized_email,
  {r.clean('phone')} AS phone_number,
  CASE WHEN active THEN 'active' ELSE 'inactive' END AS status, created_at,
  coalesce(updated_at, created_at) AS updated_at
FROM {{source_users}} WHERE {r.clean('name')} IS NOT NULL"""


def _padded(d: str) -> str:
    return (
        f"(CASE WHEN {d} = '' THEN NULL WHEN length({d}) <= 11 THEN lpad({d}, 11, '0') "
        f"WHEN length({d}) <= 14 THEN lpad({d}, 14, '0') ELSE {d} END)"
    )


NATIONAL_IDS = f"""SELECT k, arg_min(uid, lid) AS id FROM (
  SELECT {_padded(r.digits('s.national_id'))} AS k, u.id AS uid, s.id AS lid
  FROM {{source_users}} s JOIN us u ON u.legacy_id = s.id) x WHERE k IS NOT NULL GROUP BY k"""


def user_of(login: str) -> str:
    """Scalar lookups of a login in the two key tables ``logins`` and ``nationals``."""
    d = r.digits(login)
    return (
        f"coalesce((SELECT id FROM logins WHERE k = lower({r.strip(login)})), "
        f"(SELECT id FROM nationals WHERE length({d}) >= 10 AND k = {_padded(d)}))"
    )


LOOKUPS = f"us AS ({USERS}), logins AS ({LOGINS}), nationals AS ({NATIONAL_IDS})"


@check(
    "person_lookup",
    f"""WITH {LOOKUPS}
    SELECT id_orcamento, sheet_row, {user_of('farmer_login_user')} AS user_id FROM {{sheet}}""",
)
def person_lookup(t):
    """JOI9, WIN2 and STR4."""
    loaded = users.users(t["source_users"])
    return match.add_user_by_login(
        t["sheet"].select("id_orcamento", "sheet_row", "farmer_login_user"),
        "farmer_login_user",
        "user_id",
        match.login_keys(loaded),
        match.national_id_keys(t["source_users"], loaded),
    ).select("id_orcamento", "sheet_row", "user_id")


@check(
    "orphans",
    """SELECT 'part' AS parent, l_orderkey, l_linenumber, l_partkey AS parent_key FROM {lineitem}
    WHERE l_partkey NOT IN (SELECT p_partkey FROM {part} WHERE p_type <> 'PROMO')
    UNION ALL SELECT 'order', l_orderkey, l_linenumber, l_orderkey FROM {lineitem}
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {orders} WHERE o_orderstatus <> 'P')
    UNION ALL SELECT 'supplier', l_orderkey, l_linenumber, l_suppkey FROM {lineitem}
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM {supplier} WHERE s_acctbal > 0)""",
)
def orphans(t):
    """JOI14 against parent tables that lack some rows."""
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parents = {
        "part": (t["part"].filter("p_type <> 'PROMO'"), "p_partkey", "l_partkey"),
        "order": (t["orders"].filter("o_orderstatus <> 'P'"), "o_orderkey", "l_orderkey"),
        "supplier": (t["supplier"].filter("s_acctbal > 0"), "s_suppkey", "l_suppkey"),
    }
    found = None
    for name, (parent, key, child_key) in parents.items():
        missing = match.without(lines, parent.select(F.col(key).alias(child_key)), [child_key])
        rows = missing.select(
            F.lit(name).alias("parent"), "l_orderkey", "l_linenumber",
            F.col(child_key).alias("parent_key"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


@check(
    "supplier_brands",
    """SELECT DISTINCT l_suppkey, p_brand FROM {lineitem} JOIN {part} ON p_partkey = l_partkey""",
)
def supplier_brands(t):
    """JOI13."""
    return match.junction(
        t["lineitem"].withColumnRenamed("l_partkey", "p_partkey"), t["part"], "p_partkey",
        ["l_suppkey", "p_brand"],
    )


@check(
    "count_children",
    """SELECT count(*) AS rows FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey
    WHERE o_orderpriority = '1-URGENT'""",
)
def count_children(t):
    """JOI18."""
    parents = t["orders"].filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("id")
    )
    return match.count_descendants(parents, t["lineitem"], "l_orderkey")


@check(
    "stores_with_names",
    """SELECT v.line_id, v.store_id, CASE WHEN s.brand_id IS NOT NULL THEN s.name END AS store_name
    FROM {contract_lines} v LEFT JOIN {store_records} s ON s.id = v.store_id""",
)
def stores_with_names(t):
    """JOI17."""
    known = t["store_records"].filter("brand_id IS NOT NULL").select("id", "name")
    lines = t["contract_lines"].select("line_id", "store_id")
    return match.stores_of_scenarios(lines, known).select("line_id", "store_id", "store_name")


@check(
    "missing_keys",
    f"""{V} SELECT 'missing store' AS reason, CAST(store_id AS VARCHAR) AS legacy_key FROM v
    WHERE store_id NOT IN (SELECT id FROM {{store_records}} WHERE brand_id IS NOT NULL)
    GROUP BY store_id
    UNION ALL SELECT 'missing customer', CAST(customer_id AS VARCHAR) FROM v
    WHERE customer_id NOT IN (SELECT id FROM {{parties}} WHERE code IS NOT NULL)
    GROUP BY customer_id""",
)
def missing_keys(t):
    """VAL9: legacy keys of the lines that were not loaded."""
    def loaded(name, column):
        kept = t[name].filter(f"{column} IS NOT NULL")
        return kept.select(F.col("id").alias("legacy_id"), keys.surrogate_key(name, F.col("id")).alias("id"))

    lines = scoped(t)
    return match.unmapped(
        lines, loaded("store_records", "brand_id"), "store_id", "missing store"
    ).unionByName(
        match.unmapped(lines, loaded("parties", "code"), "customer_id", "missing customer")
    )


@check(
    "count_steps",
    f"""{V}, s AS (SELECT count(DISTINCT contract_id) AS a, count(DISTINCT customer_id) AS b,
        count(*) AS c FROM v),
      o AS (SELECT count(*) AS a, count(DISTINCT o_custkey) AS b FROM {{orders}}),
      l AS (SELECT count(*) AS c FROM {{lineitem}}),
      x AS (SELECT 'contracts' AS step, s.a AS source_count, o.a AS target_count FROM s, o
        UNION ALL SELECT 'customers', s.b, o.b FROM s, o
        UNION ALL SELECT 'lines', s.c, l.c FROM s, l
        UNION ALL SELECT 'same', s.c, s.c FROM s)
    SELECT *, source_count - target_count AS diff, source_count = target_count AS ok FROM x""",
)
def reconcile_counts(t):
    """VAL1."""
    lines, orders, count = scoped(t), t["orders"], quality.count_rows
    return quality.reconcile(
        {
            "contracts": (rollup.count_ids(lines, "contract_id"), count(orders)),
            "customers": (
                rollup.count_ids(lines, "customer_id"), rollup.count_ids(orders, "o_custkey"),
            ),
            "lines": (count(lines), count(t["lineitem"])),
            "same": (count(lines), count(lines)),
        }
    )
