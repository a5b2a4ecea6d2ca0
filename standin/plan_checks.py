"""Checks of the pipelines: every target table against SQL written from the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import codes
from ledgerloom.operators import load, match, quality
from ledgerloom.operators.scope import billing_scope
from ledgerloom.plans import billing, contracts, customers, legacy_clients, stores, users
from ledgerloom.session import staged
from ledgerloom.sources import sheet as sheets
from standin import record_checks as records
from standin import rules as r
from standin import scope_checks as scopes
from standin.registry import PARAMS, check, scoped, shared
from standin.store_checks import folder_of

V = scopes.V
UPDATED = "coalesce(updated_at, created_at) AS updated_at"
NOW = f"{r.NOW} AS created_at, {r.NOW} AS updated_at"

# Customers.

WANTED = f"""{V}, wanted_parties AS (
  SELECT * FROM {{parties}} WHERE id IN (SELECT customer_id FROM v)), {records.GOLDEN},
ckeys AS (SELECT record_id AS legacy_id, {r.key('customer', 'merge_key')} AS id FROM keyed_parties)"""


@shared
def wanted_customers(t):
    return customers.customer_scope(t["contract_lines"], PARAMS)


@shared
def customer_keys(t):
    return customers.customer_keys(t["parties"], wanted_customers(t))


def segment_sql(table: str, entity: str, cut: int | None, where: str) -> str:
    return f"""SELECT {r.key(entity, 'id')} AS id, {r.clean('name', cut)} AS name,
      coalesce(active, FALSE) AS is_active, created_at, {UPDATED}, id AS legacy_id
    FROM {table} WHERE {r.clean('name')} IS NOT NULL AND {where}"""


@check("customer_segments", segment_sql("{segments}", "customer_segment", 255, "TRUE"))
def customer_segments(t):
    """PIP1."""
    return customers.customer_segments(t["segments"])


@check(
    "customers",
    f"""{WANTED} SELECT id, tax_id AS cnpj, tax_id_status AS cnpj_status,
      state_registration, municipal_registration, legal_name, trade_name, FALSE AS simple_opt,
      status, created_at, updated_at, code FROM golden_customers""",
)
def golden_customers(t):
    """PIP2."""
    return customers.customers(t["parties"], wanted_customers(t))


def _address_rows(source: str, prefix: str, kind: str, position: bool, code: str) -> str:
    extra = (
        f"owner_id, id AS legacy_id, created_at, updated_at, {code} AS own_code, "
        f"{r.fold_name(prefix + 'state')} AS st, {r.fold_name(prefix + 'city')} AS ci"
    )
    return records.address_sql(source, prefix, kind, position, extra)


def address_table(rows: str, owner: str) -> str:
    first = r.first_rows(rows, "owner_id, type", "legacy_id")
    own = "CASE WHEN a.own_code > 0 THEN a.own_code END"
    return f"""SELECT {r.key('address', f"'{owner}'", 'a.owner_id', 'a.type')} AS id, a.legacy_id,
      a.owner_id AS addressable_id, '{owner}' AS addressable_type, a.type, a.postal_code, a.street,
      a.number, a.address_line_2, a.neighborhood, a.city, a.state,
      coalesce({own}, p.code, 0) AS municipal_code, a.latitude, a.longitude, a.zone, a.region,
      a.created_at, coalesce(a.updated_at, a.created_at) AS updated_at
    FROM ({first}) a LEFT JOIN ({scopes.PLACES}) p ON p.st = a.st AND p.ci = a.ci"""


_OWNED = "owned AS (SELECT p.*, k.id AS owner_id FROM {parties} p JOIN ckeys k ON k.legacy_id = p.id)"
_OWNED_ADDRESSES = " UNION ALL ".join(
    _address_rows("owned", prefix, kind, kind == "main", r.place_code(f"{prefix}place_code"))
    for prefix, kind in customers.ADDRESS_GROUPS.items()
)


@check("customer_addresses", f"{WANTED}, {_OWNED} {address_table(_OWNED_ADDRESSES, 'Customer')}")
def customer_addresses(t):
    """PIP3."""
    return customers.addresses(t["parties"], customer_keys(t), t["places"])


def contact_table(source: str, owner: str) -> str:
    parts = []
    for column in ("email", "phone", "cellphone"):
        value = f"lower({r.strip(column)})" if column == "email" else r.digits(column)
        parts.append(
            f"SELECT {r.key('contact', f"'{owner}'", 'id', f"'{column}'")} AS id, "
            f"owner_id AS contactable_id, '{owner}' AS contactable_type, '{column}' AS type, "
            f"{value} AS value, created_at, {UPDATED} FROM {source} WHERE {value} <> ''"
        )
    return " UNION ALL ".join(parts)


@check("customer_contacts", f"{WANTED}, {_OWNED} {contact_table('owned', 'Customer')}")
def customer_contacts(t):
    """PIP4."""
    return customers.contacts(t["parties"], customer_keys(t))


BRANDS = f"""cbrands AS (SELECT DISTINCT substr({r.strip('customer_name')}, 1, 255) AS name FROM v
  WHERE {r.filled('customer_name')})"""


@shared
def brand_rows(t):
    segments = customers.customer_segments(t["segments"])
    return customers.customer_brands(t["contract_lines"], segments, PARAMS, r.RUN_TS)


@check(
    "customer_brands",
    f"""{V}, {BRANDS} SELECT {r.key('customer_brand', 'name')} AS id, name,
      (SELECT {r.key('customer_segment', 'min(id)')} FROM {{segments}}) AS customer_segment_id,
      TRUE AS is_active, {NOW} FROM cbrands""",
)
def customer_brands(t):
    """PIP5."""
    return brand_rows(t)


PAIRS = f"""pairs AS (SELECT DISTINCT k.id AS customer_id,
    {r.key('customer_brand', r.strip('v.customer_name'))} AS customer_brand_id
  FROM v JOIN ckeys k ON k.legacy_id = v.customer_id WHERE {r.filled('v.customer_name')})"""


@shared
def brand_pairs(t):
    return customers.customer_customer_brand(
        t["contract_lines"], customer_keys(t), brand_rows(t), PARAMS
    )


@check("customer_customer_brand", f"{WANTED}, {PAIRS} SELECT * FROM pairs")
def customer_customer_brand(t):
    """PIP6."""
    return brand_pairs(t)


# Stores.


def wanted_ids(t, column: str):
    return scoped(t).select(F.col(column).alias("id")).filter(F.col("id").isNotNull()).distinct()


_CHANNELS = """id IN (SELECT channel_id FROM {store_records}
  WHERE id IN (SELECT store_id FROM v))"""


@shared
def segment_rows(t):
    records_in_scope = match.within(t["store_records"], wanted_ids(t, "store_id"), ["id"])
    channels = records_in_scope.filter("channel_id IS NOT NULL").select("channel_id").distinct()
    return stores.store_segments(t["channels"], channels)


@check("store_segments", f"{V} {segment_sql('{channels}', 'store_segment', None, _CHANNELS)}")
def store_segments(t):
    """PIP7."""
    return segment_rows(t)


@shared
def chain_rows(t):
    return stores.retail_chains(t["chains"], wanted_ids(t, "chain_id"))


CHAINS = f"""SELECT {r.key('retail_chain', 'id')} AS id, {r.clean('name')} AS name,
  coalesce(code, '') AS description, coalesce(active, FALSE) AS is_active, created_at, {UPDATED},
  id AS legacy_id FROM {{chains}}
  WHERE {r.clean('name')} IS NOT NULL AND id IN (SELECT chain_id FROM v)"""


@check("retail_chains", f"{V} {CHAINS}")
def retail_chains(t):
    """PIP8."""
    return chain_rows(t)


@shared
def store_brand_rows(t):
    return stores.store_brands(
        t["brands"], wanted_ids(t, "brand_id"), t["store_records"], chain_rows(t), segment_rows(t)
    )


STORE_BRANDS = f"""chain_rows AS ({CHAINS}),
seg AS ({segment_sql('{channels}', 'store_segment', None, _CHANNELS)}),
bc AS (SELECT brand_id, min(channel_id) AS channel_id FROM {{store_records}} GROUP BY brand_id),
sbrands AS (SELECT {r.key('store_brand', 'b.id')} AS id, {r.clean('b.name')} AS description,
    coalesce(b.code, 'empty') AS abras_code, c.id AS retail_chain_id,
    coalesce(s.id, (SELECT arg_min(id, legacy_id) FROM seg)) AS store_segment_id,
    coalesce(b.active, FALSE) AS is_active, b.created_at,
    coalesce(b.updated_at, b.created_at) AS updated_at, b.id AS legacy_id
  FROM {{brands}} b JOIN chain_rows c ON c.legacy_id = b.chain_id
  LEFT JOIN bc ON bc.brand_id = b.id LEFT JOIN seg s ON s.legacy_id = bc.channel_id
  WHERE {r.clean('b.name')} IS NOT NULL AND b.id IN (SELECT brand_id FROM v))"""


@check("store_brands", f"{V}, {STORE_BRANDS} SELECT * FROM sbrands")
def store_brands(t):
    """PIP9."""
    return store_brand_rows(t)


@shared
def store_rows(t):
    return stores.stores(t["store_records"], wanted_ids(t, "store_id"), store_brand_rows(t))


STORES = f"""{STORE_BRANDS}, store_rows AS (
  SELECT {r.key('store', 's.id')} AS id, {r.clean('s.name', 255)} AS name, b.id AS store_brand_id,
    coalesce(s.active, FALSE) AS is_active, s.created_at,
    coalesce(s.updated_at, s.created_at) AS updated_at, s.id AS legacy_id,
    coalesce(s.code, '') AS code
  FROM {{store_records}} s JOIN sbrands b ON b.legacy_id = s.brand_id
  WHERE {r.clean('s.name')} IS NOT NULL AND s.id IN (SELECT store_id FROM v)),
sowned AS (SELECT s.*, k.id AS owner_id FROM {{store_records}} s
  JOIN store_rows k ON k.legacy_id = s.id)"""


@check("stores", f"{V}, {STORES} SELECT * FROM store_rows")
def stores_table(t):
    """PIP10."""
    return store_rows(t)


@check(
    "store_cnpjs",
    f"""{V}, {STORES} SELECT {r.key('store_cnpj', 'id')} AS id, {r.tax_id('tax_id')} AS cnpj,
      TRUE AS is_main, owner_id AS store_id, coalesce(active, FALSE) AS is_active, created_at,
      {UPDATED} FROM sowned WHERE {r.tax_id('tax_id')} IS NOT NULL""",
)
def store_cnpjs(t):
    """PIP11."""
    return stores.store_cnpjs(t["store_records"], store_rows(t))


_STORE_ADDRESSES = _address_rows("sowned", "main_", "main", True, "CAST(NULL AS BIGINT)")


@check("store_addresses", f"{V}, {STORES} {address_table(_STORE_ADDRESSES, 'Store')}")
def store_addresses(t):
    """PIP12."""
    return stores.addresses(t["store_records"], store_rows(t), t["places"])


@check("store_contacts", f"{V}, {STORES} {contact_table('sowned', 'Store')}")
def store_contacts(t):
    """PIP13."""
    return stores.contacts(t["store_records"], store_rows(t))


# Users.

_FLAGS = """TRUE AS email_confirmed, created_at AS email_confirmed_at,
  FALSE AS phone_number_confirmed, FALSE AS temporary_password, FALSE AS two_factor_enabled,
  TRUE AS lockout_enabled, 0 AS access_failed_count"""
_EMPTY_ACCOUNT = ("password_hash", "deleted_at", "lockout_end", "security_stamp", "concurrency_stamp")


@shared
def user_rows(t):
    return users.users(t["source_users"])


@check("users", f"SELECT *, {_FLAGS} FROM ({scopes.USERS}) u")
def users_table(t):
    """PIP14 as a full load, with PRJ1 and STR9. Columns without any value are left out."""
    return users.users(t["source_users"]).drop(*_EMPTY_ACCOUNT)


@check(
    "users_incremental",
    f"""SELECT legacy_id, status, normalized_email FROM (
      SELECT * REPLACE ('old' AS status) FROM ({scopes.USERS}) a WHERE legacy_id % 3 = 0
      UNION ALL SELECT * FROM ({scopes.USERS}) b WHERE legacy_id % 3 <> 0) u""",
)
def users_incremental(t):
    """PIP14 as an incremental load."""
    loaded = user_rows(t).filter("legacy_id % 3 = 0").withColumn("status", F.lit("old"))
    content = load.append_new(loaded, users.users(t["source_users"]), ["legacy_id"])
    return content.select("legacy_id", "status", "normalized_email")


@check(
    "user_roles",
    f"""SELECT id AS user_id, (SELECT min(id) FROM {{roles}}) AS role_id FROM ({scopes.USERS}) u""",
)
def user_roles(t):
    """PIP15 when neither the preferred nor the default role exists."""
    return users.user_roles(user_rows(t), t["roles"], "role-x", "role-y")


# Contracts.


@shared
def terms(t):
    return sheets.sheet_terms(t["sheet"])


@shared
def contract_rows(t):
    return contracts.contracts(
        t["contract_lines"], t["contract_master"], customer_keys(t), terms(t), PARAMS, r.RUN_TS
    )


CONTRACTS = f"""{WANTED}, terms AS ({scopes.SHEET_TERMS}), crolled AS (
  SELECT v.contract_id, min(v.customer_id) AS lc, max(v.customer_name) AS customer_name,
    max(v.billing_day) AS billing_day, max(v.due_day) AS due_day, max(v.start_at) AS start_at,
    max(v.contract_created_at) AS made, max(v.contract_updated_at) AS changed
  FROM v GROUP BY v.contract_id),
contract_rows AS (
  SELECT {r.key('contract', 'c.contract_id')} AS id, c.contract_id AS legacy_id,
    c.contract_id AS code, k.id AS customer_id,
    coalesce(CASE WHEN s.contract_id IS NULL THEN c.billing_day ELSE s.sheet_billing_day END, 1)
      AS contract_parameters_billing_day,
    coalesce(CASE WHEN s.contract_id IS NULL THEN c.due_day ELSE s.sheet_due_day END, 1)
      AS contract_parameters_due_day,
    {r.snake('s.sheet_billing_type', 'current')} AS contract_parameters_billing_type,
    {r.snake('s.sheet_thirteenth_type', 'monthly')} AS contract_parameters_thirteenth_salary_type,
    'shared' AS operation_type, 'shared' AS trade_type,
    coalesce(c.start_at, c.made, {r.NOW}) AS start_date, 'active' AS status,
    CAST(0 AS DOUBLE) AS expected_amount, coalesce(c.made, {r.NOW}) AS created_at,
    coalesce(c.changed, {r.NOW}) AS updated_at, {r.clean('c.customer_name', 255)} AS title,
    c.lc AS legacy_customer_id
  FROM crolled c JOIN ckeys k ON k.legacy_id = c.lc LEFT JOIN terms s ON s.contract_id = c.contract_id)"""


@check("contracts", f"{CONTRACTS} SELECT * FROM contract_rows")
def contracts_table(t):
    """PIP16. Columns without any value are left out."""
    return contract_rows(t).drop("end_date", "deleted_at", "observations")


@shared
def billing_rows(t):
    keys = match.key_map(contract_rows(t))
    wanted = billing_scope(None, terms(t), keys)
    billed = billing.contracts_to_bill(t["contract_lines"], wanted, customer_keys(t))
    names = customers.golden_customers(t["parties"], wanted_customers(t))
    return billing.billings(billed, terms(t), names, r.RUN_TS)


BILLINGS = f"""billed AS (
  SELECT x.contract_id, k.id AS customer_id, x.nm FROM (
    SELECT contract_id, min(customer_id) AS lc, max(customer_name) AS nm FROM {{contract_lines}}
    WHERE contract_id IN (SELECT legacy_id FROM contract_rows)
      AND contract_id IN (SELECT contract_id FROM terms) GROUP BY contract_id) x
  JOIN ckeys k ON k.legacy_id = x.lc),
first_billed AS ({r.first_rows('SELECT * FROM billed', 'customer_id', 'contract_id')}),
billing_rows AS (
  SELECT {r.key('billing', 'b.customer_id')} AS id, b.customer_id,
    substr(coalesce(nullif({r.strip('b.nm')}, ''), nullif({r.strip('s.sheet_name')}, ''),
      nullif({r.strip('g.trade_name')}, ''), nullif({r.strip('g.legal_name')}, ''), 'Customer'),
      1, 500) AS name, TRUE AS is_active, {NOW},
    CASE WHEN lower(s.sheet_calculation) LIKE '%5%' AND lower(s.sheet_calculation) LIKE '%week%'
      THEN 'five_weeks_in_month' ELSE 'four_weeks_in_month' END AS calculation_type,
    coalesce(s.sheet_billing_day, 1) AS contract_parameters_billing_day,
    coalesce(s.sheet_due_day, 1) AS contract_parameters_due_day,
    {r.snake('s.sheet_billing_type', 'current')} AS contract_parameters_billing_type,
    {r.snake('s.sheet_thirteenth_type', 'monthly')} AS contract_parameters_thirteenth_salary_type
  FROM first_billed b JOIN terms s ON s.contract_id = b.contract_id
  LEFT JOIN golden_customers g ON g.id = b.customer_id)"""


@check("billings", f"{CONTRACTS}, {BILLINGS} SELECT * FROM billing_rows")
def billings_table(t):
    """PIP17 with SET2, WIN3, STR16 and STR20. Columns without any value are left out."""
    return billing_rows(t).drop("observations", "deleted_at")


@shared
def contract_billings(t):
    return billing.computed_billings(contract_rows(t))


@check(
    "contract_billings",
    f"""{CONTRACTS} SELECT legacy_id AS contract_legacy_id, id AS contract_id,
      {r.key('billing', 'customer_id')} AS billing_id FROM contract_rows""",
)
def contract_billing_map(t):
    """PIP17: the billing of every contract, placeholders included."""
    return contract_billings(t)


@shared
def task_rows(t):
    return contracts.promoter_tasks(t["contract_lines"], PARAMS, r.RUN_TS)


TASKS = f"""tasks AS (
  SELECT {r.key('promoter_task', 'name')} AS id, name, {r.task_type('spelling')} AS task_type FROM (
    SELECT {r.task_name('task_name')} AS name, min(upper({r.clean('task_name')})) AS spelling
    FROM v WHERE {r.clean('task_name')} IS NOT NULL GROUP BY 1) x)"""


@check("promoter_tasks", f"{V}, {TASKS} SELECT *, TRUE AS is_active, {NOW} FROM tasks")
def promoter_tasks(t):
    """PIP18."""
    return task_rows(t)


@shared
def keyed(t):
    return contracts.keyed_scenarios(
        t["contract_lines"], contract_billings(t), PARAMS, r.RUN_TS
    )


SCENARIOS = f"""{CONTRACTS}, {scopes.KEYED_SCENARIOS}, scenario_rows AS (
  SELECT s.*, c.id AS cid, c.customer_id AS gid FROM scenarios s
  JOIN contract_rows c ON c.legacy_id = s.contract_id)"""


@check(
    "contract_scenarios",
    f"""{SCENARIOS} SELECT scenario_id AS id, CAST(0 AS BIGINT) AS legacy_id, cid AS contract_id,
      {r.key('promoter_task', r.task_name('task_name'))} AS promoter_task_id, label AS frequency,
      {r.comma_number('hours')} AS hours, CAST(rate_key AS DOUBLE) AS hour_value,
      CAST(CAST(coalesce(start_day, line_created_at, {r.NOW}) AS DATE) AS VARCHAR) AS start_date,
      CAST(notice_day AS VARCHAR) AS end_date,
      CASE WHEN coalesce(status, 0) IN (0, 11) THEN 0 ELSE 1 END AS status,
      coalesce({r.comma_number('hours')} * CAST(rate_key AS DOUBLE), 0.0) AS expected_amount,
      coalesce(line_created_at, {r.NOW}) AS created_at,
      coalesce(line_updated_at, line_created_at, {r.NOW}) AS updated_at,
      {r.key('billing', 'gid')} AS billing_id FROM scenario_rows""",
)
def contract_scenarios(t):
    """PIP19. The column without any value is left out."""
    return contracts.contract_scenarios(keyed(t)).drop("deleted_at")


@check(
    "contract_scenario_stores",
    f"""{SCENARIOS}, {scopes.SCENARIO_KEYS.replace('FROM scenarios', 'FROM scenario_rows')},
    {scopes.LINE_KEYS}, {STORES}
    SELECT {r.key('scenario_store', 'l.line_id')} AS id, l.line_id AS legacy_id, k.scenario_id,
      s.id AS store_id, coalesce(l.start_at, l.line_created_at, {r.NOW}) AS start_date,
      CASE WHEN f.active THEN 'active' ELSE 'inactive' END AS status,
      coalesce(l.line_created_at, {r.NOW}) AS created_at,
      coalesce(l.line_updated_at, l.line_created_at, {r.NOW}) AS updated_at
    FROM lines_keyed l
    JOIN scenario_keys k USING (contract_id, frequency_key, hours_key, rate_key)
    JOIN store_rows s ON s.legacy_id = l.store_id
    LEFT JOIN {{line_flags}} f ON f.line_id = l.line_id WHERE {scopes.FITS}""",
)
def contract_scenario_stores(t):
    """PIP20. The column without any value is left out.

    Keys of scenarios and stores are tables of steps before, as in a run, and so are the linked lines:
    the disk holds the shuffles of one step at a time.
    """
    folder = folder_of(t)
    stored = staged(match.key_map(store_rows(t)), f"{folder}/stores")
    billed = contracts.billed_scenarios(
        t["contract_lines"], contract_billings(t), PARAMS, columns=[]
    )
    key_rows = staged(contracts.scenario_key_map(billed), f"{folder}/scenario_keys")
    linked = contracts.linked_lines(t["contract_lines"], key_rows, stored, PARAMS)
    return contracts.scenario_store_rows(
        staged(linked, f"{folder}/linked"), t["line_flags"], r.RUN_TS
    ).drop("closed_at")


def _seller_sql(role: str, first: str, second: str) -> str:
    return f"""SELECT {r.key('contract_seller', 'id', f"'{role}'")} AS id, id AS contract_id,
      coalesce({first}, {second}, (SELECT min(id) FROM us)) AS user_id, '{role}' AS seller_type,
      {NOW}, 'active' AS status FROM sold"""


@check(
    "contract_sellers",
    f"""{CONTRACTS}, {scopes.LOOKUPS}, sold AS (
      SELECT c.id, {scopes.user_of('s.farmer_login')} AS f, {scopes.user_of('s.hunter_login')} AS h
      FROM contract_rows c JOIN terms s ON s.contract_id = c.legacy_id)
    {_seller_sql('farmer', 'f', 'h')} UNION ALL {_seller_sql('hunter', 'h', 'f')}""",
)
def contract_sellers(t):
    """PIP21."""
    return contracts.contract_sellers(
        match.key_map(contract_rows(t)), terms(t), user_rows(t), t["source_users"], r.RUN_TS
    )


_CONTRACT_DATES = f"""coalesce(contract_created_at, {r.NOW}) AS created_at,
  coalesce(contract_updated_at, {r.NOW}) AS updated_at"""


@check(
    "contract_team_members",
    f"""{CONTRACTS}, us AS ({scopes.USERS}), m AS (
      SELECT DISTINCT v.contract_id, o.seller_id, contract_created_at, contract_updated_at
      FROM v JOIN {{contract_master}} o ON o.contract_id = v.contract_id
      WHERE o.seller_id IS NOT NULL)
    SELECT {r.key('team_member', 'm.contract_id', 'u.id', 'contract_created_at', 'contract_updated_at')} AS id,
      c.id AS contract_id, u.id AS user_id, 'analyst' AS position, {_CONTRACT_DATES}
    FROM m JOIN contract_rows c ON c.legacy_id = m.contract_id
    JOIN us u ON u.legacy_id = m.seller_id""",
)
def contract_team_members(t):
    """PIP22."""
    return contracts.contract_team_members(
        scoped(t), t["contract_master"], match.key_map(contract_rows(t)),
        match.key_map(user_rows(t)), r.RUN_TS,
    )


def _name_sql(name: str, where: str) -> str:
    parts = (
        "legacy_id", "customer_name", "system_name", "contract_created_at", "contract_updated_at",
        name,
    )
    return f"""SELECT {r.key('contract_contact', *parts)} AS id, cid AS contract_id,
      {name} AS name, {_CONTRACT_DATES} FROM named WHERE {where}"""


@check(
    "contract_contacts",
    f"""{CONTRACTS}, named AS (
      SELECT DISTINCT c.legacy_id, c.id AS cid, v.customer_name, v.system_name,
        {r.clean('v.customer_name')} AS a, {r.clean('v.system_name')} AS b,
        contract_created_at, contract_updated_at
      FROM v JOIN contract_rows c ON c.legacy_id = v.contract_id WHERE v.customer_name IS NOT NULL)
    {_name_sql('a', 'a IS NOT NULL')} UNION ALL {_name_sql('b', 'a IS NOT NULL AND b <> a')}""",
)
def contract_contacts(t):
    """PIP23."""
    return contracts.contract_contacts(scoped(t), match.key_map(contract_rows(t)), r.RUN_TS)


_PARTNERS = f"""{CONTRACTS}, partners AS (
  SELECT DISTINCT c.legacy_id, c.id AS cid, v.store_client_id, v.store_client_name,
    contract_created_at, contract_updated_at
  FROM v JOIN contract_rows c ON c.legacy_id = v.contract_id
  WHERE v.store_client_id IS NOT NULL AND v.store_client_name IS NOT NULL)"""

_PARTNER_ID = r.key(
    "contract_partner", "legacy_id", "store_client_id", "store_client_name",
    "contract_created_at", "contract_updated_at",
)


def partner_rows(t, dedupe: bool):
    rows = contracts.contract_partners(
        scoped(t), match.key_map(contract_rows(t)), t["people"], r.RUN_TS, dedupe
    )
    return rows.drop("position", "phone", "email")


@check(
    "contract_partners",
    f"""{_PARTNERS} SELECT {_PARTNER_ID} AS id, cid AS contract_id,
      (SELECT min(id) FROM {{people}}) AS person_id, {_CONTRACT_DATES} FROM partners""",
)
def contract_partners(t):
    """PIP24 with JOI15. Columns without any value are left out."""
    return partner_rows(t, dedupe=False)


@check(
    "contract_partners_once",
    f"""{_PARTNERS} SELECT min({_PARTNER_ID}) AS id, cid AS contract_id,
      (SELECT min(id) FROM {{people}}) AS person_id, coalesce(contract_created_at, {r.NOW}) AS created_at,
      coalesce(contract_updated_at, {r.NOW}) AS updated_at FROM partners GROUP BY ALL""",
)
def contract_partners_once(t):
    """PIP24 with one row per contract and person."""
    return partner_rows(t, dedupe=True)


_CHARGES = records.charges_sql("charged", "contract_id, cid, gid, created_at, updated_at")


@check(
    "contract_additional_charges",
    f"""{CONTRACTS}, charged AS (
      SELECT m.*, c.id AS cid, c.customer_id AS gid FROM {{contract_master}} m
      JOIN contract_rows c ON c.legacy_id = m.contract_id)
    SELECT {r.key('contract_charge', 'contract_id', 'position')} AS id, cid AS contract_id,
      {r.key('billing', 'gid')} AS billing_id, amount, charge_type, billing_model, start_date,
      coalesce(created_at, {r.NOW}) AS created_at, coalesce(updated_at, {r.NOW}) AS updated_at
    FROM ({_CHARGES}) x""",
)
def contract_additional_charges(t):
    """PIP25. The column without any value is left out."""
    return contracts.contract_additional_charges(
        t["contract_master"], contract_billings(t), r.RUN_TS
    ).drop("end_date")


@check(
    "contract_scenarios_brands",
    f"""{SCENARIOS}, {PAIRS} SELECT DISTINCT s.scenario_id, p.customer_brand_id
    FROM scenario_rows s JOIN pairs p ON p.customer_id = s.gid""",
)
def contract_scenarios_brands(t):
    """PIP26."""
    scenarios = contracts.contract_scenarios(keyed(t))
    return contracts.contract_scenarios_brands(brand_pairs(t), scenarios)


@check(
    "unknown_task_names",
    f"""{V}, {TASKS} SELECT DISTINCT {r.task_name('task_name')} AS name FROM v
    WHERE {r.task_name('task_name')} NOT IN (SELECT name FROM tasks WHERE task_type = 'undefined')""",
)
def unknown_task_names(t):
    """VAL3: the names that would stop the scenario step when only some tasks are loaded."""
    loaded = task_rows(t).filter("task_type = 'undefined'")
    return contracts.unknown_tasks(scoped(t), loaded)


# Older client model.

_CLIENT = r.key("client", "id")


def _registration(x: str) -> str:
    d = r.digits(x)
    return (
        f"(CASE WHEN {d} = '' OR length({d}) > 10 OR CAST({d} AS BIGINT) NOT BETWEEN 1 AND "
        f"2147483647 THEN NULL ELSE CAST({d} AS DOUBLE) END)"
    )


@check(
    "client_customers",
    f"""SELECT {_CLIENT} AS customer_id, id AS legado_cliente_id,
      CAST(code AS DOUBLE) AS legado_cliente_code, {r.clean('system_name')} AS legado__nomesistema,
      person_type AS entity_type, {r.case_map('person_type', codes.PERSON_ID_TYPES, 'NULL')} AS tax_id_type,
      substr({r.tax_id('tax_id')}, 1, 14) AS tax_id,
      {_registration('state_registration')} AS registration_state,
      {_registration('municipal_registration')} AS registration_municipal,
      {r.clean('legal_name', 255)} AS legal_name, {r.clean('trade_name', 255)} AS trade_name,
      CASE WHEN active THEN 'active' ELSE 'inactive' END AS status, created_at, updated_at,
      activated_at AS activated_date, {r.clean('notes')} AS coment FROM {{parties}}""",
)
def client_customers(t):
    """PIP27 clients."""
    numbers = ("legado_cliente_code", "registration_state", "registration_municipal")
    return legacy_clients.clients(t["parties"]).withColumns(
        {c: F.col(c).cast("double") for c in numbers}
    )


_HOLDERS = f"""holders AS (SELECT *, {r.key('shareholder_contact', 'id')} AS contact_id,
    {r.key('shareholder', 'id')} AS shareholder_id FROM {{parties}}
  WHERE {r.filled('shareholder_name')} AND upper({r.strip('shareholder_name')}) <> 'PENDENTE')"""


def _client_address(source: str, prefix: str, kind: str, owner: str, where: str) -> str:
    def cell(name: str, n: int | None = None) -> str:
        return r.clean(f"{prefix}{name}", n)

    code = f"coalesce(CASE WHEN {r.place_code(prefix + 'place_code')} > 0 THEN {r.place_code(prefix + 'place_code')} END, m.code, 0)"
    return f"""SELECT {r.key('client_address', f"'{owner}'", 'id', f"'{kind}'")} AS address_id,
      '{kind}' AS address_type, '{owner}' AS addressable_type, id AS addressable_id,
      id AS legacy_cliente_id, CAST(a.code AS DOUBLE) AS legacy_cliente_code, {cell('street', 200)} AS street,
      {cell('number', 20)} AS house_num, {cell('address_line_2')} AS complement1,
      {cell('neighborhood')} AS district, {r.tax_id(prefix + 'postal_code')} AS cep,
      {cell('city')} AS city, CASE WHEN {code} > 0 THEN substr(CAST({code} AS VARCHAR), 1, 10) END AS city_code,
      {cell('state', 2)} AS region_code, 'BR' AS country, 'active' AS status, created_at, updated_at
    FROM {source} a LEFT JOIN ({scopes.PLACES}) m ON m.st = {r.fold_name(prefix + 'state')}
      AND m.ci = {r.fold_name(prefix + 'city')} WHERE {where}"""


_HOLDER_STREET = (
    f"shareholder_street <> '' AND upper({r.strip('shareholder_street')}) <> 'PENDENTE'"
)


@check(
    "client_addresses",
    f"""WITH {_HOLDERS}
    {_client_address('{parties}', 'main_', 'main', 'customers', r.filled('main_street'))}
    UNION ALL {_client_address('{parties}', 'billing_', 'billing', 'customers', r.filled('billing_street'))}
    UNION ALL {_client_address('holders', 'shareholder_', 'main', 'shareholder', _HOLDER_STREET)}""",
)
def client_addresses(t):
    """PIP27 addresses."""
    rows = legacy_clients.addresses(t["parties"], t["places"])
    return rows.withColumn("legacy_cliente_code", F.col("legacy_cliente_code").cast("double"))


@check(
    "client_contacts",
    f"""WITH {_HOLDERS}, people AS ({records.people_sql('id, created_at, updated_at')})
    SELECT {r.key('client_contact', 'id', 'position')} AS contact_id, {_CLIENT} AS customer_id,
      contact_name, job_title, comment AS coment, 'active' AS status, created_at, updated_at
    FROM people
    UNION ALL SELECT contact_id, {_CLIENT}, {r.clean('shareholder_name')},
      {r.clean('shareholder_job', 200)}, CAST(NULL AS VARCHAR), 'active', created_at, updated_at
    FROM holders""",
)
def client_contacts(t):
    """PIP27 contacts."""
    return legacy_clients.contacts(t["parties"])


@check(
    "client_emails",
    f"""SELECT {r.key('client_email', 'id', 'email_type', 'email')} AS contact_email_id,
      {_CLIENT} AS customer_id, email_type, email, 'active' AS status, created_at, updated_at
    FROM ({records.emails_sql('id, created_at, updated_at')}) x""",
)
def client_emails(t):
    """PIP27 e-mails."""
    return legacy_clients.emails(t["parties"])


@check(
    "client_phones",
    f"""SELECT {r.key('client_phone', 'id', 'phone_type')} AS contact_phone_id,
      {_CLIENT} AS customer_id, phone_type, country_code, area_code, number, 'active' AS status,
      created_at, updated_at FROM ({records.phones_sql('id, created_at, updated_at')}) x""",
)
def client_phones(t):
    """PIP27 phones."""
    return legacy_clients.phones(t["parties"])


@check(
    "shareholders",
    f"""WITH {_HOLDERS} SELECT shareholder_id, {_CLIENT} AS customer_id, contact_id,
      {r.clean('shareholder_job', 200)} AS role_label, activated_at AS start_date,
      deactivated_at AS end_date, 'active' AS status, created_at, updated_at FROM holders""",
)
def shareholders(t):
    """PIP27 shareholders with RSH9."""
    return legacy_clients.shareholders(t["parties"])


_AREA, _REST = records.phone_parts("shareholder_phone")


@check(
    "shareholder_phones",
    f"""WITH {_HOLDERS} SELECT {r.key('shareholder_phone', 'id')} AS shareholder_phone__id,
      shareholder_id, 'phone' AS phone_type, '55' AS country_code, {_AREA} AS area_code,
      {_REST} AS number, 'active' AS status, created_at, updated_at FROM holders
    WHERE {_AREA} IS NOT NULL""",
)
def shareholder_phones(t):
    """PIP27 shareholder phones."""
    return legacy_clients.shareholder_phones(t["parties"])


@check(
    "shareholder_pii",
    f"""WITH {_HOLDERS}, x AS (SELECT *, {r.tax_id('shareholder_national_id')} AS d FROM holders)
    SELECT shareholder_id, lpad(d, 11, '0') AS cpf, {r.clean('shareholder_identity_card')} AS rg,
      {r.clean('shareholder_nationality')} AS nationality,
      {r.case_map('shareholder_marital_status', codes.MARITAL_STATUS, 'NULL')} AS marital_status,
      {r.clean('shareholder_job', 200)} AS job_title, 'active' AS status, created_at, updated_at
    FROM x WHERE length(d) IN (10, 11)""",
)
def shareholder_pii(t):
    """PIP27 personal data."""
    return legacy_clients.shareholder_pii(t["parties"])


@check(
    "client_orphans",
    f"""SELECT customer_id, phone_type FROM (
      SELECT {_CLIENT} AS customer_id, phone_type FROM ({records.phones_sql('id')}) x) y
    WHERE customer_id NOT IN (SELECT {_CLIENT} FROM {{parties}} WHERE code IS NOT NULL)""",
)
def client_orphans(t):
    """JOI14 over the older model: phones whose client was not loaded."""
    loaded = legacy_clients.clients(t["parties"].filter("code IS NOT NULL"))
    found = legacy_clients.orphan_rows(legacy_clients.phones(t["parties"]), loaded)
    return found.select("customer_id", "phone_type")


# Validation of pipelines.


@check(
    "reconcile_contracts",
    f"""{CONTRACTS}, {BILLINGS}, a AS (
      SELECT 'contracts' AS step, (SELECT count(DISTINCT contract_id) FROM v) AS source_count,
        (SELECT count(*) FROM contract_rows) AS target_count
      UNION ALL SELECT 'billings', (SELECT count(DISTINCT customer_id) FROM contract_rows),
        (SELECT count(DISTINCT customer_id) FROM billing_rows))
    SELECT *, source_count - target_count AS diff, source_count = target_count AS ok FROM a""",
)
def reconcile_contracts(t):
    """VAL1 for contracts and billings."""
    rows = contract_rows(t)
    steps = {
        "contracts": (
            scoped(t).select(F.countDistinct("contract_id")), quality.count_rows(rows),
        ),
    }
    return quality.reconcile(steps).unionByName(
        quality.reconcile_billing(rows, billing_rows(t))
    )
