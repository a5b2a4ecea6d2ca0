"""Checks of cleaning, golden records and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import codes, keys, text
from ledgerloom.operators import golden, reshape, rollup
from ledgerloom.plans import customers
from standin import rules as r
from standin.registry import check

_D = r.digits


@check(
    "clean_text",
    f"""SELECT id, {r.clean('state_registration', 20)} AS registration,
      {r.clean('legal_name', 12)} AS legal_name, {r.clean('trade_name')} AS trade_name,
      {r.clean('main_street', 500)} AS street, {r.filled('main_number')} AS has_number,
      coalesce({r.clean('main_number', 20)}, 'S/N') AS number,
      coalesce(nullif({r.strip('trade_name')}, ''), nullif({r.strip('legal_name')}, ''), 'Customer')
        AS display_name
    FROM {{parties}}""",
)
def clean_text(t):
    """STR1, STR10, STR20, FIL6, FIL10."""
    c = F.col
    return t["parties"].select(
        "id",
        text.clean_text(c("state_registration"), 20).alias("registration"),
        text.clean_text(c("legal_name"), 12).alias("legal_name"),
        text.clean_text(c("trade_name")).alias("trade_name"),
        text.clean_text(c("main_street"), 500).alias("street"),
        text.not_blank(c("main_number")).alias("has_number"),
        text.text_or(c("main_number"), 20, "S/N").alias("number"),
        text.first_filled(c("trade_name"), c("legal_name"), F.lit("Customer")).alias(
            "display_name"
        ),
    )


@check(
    "clean_documents",
    f"""SELECT doc_id, {r.clean('text')} AS cleaned, {r.fold_name('text')} AS folded,
      length({_D('text')}) AS digits, upper({r.clean('lang', 1)}) AS lang FROM {{documents}}""",
)
def clean_documents(t):
    """STR1, STR3 and STR11 over whole texts."""
    return t["documents"].select(
        "doc_id",
        text.clean_text(F.col("text")).alias("cleaned"),
        text.fold_name(F.col("text")).alias("folded"),
        F.length(text.digits(F.col("text"))).cast("bigint").alias("digits"),
        F.upper(text.clean_text(F.col("lang"), 1)).alias("lang"),
    )


def _holder(x: str) -> str:
    d = r.tax_id(x)
    return f"(CASE length({d}) WHEN 11 THEN {d} WHEN 10 THEN '0' || {d} END)"


def _padded(x: str) -> str:
    d = _D(x)
    return (
        f"(CASE WHEN {d} = '' THEN NULL WHEN length({d}) <= 11 THEN lpad({d}, 11, '0') "
        f"WHEN length({d}) <= 14 THEN lpad({d}, 14, '0') ELSE {d} END)"
    )


@check(
    "clean_digits",
    f"""SELECT id, {r.tax_id('tax_id')} AS tax_id, {_padded('tax_id')} AS tax_id_key,
      coalesce({r.tax_id('main_postal_code')}, '00000000') AS postal_code,
      {r.tax_id('main_postal_code')} AS old_postal_code,
      {_holder('shareholder_national_id')} AS holder_id,
      CASE WHEN {_D('state_registration')} = '' OR length({_D('state_registration')}) > 10
        OR CAST({_D('state_registration')} AS BIGINT) NOT BETWEEN 1 AND 2147483647 THEN NULL
        ELSE CAST({_D('state_registration')} AS DOUBLE) END AS registration
    FROM {{parties}}""",
)
def clean_digits(t):
    """STR3 to STR6 and NUM11."""
    c = F.col
    return t["parties"].select(
        "id",
        text.tax_id(c("tax_id")).alias("tax_id"),
        text.national_id_key(c("tax_id")).alias("tax_id_key"),
        text.postal_code(c("main_postal_code")).alias("postal_code"),
        text.postal_code(c("main_postal_code"), None).alias("old_postal_code"),
        text.shareholder_id(c("shareholder_national_id")).alias("holder_id"),
        codes.registration_number(c("state_registration")).cast("double").alias("registration"),
    )


def _english(x: str) -> str:
    u = f"upper({r.strip(x)})"
    snake = f"trim(regexp_replace(lower({u}), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"nullif(coalesce({r.case_map(u, text.TASK_NAMES_ENGLISH, 'NULL')}, {snake}), '')"


@check(
    "task_names",
    f"""SELECT task_name AS raw, {r.task_name('task_name')} AS name,
      {r.task_type(r.task_name('task_name'))} AS task_type, {_english('task_name')} AS english,
      {r.snake('task_name', 'none')} AS snake, count(*) AS lines
    FROM {{contract_lines}} GROUP BY task_name""",
)
def task_names(t):
    """STR12 to STR15."""
    names = t["contract_lines"].groupBy("task_name").agg(F.count("*").alias("lines"))
    raw = F.col("task_name")
    return names.select(
        raw.alias("raw"),
        text.task_name(raw).alias("name"),
        text.task_type(text.task_name(raw)).alias("task_type"),
        text.task_name_english(raw).alias("english"),
        text.snake_case(raw, "none").alias("snake"),
        "lines",
    )


@check(
    "lenient_casts",
    f"""SELECT line_id, store_id, {r.comma_number('hours')} AS hours, {r.number('hours')} AS strict_hours,
      coalesce({r.whole('hours')}, 1) AS whole_hours, {r.number('frequency')} AS frequency
    FROM {{contract_lines}}""",
)
def lenient_casts(t):
    """NUM3 and NUM12."""
    c = F.col
    return t["contract_lines"].select(
        "line_id",
        "store_id",
        codes.to_decimal_comma(c("hours")).alias("hours"),
        codes.to_number(c("hours")).alias("strict_hours"),
        codes.safe_int(c("hours"), 1).alias("whole_hours"),
        codes.to_number(c("frequency")).alias("frequency"),
    )


@check(
    "sheet_cells",
    f"""SELECT id_orcamento, sheet_row, {r.safe_bool('migrar', 'FALSE')} AS migrar,
      {r.safe_bool('orcamento_ativo', 'TRUE')} AS active, {r.whole('dia_faturamento')} IS NULL AS no_day,
      CASE WHEN lower(tipo_fat_descricao) LIKE '%5%' AND lower(tipo_fat_descricao) LIKE '%week%'
        THEN 'five_weeks_in_month' ELSE 'four_weeks_in_month' END AS calculation,
      {r.snake('contract_parameters_billing_type', 'current')} AS billing_type,
      {r.snake('contract_parameters_thirteenth_salary_type', 'monthly')} AS thirteenth
    FROM {{sheet}}""",
)
def sheet_cells(t):
    """BOO1, STR15, STR16."""
    c = F.col
    return t["sheet"].select(
        "id_orcamento",
        "sheet_row",
        codes.safe_bool(c("migrar"), False).alias("migrar"),
        codes.safe_bool(c("orcamento_ativo"), True).alias("active"),
        codes.safe_int(c("dia_faturamento"), None).isNull().alias("no_day"),
        text.calculation_type(c("tipo_fat_descricao")).alias("calculation"),
        text.snake_case(c("contract_parameters_billing_type"), "current").alias("billing_type"),
        text.snake_case(c("contract_parameters_thirteenth_salary_type"), "monthly").alias(
            "thirteenth"
        ),
    )


@check(
    "positions",
    f"""SELECT id, {r.comma_number('main_latitude')} AS latitude,
      {r.comma_number('main_longitude')} AS longitude,
      coalesce({r.place_code('main_place_code')}, 0) AS place,
      CASE WHEN {r.place_code('main_place_code')} > 0
        THEN substr(CAST({r.place_code('main_place_code')} AS VARCHAR), 1, 10) END AS place_text,
      coalesce(CAST(code AS VARCHAR), 'empty') AS code
    FROM {{parties}}""",
)
def positions(t):
    """NUM8 to NUM10 and STR21."""
    c = F.col
    place = codes.place_code(c("main_place_code"))
    return t["parties"].select(
        "id",
        codes.to_decimal_comma(c("main_latitude")).alias("latitude"),
        codes.to_decimal_comma(c("main_longitude")).alias("longitude"),
        F.coalesce(place, F.lit(0)).alias("place"),
        codes.place_code_text(place).alias("place_text"),
        text.code_text(c("code"), "empty").alias("code"),
    )


def _texts_of(label: str) -> str:
    table = {k: ",".join(v) for k, v in codes.FREQUENCY_TEXTS.items()}
    return r.case_map(label, table, label)


@check(
    "frequency_labels",
    f"""SELECT frequency, {r.frequency_label('frequency')} AS label,
      {r.frequency_key('frequency')} AS frequency_key,
      {_texts_of(r.frequency_label('frequency'))} AS texts, count(*) AS lines
    FROM {{contract_lines}} GROUP BY frequency""",
)
def frequency_labels(t):
    """NUM4 to NUM6."""
    rows = t["contract_lines"].groupBy("frequency").agg(F.count("*").alias("lines"))
    number = codes.to_number(F.col("frequency"))
    label = codes.frequency_label(number)
    return rows.select(
        "frequency",
        label.alias("label"),
        codes.frequency_key(F.col("frequency"), number).alias("frequency_key"),
        codes.frequency_texts(label).alias("texts"),
        "lines",
    )


@check(
    "status_codes",
    f"""SELECT id, CASE WHEN active THEN 'active' ELSE 'inactive' END AS status,
      coalesce({r.case_map('id % 7', codes.ORDER_STATUS, 'NULL')}, 'status_' || (id % 7)) AS order_status,
      CASE WHEN active THEN 1 ELSE 0 END AS status_number,
      CASE WHEN id % 12 IN (0, 11) THEN 0 ELSE 1 END AS scenario_status,
      {r.case_map('shareholder_marital_status', codes.MARITAL_STATUS, 'NULL')} AS marital,
      {r.case_map('person_type', codes.PERSON_ID_TYPES, 'NULL')} AS id_type
    FROM {{parties}}""",
)
def status_codes(t):
    """MAP1 to MAP3, BOO2, BOO3."""
    c = F.col
    return t["parties"].select(
        "id",
        codes.active_text(c("active")).alias("status"),
        codes.order_status_text(c("id") % 7).alias("order_status"),
        codes.status_number(F.lit(None), c("active")).alias("status_number"),
        codes.scenario_status((c("id") % 12).cast("int")).alias("scenario_status"),
        codes.marital_label(c("shareholder_marital_status")).alias("marital"),
        codes.person_id_type(c("person_type")).alias("id_type"),
    )


# Golden records.

CLEAN_PARTIES = f"""clean_parties AS (
  SELECT id AS record_id, coalesce(code, 0) AS code,
    coalesce({r.tax_id('tax_id')}, '00000000000000') AS tax_id,
    {r.clean('state_registration', 20)} AS state_registration,
    {r.clean('municipal_registration', 20)} AS municipal_registration,
    {r.clean('legal_name', 255)} AS legal_name, {r.clean('trade_name', 255)} AS trade_name,
    CASE WHEN active THEN 'active' ELSE 'inactive' END AS status, created_at,
    coalesce(updated_at, created_at) AS updated_at
  FROM wanted_parties WHERE {r.clean('legal_name', 255)} IS NOT NULL),
keyed_parties AS (
  SELECT *, CASE WHEN regexp_full_match(tax_id, '[0-9]{{14}}') AND tax_id <> '00000000000000'
    THEN tax_id ELSE '__id_' || record_id END AS merge_key FROM clean_parties)""".replace(
    "{{14}}", "{14}"
)

ALL_PARTIES = "wanted_parties AS (SELECT * FROM {parties})"

GOLDEN_COLUMNS = (
    "state_registration", "municipal_registration", "legal_name", "trade_name", "status",
    "created_at", "updated_at",
)

_MERGED = ", ".join(
    f"arg_min({c}, record_id) FILTER ({c} IS NOT NULL) AS {c}" for c in GOLDEN_COLUMNS
)

GOLDEN = f"""{CLEAN_PARTIES}, golden AS (
  SELECT merge_key, {r.key('customer', 'merge_key')} AS id, min(record_id) AS record_id,
    arg_min(code, record_id) AS code, count(*) AS id_count, min(tax_id) AS raw_tax_id,
    string_agg(CAST(record_id AS VARCHAR), ',' ORDER BY record_id) AS legacy_ids, {_MERGED}
  FROM keyed_parties GROUP BY merge_key),
golden_customers AS (
  SELECT *, CASE WHEN raw_tax_id <> '00000000000000' THEN 'valid' ELSE 'invalid' END AS tax_id_status,
    CASE WHEN raw_tax_id = '00000000000000'
      THEN {r.synthetic_tax_id("'(' || record_id || ',)'")} ELSE raw_tax_id END AS tax_id
  FROM golden)"""


@check(
    "golden_customers",
    f"""WITH {ALL_PARTIES}, {GOLDEN}
    SELECT id, record_id, code, id_count, tax_id, tax_id_status, {', '.join(GOLDEN_COLUMNS)}
    FROM golden_customers""",
)
def golden_customers(t):
    """AGG5, STR22 to STR24."""
    return customers.golden_customers(t["parties"]).select(
        "id", "record_id", "code", "id_count", "tax_id", "tax_id_status", *GOLDEN_COLUMNS
    )


@check(
    "golden_keymap",
    f"""WITH {ALL_PARTIES}, {CLEAN_PARTIES}
    SELECT record_id AS legacy_id, {r.key('customer', 'merge_key')} AS id FROM keyed_parties""",
)
def golden_keymap(t):
    """RSH11 and JOI4."""
    return customers.customer_keys(t["parties"])


@check(
    "golden_id_chunks",
    f"""WITH {ALL_PARTIES}, {CLEAN_PARTIES}
    SELECT {r.key('customer', 'merge_key')} AS id, record_id // 100 AS chunk,
      string_agg(CAST(record_id AS VARCHAR), ',' ORDER BY record_id) AS legacy_ids
    FROM keyed_parties GROUP BY ALL""",
)
def golden_id_chunks(t):
    """ARR3 in arrays of bounded size."""
    return golden.chunked_ids(customers.customer_keys(t["parties"]), width=100)


@check(
    "golden_totals",
    f"""WITH {ALL_PARTIES}, {GOLDEN}
    SELECT count(*) AS rows, CAST(sum(id_count) AS BIGINT) AS ids,
      CAST(greatest(0, sum(id_count) - count(*)) AS BIGINT) AS merged FROM golden_customers""",
)
def golden_totals(t):
    """AGG12 and ARR2."""
    chunks = golden.chunked_ids(customers.customer_keys(t["parties"]))
    return rollup.array_totals(customers.golden_customers(t["parties"]), chunks, "legacy_ids")


@check(
    "golden_group_totals",
    f"""WITH {ALL_PARTIES}, {GOLDEN}
    SELECT count(*) AS rows, CAST(sum(id_count) AS BIGINT) AS ids,
      CAST(greatest(0, sum(id_count) - count(*)) AS BIGINT) AS merged FROM golden_customers""",
)
def golden_group_totals(t):
    """AGG12 and VAL2 counted over the key map."""
    return golden.totals(
        customers.golden_customers(t["parties"]), customers.customer_keys(t["parties"])
    )


@check(
    "charge_row_count",
    f"""SELECT count(*) FILTER ({reshape.CHARGE_AMOUNTS[0]} > 0 OR coalesce(equipment_charged, FALSE))
      {' '.join(f'+ count(*) FILTER ({a} > 0)' for a in reshape.CHARGE_AMOUNTS[1:])} AS rows
    FROM {{contract_master}}""",
)
def charge_row_count(t):
    """AGG7."""
    return rollup.count_charges(t["contract_master"])


@check(
    "synthetic_ids",
    f"""SELECT o_custkey, {r.synthetic_tax_id("'(' || lo || CASE WHEN lo = hi THEN ',)' ELSE ', ' || hi || ')' END")} AS tax_id
    FROM (SELECT o_custkey, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM {{orders}}
      GROUP BY o_custkey) x""",
)
def synthetic_ids(t):
    """STR22 for single ids and pairs."""
    ends = t["orders"].groupBy("o_custkey").agg(
        F.array_distinct(F.array(F.min("o_orderkey"), F.max("o_orderkey"))).alias("ids")
    )
    return ends.select(
        "o_custkey", keys.synthetic_tax_id(keys.id_tuple_text(F.col("ids"))).alias("tax_id")
    )


# Reshapes.


@check(
    "processed_stores",
    f"""SELECT s.id, {r.clean('s.name')} AS name, {r.tax_id('s.tax_id')} AS tax_id, s.brand_id,
      {r.key('brand', 'b.id')} AS brand_key FROM (
        SELECT id, name, tax_id, CAST(brand_id AS DOUBLE) AS brand_id FROM {{store_records}}) s
    JOIN {{brands}} b ON b.id = s.brand_id
    UNION ALL SELECT id, {r.clean('name')}, {r.tax_id('tax_id')}, CAST(brand_id AS DOUBLE), NULL
    FROM {{store_records}} WHERE brand_id IS NULL OR brand_id NOT IN (SELECT id FROM {{brands}})""",
)
def processed_stores(t):
    """PRJ3."""
    brands = t["brands"].select(
        F.col("id").alias("legacy_id"), keys.surrogate_key("brand", F.col("id")).alias("id")
    )
    done = reshape.process_columns(
        t["store_records"].select("id", "name", "tax_id", "brand_id"),
        {"name": text.clean_text, "tax_id": text.tax_id},
        {"brand_key": ("brand_id", brands)},
    )
    return done.withColumn("brand_id", F.col("brand_id").cast("double"))



@check(
    "contacts_unpivot",
    f"""SELECT id, 'email' AS type, lower({r.strip('email')}) AS value FROM {{parties}}
      WHERE {r.filled('email')}
    UNION ALL SELECT id, 'phone', {_D('phone')} FROM {{parties}} WHERE {_D('phone')} <> ''
    UNION ALL SELECT id, 'cellphone', {_D('cellphone')} FROM {{parties}}
      WHERE {_D('cellphone')} <> ''""",
)
def contacts_unpivot(t):
    """RSH1 and STR9."""
    return reshape.contact_rows(t["parties"], ["id"])


def address_sql(source: str, prefix: str, kind: str, position: bool, extra: str) -> str:
    def text_or(c: str, n: int, default: str) -> str:
        return f"coalesce({r.clean(prefix + c, n)}, '{default}')"

    latitude = r.comma_number(prefix + "latitude") if position else "CAST(NULL AS DOUBLE)"
    longitude = r.comma_number(prefix + "longitude") if position else "CAST(NULL AS DOUBLE)"
    return f"""SELECT {extra}, '{kind}' AS type,
      coalesce({r.tax_id(prefix + 'postal_code')}, '00000000') AS postal_code,
      {text_or('street', 500, '')} AS street, {text_or('number', 20, 'S/N')} AS number,
      {r.clean(prefix + 'address_line_2', 200)} AS address_line_2,
      {text_or('neighborhood', 100, '')} AS neighborhood, {text_or('city', 100, '')} AS city,
      {text_or('state', 2, '')} AS state, {latitude} AS latitude, {longitude} AS longitude,
      {text_or('neighborhood', 100, '')} AS zone, '' AS region
    FROM {source} WHERE {r.filled(prefix + 'street')}"""


@check(
    "addresses_unpivot",
    f"""{address_sql('{parties}', 'main_', 'main', True, 'id')}
    UNION ALL {address_sql('{parties}', 'billing_', 'billing', False, 'id')}""",
)
def addresses_unpivot(t):
    """RSH2, STR5, STR10, NUM8."""
    rows = reshape.address_rows(t["parties"], ["id"], customers.ADDRESS_GROUPS)
    return rows.drop("raw_city", "raw_state", "raw_place_code")


_SWITCH = "coalesce(equipment_charged, FALSE)"


def charges_sql(source: str, extra: str) -> str:
    parts = []
    for i, amount in enumerate(reshape.CHARGE_AMOUNTS):
        kept = f"({amount} > 0 OR {_SWITCH})" if i == 0 else f"{amount} > 0"
        first = "equipment_start_at, " if i == 0 else ""
        parts.append(
            f"SELECT {extra}, {i + 1} AS position, CAST(coalesce({amount}, 0) AS DOUBLE) AS amount, "
            f"'other' AS charge_type, 'monthly' AS billing_model, "
            f"CAST(CAST(coalesce({first}created_at, updated_at, {r.NOW}) AS DATE) AS VARCHAR) "
            f"AS start_date FROM {source} WHERE {kept}"
        )
    return " UNION ALL ".join(parts)


@check("charges_unpivot", charges_sql("{contract_master}", "contract_id"))
def charges_unpivot(t):
    """RSH3 and DAT3."""
    return reshape.charge_rows(t["contract_master"], ["contract_id"], r.RUN_TS)


@check(
    "charge_counts",
    f"""SELECT count(*) AS rows, count(*) FILTER ({' OR '.join(f'{a} > 0' for a in reshape.CHARGE_AMOUNTS)}
        OR {_SWITCH}) AS charged, {', '.join(f'count(*) FILTER ({a} > 0) AS {a}' for a in reshape.CHARGE_AMOUNTS)}
    FROM {{contract_master}}""",
)
def charge_counts(t):
    """FIL7 and AGG7."""
    amounts = {a: F.col(a) > 0 for a in reshape.CHARGE_AMOUNTS}
    charged = reshape.any_positive(reshape.CHARGE_AMOUNTS, F.col("equipment_charged"))
    return rollup.count_when(t["contract_master"], {"charged": charged, **amounts})


@check(
    "seller_pairs",
    """WITH x AS (SELECT contract_id, CASE WHEN contract_id % 3 = 0 THEN seller_id END AS f,
      CASE WHEN contract_id % 4 = 0 THEN seller_id + 1 END AS h FROM {contract_master})
    SELECT contract_id, 'farmer' AS seller_type, coalesce(f, h, -1) AS user_id FROM x
    UNION ALL SELECT contract_id, 'hunter', coalesce(h, f, -1) FROM x""",
)
def seller_pairs(t):
    """RSH4."""
    pairs = t["contract_master"].select(
        "contract_id",
        F.when(F.col("contract_id") % 3 == 0, F.col("seller_id")).alias("f"),
        F.when(F.col("contract_id") % 4 == 0, F.col("seller_id") + 1).alias("h"),
    )
    return reshape.seller_rows(pairs, ["contract_id"], "f", "h", F.lit(-1))


@check(
    "name_pairs",
    f"""WITH x AS (SELECT line_id, store_id, {r.clean('customer_name')} AS a,
      {r.clean('system_name')} AS b FROM {{contract_lines}})
    SELECT line_id, store_id, a AS name FROM x WHERE a IS NOT NULL
    UNION ALL SELECT line_id, store_id, b FROM x WHERE a IS NOT NULL AND b <> a""",
)
def name_pairs(t):
    """RSH5."""
    return reshape.name_rows(
        t["contract_lines"], ["line_id", "store_id"], "customer_name", "system_name"
    )


_EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z][a-zA-Z]+"


def emails_sql(extra: str) -> str:
    parts = []
    for column, kind in reshape.EMAIL_COLUMNS.items():
        if column == reshape.EMAIL_LIST_COLUMN:
            found = f"SELECT *, lower({r.strip('part')}) AS found FROM (SELECT *, unnest(string_split({column}, ',')) AS part FROM {{parties}}) y"
        else:
            found = f"SELECT *, lower({r.clean(column)}) AS found FROM {{parties}}"
        parts.append(
            f"SELECT {extra}, '{kind}' AS email_type, found AS email FROM ({found}) x "
            f"WHERE regexp_full_match(found, '{_EMAIL}')"
        )
    return " UNION ALL ".join(parts)


@check("email_split", emails_sql("id"))
def email_split(t):
    """RSH6, RSH7, STR8, FIL8."""
    return reshape.email_rows(t["parties"], ["id"])


def phone_parts(x: str) -> tuple[str, str]:
    good = f"length({r.tax_id(x)}) IN (10, 11)"
    return (
        f"(CASE WHEN {good} THEN substr({_D(x)}, 1, 2) END)",
        f"(CASE WHEN {good} THEN substr({_D(x)}, 3) END)",
    )


def phones_sql(extra: str) -> str:
    parts = []
    for column, kind in reshape.PHONE_COLUMNS.items():
        area, rest = phone_parts(column)
        parts.append(
            f"SELECT {extra}, '{kind}' AS phone_type, '55' AS country_code, {area} AS area_code, "
            f"{rest} AS number FROM {{parties}} WHERE {column} <> ''"
        )
    return " UNION ALL ".join(parts)


@check("phone_parts", phones_sql("id"))
def phone_rows(t):
    """RSH8 and STR7."""
    return reshape.phone_rows(t["parties"], ["id"])


def people_sql(extra: str) -> str:
    return f"""SELECT {extra}, 1 AS position, {r.clean('contact_person')} AS contact_name,
      {r.clean('contact_job', 200)} AS job_title, {r.clean('notes')} AS comment FROM {{parties}}
      WHERE {r.clean('contact_person')} IS NOT NULL
    UNION ALL SELECT {extra}, 2, {r.clean('buyer')}, {r.clean('buyer_job', 200)},
      CAST(NULL AS VARCHAR) FROM {{parties}} WHERE {r.clean('buyer')} IS NOT NULL"""


@check("contact_people", people_sql("id"))
def contact_people(t):
    """RSH10."""
    return reshape.person_rows(t["parties"], ["id"])
