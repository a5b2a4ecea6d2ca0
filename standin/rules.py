"""The expression rules as DuckDB SQL text, written on their own for the expected results."""

from __future__ import annotations

from ledgerloom.functions import codes, text

RUN_TS = "2024-01-01 00:00:00"
NOW = f"TIMESTAMP '{RUN_TS}'"
TODAY = "DATE '2024-01-01'"
NOTICE_MIN, START_MAX, STATUSES = "1997-01-01", "2000-06-30", (6, 7, 8)

SCOPED = f"""
SELECT * FROM {{contract_lines}}
WHERE (CAST(notice_at AS DATE) >= DATE '{NOTICE_MIN}' OR notice_at IS NULL)
  AND CAST(start_at AS DATE) <= DATE '{START_MAX}' AND status IN {STATUSES}
"""


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {quoted(text.WHITESPACE)})"


def filled(x: str) -> str:
    return f"({x} IS NOT NULL AND {strip(x)} <> '')"


def clean(x: str, n: int | None = None) -> str:
    s = strip(x)
    cut = f"substr({s}, 1, {n})" if n else s
    return f"(CASE WHEN lower({s}) NOT IN ('', 'null', 'none') THEN {cut} END)"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def tax_id(x: str) -> str:
    return f"(CASE WHEN ltrim({digits(x)}, '0') <> '' THEN {digits(x)} END)"


def number(x: str) -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return (
        f"(CASE WHEN regexp_full_match({strip(x)}, {quoted(pattern)}) "
        f"THEN TRY_CAST({strip(x)} AS DOUBLE) END)"
    )


def comma_number(x: str) -> str:
    return number(f"replace({x}, ',', '.')")


def fold_name(x: str) -> str:
    # The rule upper-cases a sharp s to SS, DuckDB's upper to one capital letter.
    plain = f"strip_accents(upper(replace({strip(x)}, 'ß', 'ss')))"
    kept = f"regexp_replace({plain}, '[^A-Z0-9 ]+', '', 'g')"
    return f"coalesce(trim(regexp_replace({kept}, ' +', ' ', 'g')), '')"


def place_code(x: str) -> str:
    return f"TRY_CAST(nullif(substr({digits(x)}, 1, 10), '') AS BIGINT)"


def task_name(x: str) -> str:
    return f"regexp_replace(upper({clean(x)}), '\\s+', ' ', 'g')"


def case_map(x: str, table: dict, default: str) -> str:
    def lit(v) -> str:
        return quoted(v) if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items())
    return f"(CASE {x} {whens} ELSE {default} END)"


def task_type(x: str) -> str:
    return case_map(x, text.TASK_TYPES, "'undefined'")


def snake(x: str, default: str) -> str:
    s = f"replace(replace(lower({clean(x)}), '-', '_'), ' ', '_')"
    s = f"regexp_replace(regexp_replace({s}, '[^a-z0-9_]+', '', 'g'), '_+', '_', 'g')"
    return f"coalesce(nullif(trim({s}, '_'), ''), '{default}')"


def safe_bool(x: str, default: str) -> str:
    s = f"lower({strip(x)})"
    return (
        f"(CASE WHEN {s} IN {codes.TRUE_WORDS} THEN TRUE WHEN {s} IN {codes.FALSE_WORDS} "
        f"THEN FALSE ELSE {default} END)"
    )


def whole(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({strip(x)}, '[+-]?[0-9]+') THEN TRY_CAST({strip(x)} AS INT) END)"


def key(entity: str, *parts: str) -> str:
    cells = ", ".join(
        f"coalesce(CAST(length(CAST({p} AS VARCHAR)) AS VARCHAR) || ':' || CAST({p} AS VARCHAR), '-')"
        for p in parts
    )
    layout = "'^(.{8})(.{4})(.{4})(.{4})(.{12})$'"
    return (
        f"regexp_replace(md5(concat('{entity}|', {cells})), {layout}, "
        r"'\1-\2-\3-\4-\5')"
    )


def synthetic_tax_id(tuple_text: str) -> str:
    chunks = [
        f"CAST('0x' || substr(sha256({tuple_text}), {i * 4 + 1}, 4) AS BIGINT)" for i in range(16)
    ]
    folded = chunks[0]
    for chunk in chunks[1:]:
        folded = f"(({folded} * 65536 + {chunk}) % 10000000000000)"
    return f"'9' || lpad(CAST({folded} AS VARCHAR), 13, '0')"


def rate(price: str, frequency: str, hours: str) -> str:
    monthly = (
        f"(coalesce({comma_number(frequency)}, 0.0) * coalesce({comma_number(hours)}, 0.0) * 4.0)"
    )
    quotient = f"coalesce(CAST({price} AS DOUBLE), 0.0) / nullif({monthly}, 0.0)"
    rounded = f"CAST(round_even(CAST({quotient} AS DECIMAL(38,10)), 2) AS DECIMAL(18,2))"
    return f"coalesce({rounded}, CAST(0 AS DECIMAL(18,2)))"


def frequency_key(x: str) -> str:
    n = number(x)
    return (
        f"(CASE WHEN {n} = floor({n}) THEN CAST(CAST({n} AS BIGINT) AS VARCHAR) "
        f"ELSE coalesce(CAST({n} AS VARCHAR), {x}, '') END)"
    )


def hours_key(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN '0.0' ELSE coalesce(CAST({comma_number(x)} AS VARCHAR), '') END)"


def frequency_label(x: str) -> str:
    n = number(x)
    exact = case_map(n, codes.FREQUENCY_LABELS, "NULL")
    near = case_map(f"round_even({n}, 0)", codes.FREQUENCY_LABELS, "''")
    return f"coalesce({exact}, {near})"


def first_rows(source: str, keys: str, order: str) -> str:
    """Rows of ``source`` that come first within their key."""
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS rn FROM ({source}) src) ranked WHERE rn = 1"
    )
