"""Text cleaning rules (STR1-STR21) as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character the cleaning rules strip: all Unicode white space, not only ASCII blanks.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The same characters as a regular expression class.
_SPACE_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)


def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and the plain letter each decomposes to."""
    accented, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = "".join(
            c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn"
        )
        if len(base) == 1 and base != chr(code):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, UNACCENTED = _accent_table()

# Words that stand for "no value" in a text cell, in any case.
NULL_WORDS = ("null", "none")
_NULL_WORD = f"^(?i:{'|'.join(NULL_WORDS)})\\z"

# E-mail address pattern and the words written instead of an address.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
EMAIL_PLACEHOLDERS = ("pendente", "n/a", "na", "null", "none", "")

# Defaults of the mandatory address columns.
DEFAULT_POSTAL_CODE = "00000000"
DEFAULT_STREET_NUMBER = "S/N"
DEFAULT_TAX_ID = "00000000000000"

# Task name -> task type.
TASK_TYPES = {
    "CONTAGEM PDV": "undefined",
    "DESRUPTURA": "disruption",
    "ESTOQUE": "undefined",
    "GALERIA DE FOTOS": "undefined",
    "MANUTENÇÃO DE PONTO EXTRA": "extra_point_maintenance",
    "MONTAGEM PONTO EXTRA": "extra_point_assembly",
    "PESQUISA": "undefined",
    "PESQUISA CONCORRENTE": "undefined",
    "PESQUISA DE PREÇO": "undefined",
    "PONTO EXTRA": "undefined",
    "PRODUTO NA LOJA": "undefined",
    "REABASTECIMENTO & RUPTURA": "supply_and_disruption",
    "REGISTRO DE FOTOS": "undefined",
    "SHARE GONDOLA": "undefined",
    "VALIDADE": "undefined",
}
UNKNOWN_TASK_TYPE = "undefined"

# Task name -> English name.
TASK_NAMES_ENGLISH = {
    "REABASTECIMENTO": "supply_and_disruption",
    "REPOSIÇÃO": "replenishment",
    "MERCHANDISING": "merchandising",
    "PROMOÇÃO": "promotion",
    "FACING": "facing",
    "GONDOLA": "gondola",
    "EXPOSIÇÃO": "exhibition",
    "ORGANIZAÇÃO": "organization",
    "LIMPEZA": "cleaning",
    "ATENDIMENTO": "service",
    "VENDAS": "sales",
    "TREINAMENTO": "training",
    "AUDITORIA": "audit",
    "INVENTÁRIO": "inventory",
    "CONTROLE": "control",
    "VERIFICAÇÃO": "verification",
    "MONITORAMENTO": "monitoring",
    "SUPERVISÃO": "supervision",
    "GESTÃO": "management",
    "ADMINISTRAÇÃO": "administration",
}


def literal_map(table: dict) -> Column:
    """A constant text map, folded into one literal when the plan is optimised."""
    entries = "|".join(f"{key}={value}" for key, value in table.items())
    return F.str_to_map(F.lit(entries), F.lit("[|]"), F.lit("="))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def not_blank(c: Column) -> Column:
    """FIL6 / ARR5: present and not only white space; never null."""
    return c.isNotNull() & (strip(c) != "")


def clean_text(c: Column, max_length: int | None = None) -> Column:
    """STR1: strip, null words to null, cut to length."""
    cleaned = F.nullif(F.regexp_replace(strip(c), _NULL_WORD, ""), F.lit(""))
    return F.substring(cleaned, 1, max_length) if max_length else cleaned


def text_or(c: Column, max_length: int | None, default: str) -> Column:
    """STR10: a mandatory text column."""
    return F.coalesce(clean_text(c, max_length), F.lit(default))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def tax_id(c: Column) -> Column:
    """STR3: digits only; empty or all zeros is null."""
    return F.nullif(F.regexp_extract(digits(c), "^0*[1-9][0-9]*$", 0), F.lit(""))


def national_id_key(c: Column) -> Column:
    """STR4: digits padded to 11, or to 14 when longer than 11; longer ids stay as they are."""
    d = F.nullif(digits(c), F.lit(""))
    n = F.length(d)
    return F.when(n <= 11, F.lpad(d, 11, "0")).when(n <= 14, F.lpad(d, 14, "0")).otherwise(d)


def postal_code(c: Column, default: str | None = DEFAULT_POSTAL_CODE) -> Column:
    """STR5: digits; empty or all zeros is the default (null in the older model)."""
    code = tax_id(c)
    return code if default is None else F.coalesce(code, F.lit(default))


def shareholder_id(c: Column) -> Column:
    """STR6: 11 digits kept, 10 digits padded, anything else null."""
    d = tax_id(c)
    return F.when(F.length(d).isin(10, 11), F.lpad(d, 11, "0"))


def _phone_digits(c: Column) -> Column:
    return F.nullif(F.regexp_extract(tax_id(c), "^[0-9]{10,11}$", 0), F.lit(""))


def phone_area(c: Column) -> Column:
    """STR7: the first two digits of a 10 or 11 digit number."""
    return F.substring(_phone_digits(c), 1, 2)


def phone_number(c: Column) -> Column:
    """STR7: the digits after the area code."""
    return F.substring(_phone_digits(c), 3, 9)


def is_email(c: Column) -> Column:
    """STR8."""
    return c.rlike(EMAIL_PATTERN)


def email_or_null(c: Column) -> Column:
    """FIL8 + STR8: one lower-case address, null for placeholders and malformed text."""
    e = F.lower(clean_text(c))
    return F.when(~e.isin(*EMAIL_PLACEHOLDERS) & is_email(e), e)


def email_list(c: Column) -> Column:
    """RSH6: comma-separated text to an array of valid lower-case addresses."""
    parts = F.transform(F.split(c, ","), lambda e: F.lower(strip(e)))
    return F.filter(parts, lambda e: ~e.isin(*EMAIL_PLACEHOLDERS) & is_email(e))


def contact_email(c: Column) -> Column:
    """STR9: trimmed lower-case text; blank is null."""
    return F.nullif(F.lower(strip(c)), F.lit(""))


def contact_number(c: Column) -> Column:
    """RSH1: digits; none is null."""
    return F.nullif(digits(c), F.lit(""))


def fold_name(c: Column) -> Column:
    """STR11: upper case, no accents, only letters, digits and single blanks; null is ''."""
    plain = F.translate(F.upper(strip(c)), ACCENTED, UNACCENTED)
    # The rule drops every other character first, line breaks included, and then collapses blanks.
    kept = F.regexp_replace(plain, "[^A-Z0-9 ]+", "")
    return F.coalesce(F.trim(F.regexp_replace(kept, "  +", " ")), F.lit(""))


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank."""
    return F.trim(F.regexp_replace(c, f"{_SPACE_CLASS}+", " "))


def task_name(c: Column) -> Column:
    """STR12: stripped upper-case name with single blanks; blank and null words are null."""
    return squeeze(F.upper(clean_text(c)))


def task_type(clean_name: Column) -> Column:
    """STR13: task type of an upper-case task name."""
    return F.coalesce(literal_map(TASK_TYPES)[clean_name], F.lit(UNKNOWN_TASK_TYPE))


def task_name_english(c: Column) -> Column:
    """STR14: English snake_case name; null when nothing is left (callers reject those rows)."""
    upper = F.upper(strip(c))
    snake = F.btrim(F.regexp_replace(F.lower(upper), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.nullif(F.coalesce(literal_map(TASK_NAMES_ENGLISH)[upper], snake), F.lit(""))


def snake_case(c: Column, default: str) -> Column:
    """STR15: sheet cell to snake_case with a default."""
    s = F.translate(F.lower(clean_text(c)), "- ", "__")
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9_]+", ""), "_+", "_")
    return F.coalesce(F.nullif(F.btrim(s, F.lit("_")), F.lit("")), F.lit(default))


def calculation_type(c: Column) -> Column:
    """STR16: text naming 5 weeks is the five-week rule, everything else the four-week one."""
    s = F.lower(c)
    five = s.contains("5") & s.contains("week")
    return F.when(five, "five_weeks_in_month").otherwise("four_weeks_in_month")


def seller_login(c: Column) -> Column:
    """STR17: blank and the to-be-defined mark are null."""
    s = strip(c)
    return F.when((s != "") & (F.upper(s) != "#TBD"), s)


def first_filled(*cols: Column) -> Column:
    """STR20: first value that is not blank, stripped."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cols])


def code_text(c: Column, default: str) -> Column:
    """STR21: a code as text with a default for missing."""
    return F.coalesce(c.cast("string"), F.lit(default))


def join_text(c: Column) -> Column:
    """JOI7: text with its spaces removed, the form both sides are joined on."""
    return F.replace(F.trim(F.coalesce(c, F.lit(""))), F.lit(" "), F.lit(""))
