"""Sheet headers (STR18, STR19): plain text rules over ``df.columns`` at plan time."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame

# Accepted names of the contract id column, in order of preference.
CONTRACT_ID_HEADERS = ("id_orcamento", "id_orçamento", "orçamento")

# Names of the column that describes the billing calculation.
CALCULATION_HEADERS = ("tipo_faturamento_descricao", "tipo_fat_descricao")


def normalise_header(name: str) -> str:
    """Lower case, white space to single underscores, outer underscores and final colons dropped."""
    lowered = str(name).strip().lower()
    joined = re.sub(r"[\s_]+", "_", lowered).strip("_")
    return re.sub(r"[:_]*:_*$", "", joined).strip("_") or lowered


def plain_header(name: str) -> str:
    """Normalised, without a leading dash and without accents."""
    decomposed = unicodedata.normalize("NFKD", normalise_header(name).lstrip("-"))
    return "".join(c for c in decomposed if not unicodedata.combining(c))


def with_clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_header(c) for c in df.columns])


def contract_id_column(df: DataFrame) -> str | None:
    return next((h for h in CONTRACT_ID_HEADERS if h in df.columns), None)


def calculation_column(df: DataFrame) -> str | None:
    for column in df.columns:
        plain = plain_header(column)
        if plain in CALCULATION_HEADERS or (plain.startswith("tipo_fat_") and "desc" in plain):
            return column
    return None


def login_column(df: DataFrame, role: str) -> str | None:
    """The login column of a seller role; the last one wins when several match."""
    found = [c for c in df.columns if role in plain_header(c) and "login" in plain_header(c)]
    return found[-1] if found else None


def parameter_column(df: DataFrame, name: str) -> str | None:
    return next((c for c in df.columns if normalise_header(c).lstrip("-") == name), None)
