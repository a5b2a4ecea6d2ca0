"""Billings (PIP17): one per customer, and the billing of every contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, keys, text
from ledgerloom.operators import load, match, rollup
from ledgerloom.sources.schemas import conform

# Name of a customer without any, and the terms of a placeholder row.
UNNAMED = "Customer"
PLACEHOLDER_NAME = "Placeholder - Migração"


def contracts_to_bill(
    lines: DataFrame, wanted: DataFrame, customer_key_rows: DataFrame
) -> DataFrame:
    """AGG19 + JOI4: (contract, golden customer, name) of the contracts in the billing scope."""
    scoped = match.within(lines, wanted.select("contract_id"), ["contract_id"])
    named = rollup.customer_of_contract(scoped).withColumnRenamed("customer_id", "legacy_id")
    return match.map_key(named, customer_key_rows, "legacy_id", "customer_id")


def billings(
    billed: DataFrame, sheet_terms: DataFrame, customer_rows: DataFrame, run_ts: str
) -> DataFrame:
    """WIN3: the first contract of each customer gives the billing row.

    ``billed`` comes from ``contracts_to_bill``; ``customer_rows`` gives the display names.
    """
    first = match.first_per_key(
        billed.select("customer_id", "contract_id", "customer_name"),
        ["customer_id"],
        ["contract_id"],
    )
    with_sheet = match.left_lookup(first, sheet_terms, ["contract_id"])
    display = customer_rows.select(F.col("id").alias("customer_id"), "trade_name", "legal_name")
    shown = match.left_lookup(with_sheet, display, ["customer_id"])
    name = text.first_filled(
        F.col("customer_name"), F.col("sheet_name"), F.col("trade_name"), F.col("legal_name"),
        F.lit(UNNAMED),
    )
    now = dates.run_timestamp(run_ts)
    rows = shown.select(
        keys.surrogate_key("billing", F.col("customer_id")).alias("id"),
        "customer_id",
        F.substring(name, 1, 500).alias("name"),
        F.coalesce(F.col("sheet_active"), F.lit(True)).alias("is_active"),
        now.alias("created_at"),
        now.alias("updated_at"),
        text.calculation_type(F.col("sheet_calculation")).alias("calculation_type"),
        F.coalesce(F.col("sheet_billing_day"), F.lit(1)).alias("contract_parameters_billing_day"),
        F.coalesce(F.col("sheet_due_day"), F.lit(1)).alias("contract_parameters_due_day"),
        text.snake_case(F.col("sheet_billing_type"), codes.BILLING_TYPE).alias(
            "contract_parameters_billing_type"
        ),
        text.snake_case(F.col("sheet_thirteenth_type"), codes.THIRTEENTH_SALARY_TYPE).alias(
            "contract_parameters_thirteenth_salary_type"
        ),
    )
    return conform(rows, "billings")


def load_billings(
    existing: DataFrame | None, incoming: DataFrame, policy: load.LoadPolicy, restricted: bool
) -> DataFrame:
    """LOD8 + LOD9: clear by policy, then add the customers that have no billing left.

    A restricted run removes the billings of its own customers only.
    """
    if existing is None or policy.clear or not restricted:
        return load.replace_all(incoming)
    return load.replace_by_key(existing, incoming, incoming, ["customer_id"])


def placeholder_rows(existing: DataFrame, contract_rows: DataFrame, run_ts: str) -> DataFrame:
    """LOD10: a placeholder billing for every customer that has none."""
    now = dates.run_timestamp(run_ts)
    owners = contract_rows.filter(F.col("customer_id").isNotNull())
    added = load.placeholders(
        owners,
        existing,
        "customer_id",
        {
            "id": keys.surrogate_key("billing", F.col("customer_id")),
            "name": F.lit(PLACEHOLDER_NAME),
            "is_active": F.lit(True),
            "created_at": now,
            "updated_at": now,
            "calculation_type": F.lit(""),
            "contract_parameters_billing_day": F.lit(0),
            "contract_parameters_due_day": F.lit(0),
            "contract_parameters_billing_type": F.lit(""),
            "contract_parameters_thirteenth_salary_type": F.lit(""),
        },
    )
    return conform(added, "billings")


def with_placeholders(existing: DataFrame, contract_rows: DataFrame, run_ts: str) -> DataFrame:
    """LOD9 / LOD10: existing billings and those placeholders."""
    return existing.unionByName(placeholder_rows(existing, contract_rows, run_ts))


def computed_billings(contract_rows: DataFrame) -> DataFrame:
    """LOD10 without a join: contract -> billing of its customer, with the contract's legacy id.

    Every customer with a contract has a billing, by placeholder if need be, and a billing's id is
    that of its customer, so the billings need not be read. ``match.orphans`` shows contracts loaded
    after the billings.
    """
    return contract_rows.filter(F.col("customer_id").isNotNull()).select(
        F.col("legacy_id").alias("contract_legacy_id"), F.col("id").alias("contract_id"),
        keys.surrogate_key("billing", F.col("customer_id")).alias("billing_id"),
    )


def contract_billings(contract_rows: DataFrame, billing_rows: DataFrame) -> DataFrame:
    """LOD10: contract -> billing of its customer, with the contract's legacy id."""
    owned = contract_rows.select(
        F.col("legacy_id").alias("contract_legacy_id"), F.col("id").alias("contract_id"),
        "customer_id",
    )
    return load.map_through(owned, billing_rows, "customer_id", "billing_id").drop("customer_id")
