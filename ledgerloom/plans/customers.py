"""Customers (PIP1-PIP6): segments, golden customers, addresses, contacts, brands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, keys, text
from ledgerloom.operators import golden, match, reshape
from ledgerloom.operators.scope import ScopeParams, in_scope
from ledgerloom.sources.schemas import conform

OWNER = "Customer"

# Address column prefix -> address type.
ADDRESS_GROUPS = {"main_": "main", "billing_": "billing"}

MERGED_COLUMNS = (
    "tax_id", "state_registration", "municipal_registration", "legal_name", "trade_name",
    "simple_opt", "status", "created_at", "updated_at",
)


def segments(source: DataFrame, wanted: DataFrame | None, entity: str, table: str) -> DataFrame:
    """PIP1 / PIP7: named segments, restricted to the wanted ids when there are any."""
    kept = source if wanted is None else match.within(source, wanted.toDF("id"), ["id"])
    cut = 255 if table == "customer_segments" else None
    rows = kept.select(
        keys.surrogate_key(entity, F.col("id")).alias("id"),
        text.clean_text(F.col("name"), cut).alias("name"),
        codes.flag(F.col("active")).alias("is_active"),
        "created_at",
        dates.changed_at(F.col("updated_at"), F.col("created_at")).alias("updated_at"),
        F.col("id").alias("legacy_id"),
    )
    return conform(rows.filter(F.col("name").isNotNull()), table)


def customer_segments(source: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """PIP1."""
    return segments(source, wanted, "customer_segment", "customer_segments")


def customer_scope(lines: DataFrame, params: ScopeParams) -> DataFrame:
    """Distinct customers of the lines in scope."""
    scoped = in_scope(lines, params).filter(F.col("customer_id").isNotNull())
    return scoped.select("customer_id").distinct()


def clean_parties(parties: DataFrame) -> DataFrame:
    """Cleaned party records; those without a legal name are dropped (FIL10)."""
    cleaned = parties.select(
        F.col("id").alias("record_id"),
        F.coalesce(F.col("code").cast("bigint"), F.lit(0).cast("bigint")).alias("code"),
        F.coalesce(text.tax_id(F.col("tax_id")), F.lit(text.DEFAULT_TAX_ID)).alias("tax_id"),
        text.clean_text(F.col("state_registration"), 20).alias("state_registration"),
        text.clean_text(F.col("municipal_registration"), 20).alias("municipal_registration"),
        text.clean_text(F.col("legal_name"), 255).alias("legal_name"),
        text.clean_text(F.col("trade_name"), 255).alias("trade_name"),
        F.lit(False).alias("simple_opt"),
        codes.active_text(F.col("active")).alias("status"),
        "created_at",
        dates.changed_at(F.col("updated_at"), F.col("created_at")).alias("updated_at"),
    )
    return cleaned.filter(F.col("legal_name").isNotNull())


def _wanted_parties(parties: DataFrame, wanted: DataFrame | None) -> DataFrame:
    if wanted is None:
        return clean_parties(parties)
    return clean_parties(match.within(parties, wanted.toDF("id"), ["id"]))


def customer_keys(parties: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """JOI4: legacy customer id -> golden customer id, a projection of the cleaned records."""
    return conform(golden.merged_ids(_wanted_parties(parties, wanted)), "customer_legacy_ids")


def golden_customers(parties: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Golden records with unique tax ids."""
    merged = golden.merge_records(_wanted_parties(parties, wanted), MERGED_COLUMNS)
    unique = golden.with_unique_tax_id(merged)
    return unique.withColumn("id", golden.golden_id(F.col("merge_key")))


def customers(parties: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """PIP2. The legacy ids behind a record are the rows of ``customer_keys``."""
    rows = golden_customers(parties, wanted)
    return conform(
        rows.withColumnsRenamed({"tax_id": "cnpj", "tax_id_status": "cnpj_status"}), "customers"
    )


def addresses(parties: DataFrame, customer_key_rows: DataFrame, places: DataFrame) -> DataFrame:
    """PIP3: the first main and billing address of each customer."""
    owned = match.map_key(
        parties.withColumnRenamed("id", "legacy_id"), customer_key_rows, "legacy_id", "owner_id"
    )
    keep = ["owner_id", "legacy_id", "created_at", "updated_at"]
    rows = reshape.address_rows(owned, keep, ADDRESS_GROUPS)
    placed = reshape.placed_addresses(rows, places, "owner_id", ["legacy_id"])
    return address_table(placed, OWNER)


def address_table(placed: DataFrame, owner_type: str) -> DataFrame:
    rows = placed.withColumns(
        {
            "id": keys.surrogate_key(
                "address", F.lit(owner_type), F.col("owner_id"), F.col("type")
            ),
            "addressable_id": F.col("owner_id"),
            "addressable_type": F.lit(owner_type),
            "updated_at": dates.changed_at(F.col("updated_at"), F.col("created_at")),
        }
    )
    return conform(rows, "addresses")


def contacts(records: DataFrame, key_rows: DataFrame, owner_type: str = OWNER) -> DataFrame:
    """PIP4 / PIP13: e-mail, phone and cellphone of each owner as typed rows."""
    owned = match.map_key(
        records.withColumnRenamed("id", "legacy_id"), key_rows, "legacy_id", "contactable_id"
    )
    keep = ["contactable_id", "legacy_id", "created_at", "updated_at"]
    rows = reshape.contact_rows(owned, keep).withColumns(
        {
            "id": keys.surrogate_key(
                "contact", F.lit(owner_type), F.col("legacy_id"), F.col("type")
            ),
            "contactable_type": F.lit(owner_type),
            "updated_at": dates.changed_at(F.col("updated_at"), F.col("created_at")),
        }
    )
    return conform(rows, "contacts")


def _brand_key(name: Column) -> Column:
    return keys.surrogate_key("customer_brand", name)


def customer_brands(
    lines: DataFrame, segment_rows: DataFrame, params: ScopeParams, run_ts: str
) -> DataFrame:
    """PIP5: distinct customer names in scope, all in the segment with the smallest legacy id."""
    names = (
        in_scope(lines, params)
        .select("customer_name")
        .distinct()
        .filter(text.not_blank(F.col("customer_name")))
        .select(F.substring(text.strip(F.col("customer_name")), 1, 255).alias("name"))
        .distinct()
    )
    default_segment = segment_rows.agg(F.min_by("id", "legacy_id")).scalar()
    now = dates.run_timestamp(run_ts)
    rows = names.select(
        _brand_key(F.col("name")).alias("id"),
        "name",
        default_segment.alias("customer_segment_id"),
        F.lit(True).alias("is_active"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    return conform(rows, "customer_brands")


def customer_customer_brand(
    lines: DataFrame, customer_key_rows: DataFrame, brand_rows: DataFrame, params: ScopeParams
) -> DataFrame:
    """PIP6: distinct (golden customer, brand) pairs of the lines in scope."""
    pairs = (
        in_scope(lines, params)
        .select("customer_id", "customer_name")
        .distinct()
        .filter(F.col("customer_id").isNotNull() & text.not_blank(F.col("customer_name")))
        .select("customer_id", text.strip(F.col("customer_name")).alias("name"))
        .distinct()
    )
    owned = match.map_key(
        pairs.withColumnRenamed("customer_id", "legacy_id"), customer_key_rows, "legacy_id",
        "customer_id",
    )
    named = brand_rows.select(F.col("id").alias("customer_brand_id"), "name")
    linked = owned.join(named, "name").select("customer_id", "customer_brand_id").distinct()
    return conform(linked, "customer_customer_brand")
