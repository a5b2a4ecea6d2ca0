"""Stores (PIP7-PIP13): segments, chains, brands, stores, tax ids, addresses, contacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, keys, text
from ledgerloom.operators import match, reshape
from ledgerloom.plans import customers as customer_plans
from ledgerloom.sources.schemas import conform

OWNER = "Store"

# Defaults of missing codes.
MISSING_BRAND_CODE = "empty"
MISSING_CODE = ""


def _dated(df: DataFrame, entity: str, *columns) -> DataFrame:
    """The columns every store entity has: key, activity, dates, legacy id."""
    return df.select(
        keys.surrogate_key(entity, F.col("id")).alias("id"),
        *columns,
        codes.flag(F.col("active")).alias("is_active"),
        "created_at",
        dates.changed_at(F.col("updated_at"), F.col("created_at")).alias("updated_at"),
        F.col("id").alias("legacy_id"),
    )


def _wanted(df: DataFrame, ids: DataFrame) -> DataFrame:
    """JOI11: rows whose id is among the ids the scope names."""
    return match.within(df, ids.toDF("id"), ["id"])


def store_segments(channels: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """PIP7: the channels of the stores in scope."""
    return customer_plans.segments(channels, wanted, "store_segment", "store_segments")


def retail_chains(chains: DataFrame, wanted: DataFrame) -> DataFrame:
    """PIP8."""
    rows = _dated(
        _wanted(chains, wanted),
        "retail_chain",
        text.clean_text(F.col("name")).alias("name"),
        text.code_text(F.col("code"), MISSING_CODE).alias("description"),
    )
    return conform(rows.filter(F.col("name").isNotNull()), "retail_chains")


def store_brands(
    brands: DataFrame,
    wanted: DataFrame,
    store_records: DataFrame,
    chain_rows: DataFrame,
    segment_rows: DataFrame,
) -> DataFrame:
    """PIP9: brands with their chain and the segment of their smallest channel.

    A brand without a loaded chain is rejected; one without a segment gets the segment with the
    smallest legacy id.
    """
    named = _dated(
        _wanted(brands, wanted),
        "store_brand",
        text.clean_text(F.col("name")).alias("description"),
        text.code_text(F.col("code"), MISSING_BRAND_CODE).alias("abras_code"),
        F.col("chain_id"),
    ).filter(F.col("description").isNotNull())
    chained = match.map_key(named, match.key_map(chain_rows), "chain_id", "retail_chain_id")

    channels = match.brand_channels(store_records).select(
        F.col("brand_id").alias("legacy_id"), "channel_id"
    )
    segment_keys = match.key_map(segment_rows).select(
        F.col("legacy_id").alias("channel_id"), F.col("id").alias("_segment")
    )
    found = match.left_lookup(chained, channels, ["legacy_id"])
    found = match.left_lookup(found, segment_keys, ["channel_id"])
    default = segment_rows.agg(F.min_by("id", "legacy_id")).scalar()
    return conform(
        found.withColumn("store_segment_id", F.coalesce(F.col("_segment"), default)),
        "store_brands",
    )


def stores(store_records: DataFrame, wanted: DataFrame, brand_rows: DataFrame) -> DataFrame:
    """PIP10: stores in scope whose brand is loaded."""
    named = _dated(
        _wanted(store_records, wanted),
        "store",
        text.clean_text(F.col("name"), 255).alias("name"),
        text.code_text(F.col("code"), MISSING_CODE).alias("code"),
        F.col("brand_id"),
    ).filter(F.col("name").isNotNull())
    branded = match.map_key(named, match.key_map(brand_rows), "brand_id", "store_brand_id")
    return conform(branded, "stores")


def _owned(store_records: DataFrame, store_rows: DataFrame, target: str) -> DataFrame:
    records = store_records.withColumnRenamed("id", "legacy_id")
    return match.map_key(records, match.key_map(store_rows), "legacy_id", target)


def store_cnpjs(store_records: DataFrame, store_rows: DataFrame) -> DataFrame:
    """PIP11: the tax id of every loaded store, always its main one."""
    owned = _owned(store_records, store_rows, "store_id")
    rows = owned.select(
        keys.surrogate_key("store_cnpj", F.col("legacy_id")).alias("id"),
        text.tax_id(F.col("tax_id")).alias("cnpj"),
        F.lit(True).alias("is_main"),
        "store_id",
        codes.flag(F.col("active")).alias("is_active"),
        "created_at",
        dates.changed_at(F.col("updated_at"), F.col("created_at")).alias("updated_at"),
    )
    return conform(rows.filter(F.col("cnpj").isNotNull()), "store_cnpjs")


def addresses(store_records: DataFrame, store_rows: DataFrame, places: DataFrame) -> DataFrame:
    """PIP12: the address of every loaded store; stores have no explicit place code."""
    owned = _owned(store_records, store_rows, "owner_id").withColumn(
        "main_place_code", F.lit(None).cast("string")
    )
    keep = ["owner_id", "legacy_id", "created_at", "updated_at"]
    rows = reshape.address_rows(owned, keep, {"main_": "main"})
    placed = reshape.placed_addresses(rows, places, "owner_id", ["legacy_id"])
    return customer_plans.address_table(placed, OWNER)


def contacts(store_records: DataFrame, store_rows: DataFrame) -> DataFrame:
    """PIP13."""
    return customer_plans.contacts(store_records, match.key_map(store_rows), OWNER)
