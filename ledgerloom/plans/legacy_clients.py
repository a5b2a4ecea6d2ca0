"""Older client model (PIP27): clients, addresses, contacts, e-mails, phones, shareholders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, keys, text
from ledgerloom.operators import match, reshape
from ledgerloom.sources.schemas import conform

# Address column prefix -> address type; status and owner type of loaded rows.
ADDRESS_GROUPS = {"main_": "main", "billing_": "billing"}
CLIENT_OWNER = "customers"
SHAREHOLDER_OWNER = "shareholder"
ACTIVE = "active"


def _client_id() -> Column:
    return keys.surrogate_key("client", F.col("client_id"))


def clients(parties: DataFrame) -> DataFrame:
    """Clients with cleaned ids; person type decides the kind of tax id."""
    rows = parties.select(
        keys.surrogate_key("client", F.col("id")).alias("customer_id"),
        F.col("id").alias("legado_cliente_id"),
        F.col("code").alias("legado_cliente_code"),
        text.clean_text(F.col("system_name")).alias("legado__nomesistema"),
        F.col("person_type").alias("entity_type"),
        codes.person_id_type(F.col("person_type")).alias("tax_id_type"),
        F.substring(text.tax_id(F.col("tax_id")), 1, 14).alias("tax_id"),
        codes.registration_number(F.col("state_registration")).alias("registration_state"),
        codes.registration_number(F.col("municipal_registration")).alias(
            "registration_municipal"
        ),
        text.clean_text(F.col("legal_name"), 255).alias("legal_name"),
        text.clean_text(F.col("trade_name"), 255).alias("trade_name"),
        codes.active_text(F.col("active")).alias("status"),
        "created_at",
        "updated_at",
        F.col("activated_at").alias("activated_date"),
        text.clean_text(F.col("notes")).alias("coment"),
    )
    return conform(rows, "client_customers")


def _address_entry(prefix: str, kind: str) -> dict[str, Column]:
    def column(name: str) -> Column:
        return F.col(f"{prefix}{name}")

    return {
        "address_type": F.lit(kind),
        "raw_street": column("street"),
        "raw_city": column("city"),
        "raw_state": column("state"),
        "raw_place_code": column("place_code"),
        "street": text.clean_text(column("street"), 200),
        "house_num": text.clean_text(column("number"), 20),
        "complement1": text.clean_text(column("address_line_2")),
        "district": text.clean_text(column("neighborhood")),
        "cep": text.postal_code(column("postal_code"), None),
        "city": text.clean_text(column("city")),
        "region_code": text.clean_text(column("state"), 2),
    }


def _address_table(
    df: DataFrame, places: DataFrame, groups: dict[str, str], owner_type: str
) -> DataFrame:
    keep = ["client_id", "code", "created_at", "updated_at"]
    rows = reshape.typed_rows(df, keep, [_address_entry(p, kind) for p, kind in groups.items()])
    placed = match.add_place_code(
        rows, places, "raw_state", "raw_city", "raw_place_code", "_place"
    )
    return placed.withColumns(
        {
            "address_id": keys.surrogate_key(
                "client_address", F.lit(owner_type), F.col("client_id"), F.col("address_type")
            ),
            "addressable_type": F.lit(owner_type),
            "addressable_id": F.col("client_id"),
            "legacy_cliente_id": F.col("client_id"),
            "legacy_cliente_code": F.col("code"),
            "city_code": codes.place_code_text(F.col("_place")),
            "country": F.lit(reshape.COUNTRY),
            "status": F.lit(ACTIVE),
        }
    )


def _clients(parties: DataFrame) -> DataFrame:
    return parties.withColumnRenamed("id", "client_id")


def addresses(parties: DataFrame, places: DataFrame) -> DataFrame:
    """Main and billing addresses of clients and the main address of shareholders."""
    own = _address_table(_clients(parties), places, ADDRESS_GROUPS, CLIENT_OWNER).filter(
        text.not_blank(F.col("raw_street"))
    )
    held = _address_table(
        reshape.shareholder_base(_clients(parties)), places, {"shareholder_": "main"},
        SHAREHOLDER_OWNER,
    ).filter(
        F.col("raw_street").isNotNull()
        & (F.col("raw_street") != "")
        & (F.upper(text.strip(F.col("raw_street"))) != "PENDENTE")
    )
    return conform(own, "client_addresses").unionByName(conform(held, "client_addresses"))


def contacts(parties: DataFrame) -> DataFrame:
    """RSH10 + RSH9: contact person, buyer and shareholder as contacts."""
    base = _clients(parties)
    people = reshape.person_rows(base, ["client_id", "created_at", "updated_at"]).select(
        keys.surrogate_key("client_contact", F.col("client_id"), F.col("position")).alias(
            "contact_id"
        ),
        _client_id().alias("customer_id"),
        "contact_name",
        "job_title",
        F.col("comment").alias("coment"),
        F.lit(ACTIVE).alias("status"),
        "created_at",
        "updated_at",
    )
    holders = reshape.shareholder_base(base).select(
        "contact_id",
        _client_id().alias("customer_id"),
        text.clean_text(F.col("shareholder_name")).alias("contact_name"),
        text.clean_text(F.col("shareholder_job"), 200).alias("job_title"),
        F.lit(ACTIVE).alias("status"),
        "created_at",
        "updated_at",
    )
    return conform(people, "client_contacts").unionByName(conform(holders, "client_contacts"))


def emails(parties: DataFrame) -> DataFrame:
    """RSH7."""
    rows = reshape.email_rows(_clients(parties), ["client_id", "created_at", "updated_at"])
    return conform(
        rows.withColumns(
            {
                "contact_email_id": keys.surrogate_key(
                    "client_email", F.col("client_id"), F.col("email_type"), F.col("email")
                ),
                "customer_id": _client_id(),
                "status": F.lit(ACTIVE),
            }
        ),
        "client_emails",
    )


def phones(parties: DataFrame) -> DataFrame:
    """RSH8."""
    rows = reshape.phone_rows(_clients(parties), ["client_id", "created_at", "updated_at"])
    return conform(
        rows.withColumns(
            {
                "contact_phone_id": keys.surrogate_key(
                    "client_phone", F.col("client_id"), F.col("phone_type")
                ),
                "customer_id": _client_id(),
                "status": F.lit(ACTIVE),
            }
        ),
        "client_phones",
    )


def shareholders(parties: DataFrame) -> DataFrame:
    """RSH9: the shareholder of each client."""
    rows = reshape.shareholder_base(_clients(parties)).select(
        "shareholder_id",
        _client_id().alias("customer_id"),
        "contact_id",
        text.clean_text(F.col("shareholder_job"), 200).alias("role_label"),
        F.col("activated_at").alias("start_date"),
        F.col("deactivated_at").alias("end_date"),
        F.lit(ACTIVE).alias("status"),
        "created_at",
        "updated_at",
    )
    return conform(rows, "shareholders")


def shareholder_phones(parties: DataFrame) -> DataFrame:
    """RSH9: shareholder phones that parse."""
    rows = reshape.shareholder_base(_clients(parties)).select(
        keys.surrogate_key("shareholder_phone", F.col("client_id")).alias(
            "shareholder_phone__id"
        ),
        "shareholder_id",
        F.lit("phone").alias("phone_type"),
        F.lit(reshape.COUNTRY_CODE).alias("country_code"),
        text.phone_area(F.col("shareholder_phone")).alias("area_code"),
        text.phone_number(F.col("shareholder_phone")).alias("number"),
        F.lit(ACTIVE).alias("status"),
        "created_at",
        "updated_at",
    )
    return conform(rows.filter(F.col("area_code").isNotNull()), "shareholder_phones")


def shareholder_pii(parties: DataFrame) -> DataFrame:
    """RSH9 + STR6: personal data of shareholders with a usable national id."""
    rows = reshape.shareholder_base(_clients(parties)).select(
        "shareholder_id",
        text.shareholder_id(F.col("shareholder_national_id")).alias("cpf"),
        text.clean_text(F.col("shareholder_identity_card")).alias("rg"),
        text.clean_text(F.col("shareholder_nationality")).alias("nationality"),
        codes.marital_label(F.col("shareholder_marital_status")).alias("marital_status"),
        text.clean_text(F.col("shareholder_job"), 200).alias("job_title"),
        F.lit(ACTIVE).alias("status"),
        "created_at",
        "updated_at",
    )
    return conform(rows.filter(F.col("cpf").isNotNull()), "shareholder_pii")


TABLES = {
    "client_customers": lambda parties, places: clients(parties),
    "client_addresses": addresses,
    "client_contacts": lambda parties, places: contacts(parties),
    "client_emails": lambda parties, places: emails(parties),
    "client_phones": lambda parties, places: phones(parties),
    "shareholders": lambda parties, places: shareholders(parties),
    "shareholder_phones": lambda parties, places: shareholder_phones(parties),
    "shareholder_pii": lambda parties, places: shareholder_pii(parties),
}


def orphan_rows(children: DataFrame, client_rows: DataFrame) -> DataFrame:
    """JOI14: child rows whose client is missing."""
    return match.without(children, client_rows, ["customer_id"])
