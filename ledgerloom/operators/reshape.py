"""Wide rows to typed child rows (RSH1-RSH11)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, keys, text
from ledgerloom.operators import match

# Contact columns -> contact type.
CONTACT_TYPES = {"email": "email", "phone": "phone", "cellphone": "cellphone"}

# The six charge amounts of a contract, in output order.
CHARGE_AMOUNTS = (
    "equipment_amount", "trade_amount", "other_amount", "interest_amount", "discount_amount",
    "fine_amount",
)
CHARGE_TYPE = "other"
CHARGE_BILLING_MODEL = "monthly"

# E-mail columns of the older client model -> e-mail type; the third is a list.
EMAIL_COLUMNS = {
    "email": "main",
    "responsible_email": "responsible",
    "billing_emails": "billing",
    "commercial_email": "commercial",
}
EMAIL_LIST_COLUMN = "billing_emails"

# Phone columns of the older client model -> phone type; country code of all phones.
PHONE_COLUMNS = {"phone": "phone", "cellphone": "mobile", "responsible_phone": "responsible"}
COUNTRY_CODE = "55"
COUNTRY = "BR"


def typed_rows(
    df: DataFrame, keep: Sequence[str], rows: Sequence[Mapping[str, Column]]
) -> DataFrame:
    """One output row per entry of ``rows``: an unpivot in a single pass, without a shuffle."""
    entries = [F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows]
    return df.select(*keep, F.inline(F.array(*entries)))


def process_columns(
    df: DataFrame,
    transforms: Mapping[str, Callable[[Column], Column]],
    lookups: Mapping[str, tuple[str, DataFrame]],
) -> DataFrame:
    """PRJ3: rewrite columns in place and add looked-up ones.

    ``lookups`` maps a new column to the column it is looked up by and a (legacy_id, id) table;
    rows without a match get null.
    """
    done = df.withColumns({name: rule(F.col(name)) for name, rule in transforms.items()})
    for target, (by, keys_of) in lookups.items():
        table = keys_of.select(F.col("legacy_id").alias(by), F.col("id").alias(target))
        done = match.left_lookup(done, table, [by])
    return done


def contact_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """RSH1: e-mail, phone and cellphone columns to (type, value); empty values dropped."""
    rows = [
        {
            "type": F.lit(kind),
            "value": (text.contact_email if kind == "email" else text.contact_number)(F.col(c)),
        }
        for c, kind in CONTACT_TYPES.items()
    ]
    return typed_rows(df, keep, rows).filter(F.col("value").isNotNull())


def _address(group: str, kind: str, with_position: bool) -> dict[str, Column]:
    def column(name: str) -> Column:
        return F.col(f"{group}{name}")

    no_position = F.lit(None).cast("double")
    district = text.text_or(column("neighborhood"), 100, "")
    return {
        "type": F.lit(kind),
        "raw_street": column("street"),
        "raw_city": column("city"),
        "raw_state": column("state"),
        "raw_place_code": column("place_code"),
        "postal_code": text.postal_code(column("postal_code")),
        "street": text.text_or(column("street"), 500, ""),
        "number": text.text_or(column("number"), 20, text.DEFAULT_STREET_NUMBER),
        "address_line_2": text.clean_text(column("address_line_2"), 200),
        "neighborhood": district,
        "city": text.text_or(column("city"), 100, ""),
        "state": text.text_or(column("state"), 2, ""),
        "latitude": codes.to_decimal_comma(column("latitude")) if with_position else no_position,
        "longitude": codes.to_decimal_comma(column("longitude")) if with_position else no_position,
        "zone": district,
        "region": F.lit(""),
    }


def address_rows(df: DataFrame, keep: Sequence[str], groups: Mapping[str, str]) -> DataFrame:
    """RSH2: address column groups (prefix -> type) to rows; the first group has a position.

    Rows without a street are dropped. Raw city, state and code stay for the place lookup.
    """
    rows = [
        _address(prefix, kind, with_position=(i == 0))
        for i, (prefix, kind) in enumerate(groups.items())
    ]
    return typed_rows(df, keep, rows).filter(text.not_blank(F.col("raw_street"))).drop("raw_street")


def placed_addresses(
    rows: DataFrame, places: DataFrame, owner: str, order: Sequence[str]
) -> DataFrame:
    """JOI8 + WIN1: add the place code, then keep the first address of each owner and type.

    Owners are reduced to one row per type before the lookup, so it runs on fewer rows.
    """
    first = match.first_per_key(rows, [owner, "type"], order)
    placed = match.add_place_code(
        first, places, "raw_state", "raw_city", "raw_place_code", "municipal_code"
    )
    return placed.drop("raw_city", "raw_state", "raw_place_code")


def any_positive(columns: Sequence[str], switch: Column) -> Column:
    """FIL7: any amount above zero, or the switch."""
    found = F.coalesce(switch, F.lit(False))
    for c in columns:
        found = found | F.coalesce(F.col(c) > 0, F.lit(False))
    return found


def charge_rows(df: DataFrame, keep: Sequence[str], run_ts: str) -> DataFrame:
    """RSH3: six amounts to rows. The first also counts when its switch is set, then with 0."""
    switch = F.coalesce(F.col("equipment_charged"), F.lit(False))
    created, updated = F.col("created_at"), F.col("updated_at")
    usual_start = dates.first_day(run_ts, created, updated)
    rows = []
    for i, amount in enumerate(CHARGE_AMOUNTS):
        positive = F.coalesce(F.col(amount) > 0, F.lit(False))
        start = dates.first_day(run_ts, F.col("equipment_start_at"), created, updated)
        rows.append(
            {
                "position": F.lit(i + 1),
                "amount": F.coalesce(F.col(amount), F.lit(0).cast("decimal(18,2)")),
                "charge_type": F.lit(CHARGE_TYPE),
                "billing_model": F.lit(CHARGE_BILLING_MODEL),
                "start_date": start if i == 0 else usual_start,
                "_kept": positive | switch if i == 0 else positive,
            }
        )
    return typed_rows(df, keep, rows).filter("_kept").drop("_kept")


def seller_rows(
    df: DataFrame, keep: Sequence[str], farmer: str, hunter: str, fallback: Column
) -> DataFrame:
    """RSH4: two sellers per contract; a missing one copies the other, both missing the fallback."""
    f, h = F.col(farmer), F.col(hunter)
    rows = [
        {"seller_type": F.lit("farmer"), "user_id": F.coalesce(f, h, fallback)},
        {"seller_type": F.lit("hunter"), "user_id": F.coalesce(h, f, fallback)},
    ]
    return typed_rows(df, keep, rows).filter(F.col("user_id").isNotNull())


def sellers_missing(df: DataFrame, farmer: str, hunter: str, fallback: Column) -> DataFrame:
    """RSH4: contracts that get no seller at all."""
    return df.filter(F.coalesce(F.col(farmer), F.col(hunter), fallback).isNull())


def name_rows(df: DataFrame, keep: Sequence[str], name: str, second: str) -> DataFrame:
    """RSH5: the name, and the second name when it is another one; needs the first."""
    first_name, second_name = text.clean_text(F.col(name)), text.clean_text(F.col(second))
    other = F.when(first_name.isNotNull() & (second_name != first_name), second_name)
    rows = [{"name": first_name}, {"name": other}]
    return typed_rows(df, keep, rows).filter(F.col("name").isNotNull())


def _typed_emails(column: str, kind: str) -> Column:
    """The valid addresses of one column as an array of (email_type, email)."""
    listed = column == EMAIL_LIST_COLUMN
    one = F.array(text.email_or_null(F.col(column)))
    found = text.email_list(F.col(column)) if listed else one
    return F.transform(
        F.coalesce(found, F.array().cast("array<string>")),
        lambda e: F.struct(F.lit(kind).alias("email_type"), e.alias("email")),
    )


def email_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """RSH6 + RSH7: single addresses and one comma-separated list to typed rows."""
    entries = [_typed_emails(c, kind) for c, kind in EMAIL_COLUMNS.items()]
    return df.select(*keep, F.inline(F.concat(*entries))).filter(F.col("email").isNotNull())


def phone_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """RSH8: phone columns to typed rows; kept when parsing gives no parts, dropped when empty."""
    rows = [
        {
            "phone_type": F.lit(kind),
            "country_code": F.lit(COUNTRY_CODE),
            "area_code": text.phone_area(F.col(c)),
            "number": text.phone_number(F.col(c)),
            "_raw": F.col(c),
        }
        for c, kind in PHONE_COLUMNS.items()
    ]
    filled = F.col("_raw").isNotNull() & (F.col("_raw") != "")
    return typed_rows(df, keep, rows).filter(filled).drop("_raw")


def person_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """RSH10: contact person and buyer to rows with job title; only the first has a comment."""
    rows = [
        {
            "position": F.lit(1),
            "contact_name": text.clean_text(F.col("contact_person")),
            "job_title": text.clean_text(F.col("contact_job"), 200),
            "comment": text.clean_text(F.col("notes")),
        },
        {
            "position": F.lit(2),
            "contact_name": text.clean_text(F.col("buyer")),
            "job_title": text.clean_text(F.col("buyer_job"), 200),
            "comment": F.lit(None).cast("string"),
        },
    ]
    return typed_rows(df, keep, rows).filter(F.col("contact_name").isNotNull())


def shareholder_base(clients: DataFrame) -> DataFrame:
    """RSH9: clients with a real shareholder name, with the keys all child rows share."""
    name = F.upper(text.strip(F.col("shareholder_name")))
    return clients.filter(text.not_blank(F.col("shareholder_name")) & (name != "PENDENTE")).withColumns(
        {
            "contact_id": keys.surrogate_key("shareholder_contact", F.col("client_id")),
            "shareholder_id": keys.surrogate_key("shareholder", F.col("client_id")),
        }
    )
