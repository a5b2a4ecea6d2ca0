"""Users (PIP14, PIP15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, keys, text
from ledgerloom.operators import scope
from ledgerloom.sources.schemas import conform

# Account flags of a loaded user.
ACCOUNT_FLAGS = {
    "email_confirmed": True,
    "phone_number_confirmed": False,
    "temporary_password": False,
    "two_factor_enabled": False,
    "lockout_enabled": True,
    "access_failed_count": 0,
}


def users(source_users: DataFrame) -> DataFrame:
    """PIP14: cleaned accounts with constant flags; nameless accounts are dropped."""
    user_name = text.clean_text(F.col("login"), 256)
    email = text.clean_text(F.col("email"), 256)
    rows = source_users.select(
        keys.surrogate_key("user", F.col("id")).alias("id"),
        F.col("id").alias("legacy_id"),
        text.clean_text(F.col("name")).alias("name"),
        user_name.alias("user_name"),
        F.upper(user_name).alias("normalized_user_name"),
        email.alias("email"),
        F.lower(email).alias("normalized_email"),
        text.clean_text(F.col("phone")).alias("phone_number"),
        *([text.clean_text(F.col("password_hash")).alias("password_hash")]
          if "password_hash" in source_users.columns else []),
        codes.active_text(F.col("active")).alias("status"),
        "created_at",
        dates.changed_at(F.col("updated_at"), F.col("created_at")).alias("updated_at"),
        F.col("created_at").alias("email_confirmed_at"),
        *[F.lit(value).alias(name) for name, value in ACCOUNT_FLAGS.items()],
    )
    return conform(rows.filter(F.col("name").isNotNull()), "users")


def chosen_role(roles: DataFrame, preferred: str, default: str) -> DataFrame:
    """PIP15: the preferred role when it exists, else the default one, else the smallest id."""
    ids = roles.select(F.col("id").alias("role_id")).filter(F.col("role_id").isNotNull())
    rank = (
        F.when(F.col("role_id") == preferred, 0).when(F.col("role_id") == default, 1).otherwise(2)
    )
    return ids.agg(F.min_by("role_id", F.struct(rank, "role_id")).alias("role_id"))


def user_roles(user_rows: DataFrame, roles: DataFrame, preferred: str, default: str) -> DataFrame:
    """PIP15: one role for every user."""
    role = chosen_role(roles, preferred, default)
    rows = user_rows.select(F.col("id").alias("user_id"), role.scalar().alias("role_id"))
    return conform(rows, "user_roles")


def require_roles(roles: DataFrame) -> DataFrame:
    return scope.require_rows(roles, "there are no roles to give to users")
