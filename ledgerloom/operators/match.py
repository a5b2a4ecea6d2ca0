"""Keep-first, key lookups and joins (WIN1-WIN4, JOI3-JOI19)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, text


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """WIN1 / WIN2 / WIN3: the first row of each key by ``order``, ties broken by all columns.

    A minimum over a struct is a partial aggregate: each map task sends at most one row per key,
    so a key that holds a third of the table costs no more than any other.

    ``columns`` are those wanted besides the keys, by default all. Columns that follow the last
    of them only tell apart rows that are alike in it, so they are not compared or moved.
    """
    payload = [c for c in df.columns if c not in keys]
    wanted = payload if columns is None else [c for c in payload if c in columns]
    if wanted:
        payload = payload[: payload.index(wanted[-1]) + 1]
    order_columns = [F.col(o) if isinstance(o, str) else o for o in order]
    ranked = F.struct(
        *[c.alias(f"_order_{i}") for i, c in enumerate(order_columns)],
        *[F.col(c) for c in payload],
    )
    best = df.groupBy(*keys).agg(F.min(ranked).alias("_best"))
    picked = [
        F.col(c) if c in keys else F.col(f"_best.{c}").alias(c)
        for c in df.columns
        if c in keys or c in wanted
    ]
    return best.select(*picked)


def nulls_last(c: str | Column) -> tuple[Column, Column]:
    """Two order columns that sort a nullable column with its nulls at the end."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull(), c


def latest(df: DataFrame, order: str, tie: str, n: int) -> DataFrame:
    """WIN4: the newest ``n`` rows."""
    return df.orderBy(F.col(order).desc_nulls_last(), F.col(tie)).limit(n)


def _any_null(on: Sequence[str]) -> Column:
    missing = F.col(on[0]).isNull()
    for c in on[1:]:
        missing = missing | F.col(c).isNull()
    return missing


def _spread_nulls(df: DataFrame, on: Sequence[str], by: str | None) -> DataFrame:
    """A second join column that sends rows with a null key to many partitions.

    Rows with a null key never match, yet an outer or anti join has to keep them; without this
    they would all hash to one partition. They are spread by one column that tells rows apart,
    by default the first that is no join column, so that all others can still be pruned.
    """
    by = by or next((c for c in df.columns if c not in on), None)
    # Without another column, rows with equal keys are told apart by their place.
    spread = F.xxhash64(F.col(by)) if by else F.xxhash64(*on, F.monotonically_increasing_id())
    zero = F.lit(0).cast("bigint")
    return df.withColumn("_spread", F.when(_any_null(on), spread).otherwise(zero))


def _unspread(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """The other side of such a join: 0 on every key that can match.

    Not a plain constant, which the optimiser would take out of the join keys.
    """
    return df.withColumn("_spread", F.when(_any_null(on), F.lit(-1).cast("bigint")).otherwise(F.lit(0).cast("bigint")))


def left_lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], by: str | None = None
) -> DataFrame:
    """JOI2: left join on columns of the same name, safe for many null keys on the left.

    ``right`` must hold at most one row per key. No broadcast hint: Spark broadcasts ``right``
    only when its measured size is under the configured threshold, and otherwise shuffles both
    sides with skewed partitions split at run time.
    """
    joined = _spread_nulls(left, on, by).join(_unspread(right, on), [*on, "_spread"], "left")
    return joined.drop("_spread")


def without(
    left: DataFrame, right: DataFrame, on: Sequence[str], by: str | None = None
) -> DataFrame:
    """JOI12 / VAL9: rows of ``left`` with no match; rows with a null key are kept.

    The right side is made distinct on the join columns. That shares its shuffle with the join and
    merges repeated keys before it, so a key ``right`` repeats many times fills no partition.
    """
    keyed = _unspread(right.select(*on), on).distinct()
    joined = _spread_nulls(left, on, by).join(keyed, [*on, "_spread"], "left_anti")
    return joined.select(*left.columns)


def within(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """JOI11 / FIL5: rows of ``left`` whose key is in ``right``; see ``without`` for the distinct."""
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def key_map(target: DataFrame, id_column: str = "id", legacy: str = "legacy_id") -> DataFrame:
    """SRC2: legacy key -> surrogate key, read back from a target table."""
    return target.filter(F.col(legacy).isNotNull()).select(
        F.col(legacy).alias("legacy_id"), F.col(id_column).alias("id")
    )


def array_key_map(target: DataFrame, id_column: str = "id", ids: str = "legacy_ids") -> DataFrame:
    """JOI4 / RSH11: one row per element of an array of legacy ids."""
    return target.select(F.explode(ids).alias("legacy_id"), F.col(id_column).alias("id"))


def map_key(df: DataFrame, keys: DataFrame, legacy: str, target: str) -> DataFrame:
    """JOI3: add the surrogate key of a legacy key; rows without one are dropped."""
    renamed = keys.select(F.col("legacy_id").alias(legacy), F.col("id").alias(target))
    return df.join(renamed, legacy, "inner")


def unmapped(df: DataFrame, keys: DataFrame, legacy: str, reason: str) -> DataFrame:
    """VAL9: the distinct legacy keys ``map_key`` drops, with a reason."""
    wanted = df.select(legacy).distinct()
    missing = without(wanted, keys.select(F.col("legacy_id").alias(legacy)), [legacy])
    return missing.select(
        F.lit(reason).alias("reason"), F.col(legacy).cast("string").alias("legacy_key")
    )


def place_table(places: DataFrame) -> DataFrame:
    """JOI8: (state, city) -> code. Codes that are not positive and blank names are ignored.

    Sources list places in no stated order, so the smallest code of a repeated name is the first.
    """
    return (
        places.select(
            text.fold_name(F.col("state")).alias("_state"),
            text.fold_name(F.col("city")).alias("_city"),
            codes.place_code(F.col("code")).alias("_place_code"),
        )
        .filter((F.col("_place_code") > 0) & (F.col("_state") != "") & (F.col("_city") != ""))
        .groupBy("_state", "_city")
        .agg(F.min("_place_code").alias("_place_code"))
    )


def add_place_code(
    df: DataFrame, places: DataFrame, state: str, city: str, explicit: str | None, target: str
) -> DataFrame:
    """JOI8: a positive explicit code wins, then the folded (state, city) match, then 0."""
    keyed = df.withColumns(
        {
            "_state": F.nullif(text.fold_name(F.col(state)), F.lit("")),
            "_city": F.nullif(text.fold_name(F.col(city)), F.lit("")),
        }
    )
    found = left_lookup(keyed, place_table(places), ["_state", "_city"])
    own = codes.place_code(F.col(explicit)) if explicit else F.lit(None).cast("bigint")
    code = F.coalesce(F.when(own > 0, own), F.col("_place_code"), F.lit(0).cast("bigint"))
    return found.withColumn(target, code).drop("_state", "_city", "_place_code")


def login_keys(users: DataFrame) -> DataFrame:
    """JOI9: lower-case login, normalised login or e-mail -> user id, first user wins.

    Users are taken in id order, and for one user the login goes before the normalised login and
    the e-mail; the id decides first, so the rank inside one user does not change the result.
    """
    names = F.array("user_name", "normalized_user_name", "email")
    return (
        users.select("id", F.explode(names).alias("key"))
        .select("id", F.lower(text.strip(F.col("key"))).alias("login_key"))
        .filter(F.col("login_key") != "")
        .groupBy("login_key")
        .agg(F.min("id").alias("login_user_id"))
    )


def national_id_keys(source_users: DataFrame, users: DataFrame) -> DataFrame:
    """JOI9: padded national id digits -> user id; the smallest legacy id wins."""
    known = source_users.select(
        F.col("id").alias("legacy_id"),
        text.national_id_key(F.col("national_id")).alias("national_id_key"),
    ).filter(F.col("national_id_key").isNotNull())
    mapped = map_key(known, key_map(users), "legacy_id", "national_user_id")
    return mapped.groupBy("national_id_key").agg(
        F.min_by("national_user_id", "legacy_id").alias("national_user_id")
    )


def add_user_by_login(
    df: DataFrame, login: str, target: str, logins: DataFrame, national_ids: DataFrame
) -> DataFrame:
    """JOI9: user id by login text, else by its digits when there are at least ten."""
    value = text.strip(F.col(login).cast("string"))
    long_digits = F.when(F.length(text.digits(value)) >= 10, value)
    keyed = df.withColumns(
        {
            "login_key": F.nullif(F.lower(value), F.lit("")),
            "national_id_key": text.national_id_key(long_digits),
        }
    )
    found = left_lookup(keyed, logins, ["login_key"])
    found = left_lookup(found, national_ids, ["national_id_key"])
    return found.withColumn(target, F.coalesce("login_user_id", "national_user_id")).drop(
        "login_key", "national_id_key", "login_user_id", "national_user_id"
    )


def brand_channels(stores: DataFrame) -> DataFrame:
    """JOI10: brand -> its smallest channel."""
    return (
        stores.filter(F.col("brand_id").isNotNull() & F.col("channel_id").isNotNull())
        .groupBy("brand_id")
        .agg(F.min("channel_id").alias("channel_id"))
    )


def attach_one(df: DataFrame, one: DataFrame, column: str, target: str) -> DataFrame:
    """JOI15: one key on every row. The smallest key is taken; an empty table leaves no rows.

    A scalar subquery: the key is a constant of the plan, not a join.
    """
    return df.withColumn(target, one.agg(F.min(column)).scalar()).filter(
        F.col(target).isNotNull()
    )


def junction(left: DataFrame, right: DataFrame, on: str, pair: Sequence[str]) -> DataFrame:
    """JOI13: distinct pairs over a shared key.

    Both sides are reduced to distinct rows first, so the join never meets repeated rows.
    """
    a, b = pair
    return (
        left.select(on, a)
        .distinct()
        .join(right.select(on, b).distinct(), on)
        .select(a, b)
        .distinct()
    )


def segments_by_name(lines: DataFrame, segments: DataFrame) -> DataFrame:
    """JOI7: segment ids whose name equals the line text once spaces are removed."""
    wanted = (
        lines.select("segment_names")
        .distinct()
        .filter(text.not_blank(F.col("segment_names")))
        .select(text.join_text(F.col("segment_names")).alias("_name"))
        .distinct()
    )
    named = segments.select(
        F.col("id").alias("segment_id"), text.join_text(F.col("name")).alias("_name")
    )
    return named.join(wanted, "_name", "left_semi").select("segment_id").distinct()


def segments_through(lines: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """JOI19: segment ids found through the parent (contract or customer) of the lines."""
    return (
        within(parent.filter(F.col("segment_id").isNotNull()), lines, [on])
        .select("segment_id")
        .distinct()
    )


def stores_of_scenarios(scenario_stores: DataFrame, stores: DataFrame) -> DataFrame:
    """JOI17: the stores of each scenario with their names."""
    named = stores.select(F.col("id").alias("store_id"), F.col("name").alias("store_name"))
    return left_lookup(scenario_stores, named, ["store_id"])


def count_descendants(parents: DataFrame, children: DataFrame, parent_key: str) -> DataFrame:
    """JOI18: number of children whose parent is in ``parents``."""
    kept = within(children, parents.select(F.col("id").alias(parent_key)), [parent_key])
    return kept.agg(F.count("*").alias("rows"))
