"""Contracts (PIP16, PIP18-PIP26): contracts, tasks, scenarios and their children."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, keys, text
from ledgerloom.operators import match, quality, reshape, rollup
from ledgerloom.operators.scope import ScopeParams, in_scope, sample
from ledgerloom.sources.schemas import conform

TEAM_POSITION = "analyst"
SCENARIO_KEY = ("contract_legacy_id", "frequency_key", "hours_key", "rate_key")


def contracts(
    lines: DataFrame,
    master: DataFrame,
    customer_key_rows: DataFrame,
    sheet_terms: DataFrame | None,
    params: ScopeParams,
    run_ts: str,
) -> DataFrame:
    """PIP16: one contract per contract id in scope whose customer is loaded.

    Billing terms come from the sheet row when there is one (blank cells get defaults), else from
    the lines.
    """
    rolled = rollup.contract_rollup(in_scope(lines, params), master)
    rolled = sample(rolled, params, "contract_id")
    owned = match.map_key(
        rolled.withColumnRenamed("customer_id", "legacy_customer_id"), customer_key_rows,
        "legacy_customer_id", "customer_id",
    )
    if sheet_terms is None:
        none = F.lit(None)
        termed = owned.withColumns(
            {
                "has_sheet": F.lit(False),
                "sheet_billing_day": none.cast("int"),
                "sheet_due_day": none.cast("int"),
                "sheet_billing_type": none.cast("string"),
                "sheet_thirteenth_type": none.cast("string"),
            }
        )
    else:
        termed = enrich_from_sheet(owned, sheet_terms)
    return conform(termed.select(*_contract_columns(run_ts)), "contracts")


def enrich_from_sheet(df: DataFrame, sheet_terms: DataFrame) -> DataFrame:
    """JOI16: sheet cells by contract, with a flag for contracts the sheet lists."""
    listed = sheet_terms.withColumn("has_sheet", F.lit(True))
    found = match.left_lookup(df, listed, ["contract_id"])
    return found.withColumn("has_sheet", codes.flag(F.col("has_sheet")))


def sheet_or_lines(sheet_cell: Column, line_value: Column, default) -> Column:
    """JOI16: the sheet cell on listed contracts, the line value on others; blank is default."""
    value = F.when(F.col("has_sheet"), sheet_cell).otherwise(line_value)
    return F.coalesce(value, F.lit(default))


def _contract_columns(run_ts: str) -> list[Column]:
    created = dates.first_timestamp(run_ts, F.col("contract_created_at"))
    start = dates.first_timestamp(run_ts, F.col("start_at"), F.col("contract_created_at"))
    return [
        keys.surrogate_key("contract", F.col("contract_id")).alias("id"),
        F.col("contract_id").alias("legacy_id"),
        F.col("contract_id").alias("code"),
        F.col("customer_id"),
        sheet_or_lines(F.col("sheet_billing_day"), F.col("billing_day").cast("int"), 1).alias(
            "contract_parameters_billing_day"
        ),
        sheet_or_lines(F.col("sheet_due_day"), F.col("due_day").cast("int"), 1).alias(
            "contract_parameters_due_day"
        ),
        text.snake_case(F.col("sheet_billing_type"), codes.BILLING_TYPE).alias(
            "contract_parameters_billing_type"
        ),
        text.snake_case(F.col("sheet_thirteenth_type"), codes.THIRTEENTH_SALARY_TYPE).alias(
            "contract_parameters_thirteenth_salary_type"
        ),
        F.lit(codes.OPERATION_TYPE).alias("operation_type"),
        F.lit(codes.TRADE_TYPE).alias("trade_type"),
        start.alias("start_date"),
        F.lit("active").alias("status"),
        F.lit(0.0).alias("expected_amount"),
        created.alias("created_at"),
        dates.first_timestamp(run_ts, F.col("contract_updated_at")).alias("updated_at"),
        text.clean_text(F.col("customer_name"), 255).alias("title"),
        F.col("legacy_customer_id"),
    ]


def promoter_tasks(lines: DataFrame, params: ScopeParams, run_ts: str) -> DataFrame:
    """PIP18: distinct cleaned task names with their type.

    The type is looked up with the name before its inner blanks are squeezed; of several
    spellings of one name the smallest decides. Names are made distinct before they are cleaned,
    so the text rules run once per spelling and not once per line.
    """
    spelled = in_scope(lines, params).select("task_name").distinct().select(
        text.task_name(F.col("task_name")).alias("name"),
        F.upper(text.clean_text(F.col("task_name"))).alias("spelling"),
    )
    # Blank names are dropped by their aggregated spelling: a test of the name itself would be
    # pushed below the distinct and clean every line again.
    named = spelled.groupBy("name").agg(F.min("spelling").alias("spelling")).filter(
        F.col("spelling").isNotNull()
    )
    now = dates.run_timestamp(run_ts)
    rows = named.select(
        keys.surrogate_key("promoter_task", F.col("name")).alias("id"),
        "name",
        text.task_type(F.col("spelling")).alias("task_type"),
        F.lit(True).alias("is_active"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )
    return conform(rows, "promoter_tasks")


def with_line_numbers(df: DataFrame, strict: bool = False) -> DataFrame:
    """Frequency and hours text as numbers, parsed once for every column that needs them.

    Decimal commas are read. ``strict`` reads them as no number, the way the rate formula of the
    source system does.
    """
    parse = codes.to_number if strict else codes.to_decimal_comma
    return df.withColumns(
        {
            "frequency_number": parse(F.col("frequency")),
            "hours_number": parse(F.col("hours")),
        }
    )


def line_rate() -> Column:
    """NUM1 over the columns of ``with_line_numbers``."""
    return codes.hour_rate(F.col("price"), F.col("frequency_number"), F.col("hours_number"))


def scenario_key_columns() -> dict[str, Column]:
    """JOI5: the normalised frequency, hours and rate of a line or scenario."""
    return {
        "frequency_key": codes.frequency_key(F.col("frequency"), F.col("frequency_number")),
        "hours_key": codes.hours_key(F.col("hours"), F.col("hours_number")),
        "rate_key": codes.rate_key(line_rate()),
    }


def first_scenarios(lines: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """AGG2 + WIN1: one row per (contract, frequency, hours, price), the first by all columns.

    ``columns`` are those wanted besides the keys, by default all.
    """
    rolled = rollup.scenario_rollup(lines).withColumn(
        "price", F.coalesce(F.col("price"), F.lit(0).cast("decimal(18,2)"))
    )
    return match.first_per_key(
        rolled, ["contract_id", "frequency", "hours", "price"], [], columns
    ).withColumnRenamed("contract_id", "contract_legacy_id")


def with_scenario_keys(first: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of ``first_scenarios`` with their numbers, id and normalised keys."""
    return with_line_numbers(first, strict).withColumns(
        {
            "scenario_id": keys.surrogate_key(
                "scenario", F.col("contract_legacy_id"), F.col("frequency"), F.col("hours"),
                F.col("price"),
            ),
            **scenario_key_columns(),
        }
    )


def distinct_scenarios(lines: DataFrame, strict: bool = False) -> DataFrame:
    """AGG2 + WIN1: the scenarios of the lines with their keys."""
    return with_scenario_keys(first_scenarios(lines), strict)


def unknown_tasks(scenarios: DataFrame, task_rows: DataFrame) -> DataFrame:
    """VAL3: task names of scenarios without a task row; a missing name counts as unknown."""
    spelled = scenarios.select("task_name").distinct()
    names = spelled.select(text.task_name(F.col("task_name")).alias("name")).distinct()
    return match.without(names, task_rows, ["name"])


def billed_scenarios(
    lines: DataFrame,
    contract_billing_rows: DataFrame,
    params: ScopeParams,
    strict: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Scenarios of contracts with a billing that name a task, with their key columns.

    ``columns`` are those of the first line wanted besides, by default all; the task's name is always
    one. What only makes keys of the scenarios needs no other, and moves and sorts none then. The keys
    are made after the join, so they are not moved either.
    """
    wanted = None if columns is None else ["task_name", *columns]
    scenarios = first_scenarios(in_scope(lines, params), wanted)
    scenarios = sample(scenarios, params, "contract_legacy_id", "frequency", "hours", "price")
    billed = scenarios.join(contract_billing_rows, "contract_legacy_id")
    tasked = with_scenario_keys(billed, strict).withColumn("_task", text.task_name(F.col("task_name"))).filter(
        F.col("_task").isNotNull()
    )
    return tasked.withColumn(
        "frequency_label", codes.frequency_label(F.col("frequency_number"))
    )


def keyed_scenarios(
    lines: DataFrame,
    contract_billing_rows: DataFrame,
    params: ScopeParams,
    run_ts: str,
    strict: bool = False,
) -> DataFrame:
    """PIP19 with its key columns. Scenarios of contracts without a billing are left out.

    The task's id is computed from its name, as the tasks come from the same lines; names without a
    task stop the run before (VAL3).
    """
    tasked = billed_scenarios(lines, contract_billing_rows, params, strict)
    created = dates.first_timestamp(run_ts, F.col("line_created_at"))
    return tasked.withColumns(
        {
            "id": F.col("scenario_id"),
            "legacy_id": F.lit(0),
            "promoter_task_id": keys.surrogate_key("promoter_task", F.col("_task")),
            "hour_value": F.col("rate_key"),
            "start_date": dates.first_day(run_ts, F.col("start_day"), F.col("line_created_at")),
            "end_date": F.col("notice_day"),
            "scenario_status": codes.scenario_status(F.col("status")),
            "expected_amount": codes.expected_amount(F.col("hours_number"), F.col("rate_key")),
            "created_at": created,
            "updated_at": F.coalesce(F.col("line_updated_at"), created),
        }
    )


def contract_scenarios(keyed: DataFrame) -> DataFrame:
    """PIP19: the scenario table."""
    rows = keyed.drop("frequency", "hours", "status").withColumnsRenamed(
        {"frequency_label": "frequency", "hours_number": "hours", "scenario_status": "status"}
    )
    return conform(rows, "contract_scenarios")


def scenario_key_map(keyed: DataFrame) -> DataFrame:
    """JOI5: four-column key -> scenario; of several scenarios on a key the smallest price wins."""
    return keyed.groupBy(*SCENARIO_KEY).agg(
        F.min(F.struct("price", "scenario_id", "frequency_label")).alias("_s")
    ).select(*SCENARIO_KEY, "_s.scenario_id", F.col("_s.frequency_label").alias("frequency"))


def keyed_lines(lines: DataFrame, params: ScopeParams, strict: bool = False) -> DataFrame:
    """Lines in scope with the scenario key columns."""
    scoped = in_scope(lines, params).filter(F.col("customer_id").isNotNull())
    numbered = with_line_numbers(sample(scoped, params, "line_id"), strict)
    return numbered.withColumns(scenario_key_columns())


def linked_lines(
    lines: DataFrame,
    key_rows: DataFrame,
    store_rows: DataFrame,
    params: ScopeParams,
    strict: bool = False,
) -> DataFrame:
    """Every line in scope with its scenario and its store.

    Lines whose key has no scenario, whose frequency the scenario's label does not stand for, or
    whose store is not loaded are left out; ``quality.line_rejects`` lists them.
    """
    slim = keyed_lines(lines, params, strict).select(
        F.col("contract_id").alias("contract_legacy_id"), *SCENARIO_KEY[1:], "line_id",
        "store_id", "start_at", "line_created_at", "line_updated_at",
    )
    stored = match.map_key(
        slim.withColumnRenamed("store_id", "legacy_store_id"), match.key_map(store_rows),
        "legacy_store_id", "store_id",
    )
    fits = F.array_contains(codes.frequency_texts(F.col("frequency")), F.col("frequency_key"))
    return stored.join(key_rows, list(SCENARIO_KEY)).filter(fits).select(
        "contract_legacy_id", "line_id", "scenario_id", "store_id", "start_at", "line_created_at",
        "line_updated_at",
    )


def scenario_store_rows(linked: DataFrame, line_flags: DataFrame, run_ts: str) -> DataFrame:
    """PIP20 of ``linked_lines``."""
    flagged = match.left_lookup(linked, line_flags.select("line_id", "active"), ["line_id"])
    created = dates.first_timestamp(run_ts, F.col("line_created_at"))
    rows = flagged.select(
        keys.surrogate_key("scenario_store", F.col("line_id")).alias("id"),
        F.col("line_id").alias("legacy_id"),
        "scenario_id",
        "store_id",
        dates.first_timestamp(run_ts, F.col("start_at"), F.col("line_created_at")).alias(
            "start_date"
        ),
        codes.active_text(F.col("active")).alias("status"),
        created.alias("created_at"),
        F.coalesce(F.col("line_updated_at"), created).alias("updated_at"),
    )
    return conform(rows, "contract_scenario_stores")


def contract_scenario_stores(
    lines: DataFrame,
    line_flags: DataFrame,
    key_rows: DataFrame,
    store_rows: DataFrame,
    params: ScopeParams,
    run_ts: str,
    strict: bool = False,
) -> DataFrame:
    """PIP20: every line in scope with its scenario, its store and its flag."""
    linked = linked_lines(lines, key_rows, store_rows, params, strict)
    return scenario_store_rows(linked, line_flags, run_ts)


def line_rejects(
    lines: DataFrame, key_rows: DataFrame, store_rows: DataFrame, params: ScopeParams
) -> DataFrame:
    """VAL5 + VAL9: lines without a scenario store, with the reason."""
    known = store_rows.select(F.col("legacy_id").alias("store_id"))
    scenarios = key_rows.withColumnRenamed("contract_legacy_id", "contract_id")
    found = quality.line_rejects(keyed_lines(lines, params), scenarios, known)
    return found.select(
        "line_id", "contract_id", "store_id", "frequency_key", "hours_key", "rate_key", "reason"
    )


def contract_sellers(
    contract_keys: DataFrame,
    sheet_terms: DataFrame,
    user_rows: DataFrame,
    source_users: DataFrame,
    run_ts: str,
    fallback_user_id: str | None = None,
) -> DataFrame:
    """PIP21: farmer and hunter of every contract the sheet lists.

    Without a fallback user the smallest user id stands in for contracts without any login.
    """
    logins = match.login_keys(user_rows)
    national_ids = match.national_id_keys(source_users, user_rows)
    listed = sheet_terms.select("contract_id", "farmer_login", "hunter_login")
    known = match.map_key(
        listed.withColumnRenamed("contract_id", "legacy_id"), contract_keys, "legacy_id",
        "contract_id",
    )
    for role in ("farmer", "hunter"):
        known = match.add_user_by_login(known, f"{role}_login", f"{role}_id", logins, national_ids)
    fallback = (
        F.lit(fallback_user_id) if fallback_user_id else user_rows.agg(F.min("id")).scalar()
    )
    now = dates.run_timestamp(run_ts)
    rows = reshape.seller_rows(
        known.withColumn("_fallback", fallback), ["contract_id"], "farmer_id", "hunter_id",
        F.col("_fallback"),
    ).withColumns(
        {
            "id": keys.surrogate_key("contract_seller", F.col("contract_id"), F.col("seller_type")),
            "created_at": now,
            "updated_at": now,
            "status": F.lit("active"),
        }
    )
    return conform(rows, "contract_sellers")


def _dated_contracts(lines: DataFrame, *columns: str) -> DataFrame:
    return lines.select(
        "contract_id", *columns, "contract_created_at", "contract_updated_at"
    ).distinct()


def _contract_dates(run_ts: str) -> dict[str, Column]:
    return {
        "created_at": dates.first_timestamp(run_ts, F.col("contract_created_at")),
        "updated_at": dates.first_timestamp(run_ts, F.col("contract_updated_at")),
    }


def _with_contract(df: DataFrame, contract_keys: DataFrame) -> DataFrame:
    return match.map_key(
        df.withColumnRenamed("contract_id", "contract_legacy_id"), contract_keys,
        "contract_legacy_id", "contract_id",
    )


def contract_team_members(
    lines: DataFrame,
    master: DataFrame,
    contract_keys: DataFrame,
    user_keys: DataFrame,
    run_ts: str,
) -> DataFrame:
    """PIP22: the seller of each contract as its analyst. ``lines`` are already in scope."""
    sold = master.filter(F.col("seller_id").isNotNull()).select("contract_id", "seller_id")
    members = _dated_contracts(lines).join(sold, "contract_id")
    mapped = match.map_key(
        _with_contract(members, contract_keys), user_keys, "seller_id", "user_id"
    )
    rows = mapped.withColumns(
        {
            "id": keys.surrogate_key(
                "team_member", F.col("contract_legacy_id"), F.col("user_id"),
                F.col("contract_created_at"), F.col("contract_updated_at"),
            ),
            "position": F.lit(TEAM_POSITION),
            **_contract_dates(run_ts),
        }
    )
    return conform(rows, "contract_team_members")


def contract_contacts(lines: DataFrame, contract_keys: DataFrame, run_ts: str) -> DataFrame:
    """PIP23: the customer name and a different system name. ``lines`` are already in scope."""
    named = _dated_contracts(
        lines.filter(F.col("customer_name").isNotNull()), "customer_name", "system_name"
    )
    mapped = _with_contract(named, contract_keys)
    keep = [
        "contract_id", "contract_legacy_id", "contract_created_at", "contract_updated_at",
        F.col("customer_name").alias("_first"), F.col("system_name").alias("_second"),
    ]
    rows = reshape.name_rows(mapped, keep, "customer_name", "system_name").withColumns(
        {
            "id": keys.surrogate_key(
                "contract_contact", F.col("contract_legacy_id"), F.col("_first"),
                F.col("_second"), F.col("contract_created_at"), F.col("contract_updated_at"),
                F.col("name"),
            ),
            **_contract_dates(run_ts),
        }
    )
    return conform(rows, "contract_contacts")


def contract_partners(
    lines: DataFrame,
    contract_keys: DataFrame,
    people: DataFrame,
    run_ts: str,
    dedupe: bool = False,
) -> DataFrame:
    """PIP24: one row per store client of a contract, all with the person of the smallest id.

    The store client is not part of the output, so rows of one contract look alike; ``dedupe``
    keeps one of them. ``lines`` are already in scope.
    """
    found = _dated_contracts(
        lines.filter(
            F.col("store_client_id").isNotNull() & F.col("store_client_name").isNotNull()
        ),
        "store_client_id",
        "store_client_name",
    )
    mapped = match.attach_one(_with_contract(found, contract_keys), people, "id", "person_id")
    rows = mapped.withColumns(
        {
            "id": keys.surrogate_key(
                "contract_partner", F.col("contract_legacy_id"), F.col("store_client_id"),
                F.col("store_client_name"), F.col("contract_created_at"),
                F.col("contract_updated_at"),
            ),
            **_contract_dates(run_ts),
        }
    )
    table = conform(rows, "contract_partners")
    if not dedupe:
        return table
    return match.first_per_key(table, ["contract_id", "person_id", "created_at", "updated_at"], [])


def contract_additional_charges(
    master: DataFrame, contract_billing_rows: DataFrame, run_ts: str
) -> DataFrame:
    """PIP25: the charges of every billed contract. ``master`` is already in scope."""
    charged = master.filter(
        reshape.any_positive(reshape.CHARGE_AMOUNTS, F.col("equipment_charged"))
    ).withColumnRenamed("contract_id", "contract_legacy_id")
    billed = charged.join(contract_billing_rows, "contract_legacy_id")
    keep = ["contract_id", "contract_legacy_id", "billing_id", "created_at", "updated_at"]
    rows = reshape.charge_rows(billed, keep, run_ts).withColumns(
        {
            "id": keys.surrogate_key(
                "contract_charge", F.col("contract_legacy_id"), F.col("position")
            ),
            "created_at": dates.first_timestamp(run_ts, F.col("created_at")),
            "updated_at": dates.first_timestamp(run_ts, F.col("updated_at")),
        }
    )
    return conform(rows, "contract_additional_charges")


def contract_scenarios_brands(customer_brand_pairs: DataFrame, scenario_rows: DataFrame) -> DataFrame:
    """PIP26 + JOI13: distinct (scenario, customer brand) pairs.

    A scenario names the billing of its contract's customer, whose id follows from the customer's, so
    scenarios meet the pairs by it and the contracts need not be read. A scenario has one customer, so
    once the junction rows are distinct the pairs are too and need no further shuffle.
    """
    scenarios = scenario_rows.select(F.col("id").alias("scenario_id"), "billing_id").distinct()
    pairs = customer_brand_pairs.select("customer_id", "customer_brand_id").distinct().select(
        keys.surrogate_key("billing", F.col("customer_id")).alias("billing_id"), "customer_brand_id"
    )
    return conform(scenarios.join(pairs, "billing_id"), "contract_scenarios_brands")
