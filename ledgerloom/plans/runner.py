"""Runs (PIP30): the pipelines in dependency order, each step writing one target table.

A step reads what earlier steps wrote, so lineage ends at every written table and a lost executor
only repeats work of the current step. A step that fails stops the run and publishes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import load, match, quality, reshape, rollup, scope
from ledgerloom.operators.scope import ScopeParams, in_scope
from ledgerloom.plans import (
    billing, contracts, customers, legacy_clients, scope_refresh, stores, users,
)
from ledgerloom.sources import reports, schemas, sheet as sheets
from ledgerloom.sources.catalog import TargetStore

CUSTOMER_STEPS = (
    "customer_segments", "customers", "customer_addresses", "customer_contacts",
    "customer_brands", "customer_customer_brand",
)
STORE_STEPS = (
    "store_segments", "retail_chains", "store_brands", "stores", "store_cnpjs",
    "store_addresses", "store_contacts",
)
USER_STEPS = ("users", "user_roles")
CONTRACT_STEPS = (
    "contracts", "billings", "promoter_tasks", "contract_scenarios", "contract_scenario_stores",
    "contract_sellers", "contract_team_members", "contract_contacts", "contract_partners",
    "contract_additional_charges", "contract_scenarios_brands",
)

# Target tables a step needs; a missing one is built first.
NEEDS = {
    "customer_addresses": ("customers",),
    "customer_contacts": ("customers",),
    "customer_brands": ("customer_segments",),
    "customer_customer_brand": ("customers", "customer_brands"),
    "store_brands": ("retail_chains", "store_segments"),
    "stores": ("store_brands",),
    "store_cnpjs": ("stores",),
    "store_addresses": ("stores",),
    "store_contacts": ("stores",),
    "user_roles": ("users",),
    "contracts": ("customers",),
    "billings": ("contracts", "customers"),
    "contract_scenarios": ("contracts", "billings", "promoter_tasks"),
    "contract_scenario_stores": ("contract_scenarios", "stores"),
    "contract_sellers": ("contracts", "users"),
    "contract_team_members": ("contracts", "users"),
    "contract_contacts": ("contracts",),
    "contract_partners": ("contracts",),
    "contract_additional_charges": ("contracts", "billings"),
    "contract_scenarios_brands": ("customer_customer_brand", "contracts", "contract_scenarios"),
}


@dataclass
class Run:
    """One run: sources, target store, scope, load policy and the constants of the run.

    ``run_id`` names the run in the store's journal; the same id again resumes it.
    """

    source: object
    store: TargetStore
    run_ts: str
    params: ScopeParams = field(default_factory=ScopeParams)
    policy: load.LoadPolicy = field(default_factory=load.LoadPolicy)
    sheet: DataFrame | None = None
    roles: DataFrame | None = None
    people: DataFrame | None = None
    preferred_role: str = ""
    default_role: str = ""
    fallback_user_id: str | None = None
    run_id: str | None = None
    use_saved_scope: bool = True

    def __post_init__(self) -> None:
        self.terms = sheets.sheet_terms(self.sheet) if self.sheet is not None else None
        self._effective: ScopeParams | None = None

    def saved_scope(self) -> DataFrame | None:
        """SRC5: the scope document of the store, unless the run leaves it aside."""
        return reports.load_scope(self.store) if self.use_saved_scope else None

    def requested(self) -> DataFrame | None:
        """SET5: the contracts of the saved scope; without any, those asked for; None: all."""
        saved = self.saved_scope()
        if saved is not None:
            ids = scope.dimension(saved, scope.CONTRACT, "contract_id")
            if not ids.isEmpty():
                return ids
        return self.params.contract_ids

    def effective(self) -> ScopeParams:
        """SET1: the requested contracts, cut to those the sheet lists when there is a sheet.

        A run whose request and sheet have no contract in common stops here.
        """
        if self._effective is None:
            ids = self.requested()
            if self.terms is not None:
                ids = scope.intersect_sheet(ids, self.terms.select("contract_id"))
                scope.require_rows(ids, "the sheet lists none of the requested contracts")
            self._effective = self.params if ids is None else self.params.with_ids(ids)
        return self._effective

    @property
    def is_restricted(self) -> bool:
        """Whether the run covers a part of the source only, by request or by its sheet."""
        return self.effective().is_restricted

    def lines(self) -> DataFrame:
        return self.source.table("contract_lines")

    def scoped_lines(self) -> DataFrame:
        return in_scope(self.lines(), self.effective())

    def scoped(self, name: str) -> DataFrame:
        """A source table keyed by contract, cut to the contracts in scope."""
        ids = self.effective().contract_ids
        table = self.source.table(name)
        return table if ids is None else match.within(table, ids, ["contract_id"])

    def wanted(self, column: str) -> DataFrame:
        """The ids of one dimension in scope; with a limit (SRT1) the first of them."""
        found = self.scoped_lines().filter(F.col(column).isNotNull())
        ids = found.select(F.col(column).alias("id")).distinct()
        return scope.sample(ids, self.effective(), "id")

    def target(self, name: str) -> DataFrame:
        table = self.store.read(name)
        if table is None:
            raise ValueError(f"{name} has not been loaded")
        return table

    def contract_keys(self) -> DataFrame:
        return match.key_map(self.target("contracts"))

    def contract_billings(self) -> DataFrame:
        return billing.computed_billings(self.target("contracts"))


def _load_by_policy(run: Run, table: str, incoming: DataFrame, keys: Sequence[str]) -> None:
    existing = run.store.read(table)
    removed = incoming.select(*keys).distinct()
    buckets = run.store.bucket_count(table)
    in_buckets = buckets is not None and list(keys) == [schemas.BUCKETED[table]]
    if in_buckets and run.policy.mode(run.is_restricted, True) == "replace_by_key":
        content = load.replace_in_buckets(existing, incoming, removed, keys[0], buckets)
    else:
        content = load.apply_policy(run.policy, run.is_restricted, existing, incoming, removed, keys)
    run.store.write(table, content)


def _append_new(run: Run, table: str, incoming: DataFrame, keys: Sequence[str]) -> None:
    """LOD6 / LOD7: write the rows of new keys only; the first load writes all."""
    existing = run.store.read(table)
    if existing is None:
        run.store.write(table, incoming)
    else:
        run.store.append(table, load.new_rows(existing, incoming, keys))


def _keys_of(run: Run, found: DataFrame) -> DataFrame:
    """The loaded contracts a step found, by their new key."""
    wanted = found.select(F.col("contract_id").alias("legacy_id"))
    return match.within(run.contract_keys(), wanted, ["legacy_id"]).select(
        F.col("id").alias("contract_id")
    )


def _children_of_contracts(run: Run, table: str, incoming: DataFrame, found: DataFrame) -> None:
    """LOD5: replace the children of the contracts the step found; all others stay."""
    existing = run.store.read(table)
    if existing is None or run.policy.clear or not run.is_restricted:
        run.store.write(table, incoming)
        return
    removed = _keys_of(run, found)
    run.store.write(table, load.replace_by_key(existing, incoming, removed, ["contract_id"]))


def _customer_segments(run: Run) -> None:
    """PIP1: all segments, or with a saved scope those it covers."""
    segments, saved, wanted = run.source.table("segments"), run.saved_scope(), None
    if saved is not None:
        wanted = scope_refresh.segments_in_scope(
            saved, run.scoped_lines(), segments, run.source.table("contract_master"),
            run.source.table("parties"),
        )
    run.store.write("customer_segments", customers.customer_segments(segments, wanted))


def _customers(run: Run) -> None:
    """PIP2 with LOD3: groups that hold any incoming legacy id are replaced."""
    parties = run.source.table("parties")
    wanted = run.wanted("customer_id")
    key_rows = customers.customer_keys(parties, wanted)
    rows = customers.customers(parties, wanted)
    old, old_keys = run.store.read("customers"), run.store.read("customer_legacy_ids")
    if old is not None and old_keys is not None and not run.policy.clear:
        if run.is_restricted:
            touched = load.with_any_element(old_keys, key_rows)
            removed = touched.unionByName(key_rows.select("id")).distinct()
            rows = load.replace_by_key(old, rows, removed, ["id"])
            key_rows = load.replace_by_key(old_keys, key_rows, removed, ["id"])
    # Both are published with the step, so no version has records without keys or keys without records.
    run.store.write("customers", rows)
    run.store.write("customer_legacy_ids", key_rows)


def _customer_addresses(run: Run) -> None:
    rows = customers.addresses(
        run.source.table("parties"), run.target("customer_legacy_ids"), run.source.table("places")
    )
    run.store.write("addresses", rows, part=customers.OWNER)


def _customer_contacts(run: Run) -> None:
    rows = customers.contacts(run.source.table("parties"), run.target("customer_legacy_ids"))
    run.store.write("contacts", rows, part=customers.OWNER)


def _customer_brands(run: Run) -> None:
    """PIP5 with LOD1: links to brands that are gone go with them."""
    rows = customers.customer_brands(
        run.lines(), run.target("customer_segments"), run.effective(), run.run_ts
    )
    brands = run.store.write("customer_brands", rows).select(F.col("id").alias("customer_brand_id"))
    for child in ("customer_customer_brand", "contract_scenarios_brands"):
        linked = run.store.read(child)
        if linked is not None:
            run.store.write(child, match.within(linked, brands, ["customer_brand_id"]))


def _customer_customer_brand(run: Run) -> None:
    incoming = customers.customer_customer_brand(
        run.lines(), run.target("customer_legacy_ids"), run.target("customer_brands"),
        run.effective(),
    )
    pair = ["customer_id", "customer_brand_id"]
    _append_new(run, "customer_customer_brand", incoming.dropDuplicates(pair), pair)


def _store_segments(run: Run) -> None:
    records = match.within(run.source.table("store_records"), run.wanted("store_id"), ["id"])
    wanted = records.filter(F.col("channel_id").isNotNull()).select("channel_id").distinct()
    run.store.write(
        "store_segments", stores.store_segments(run.source.table("channels"), wanted)
    )


def _retail_chains(run: Run) -> None:
    rows = stores.retail_chains(run.source.table("chains"), run.wanted("chain_id"))
    _load_by_policy(run, "retail_chains", rows, ["legacy_id"])


def _store_brands(run: Run) -> None:
    rows = stores.store_brands(
        run.source.table("brands"), run.wanted("brand_id"), run.source.table("store_records"),
        run.target("retail_chains"), run.target("store_segments"),
    )
    _load_by_policy(run, "store_brands", rows, ["legacy_id"])


def _stores(run: Run) -> None:
    rows = stores.stores(
        run.source.table("store_records"), run.wanted("store_id"), run.target("store_brands")
    )
    _load_by_policy(run, "stores", rows, ["legacy_id"])


def _store_cnpjs(run: Run) -> None:
    rows = stores.store_cnpjs(run.source.table("store_records"), run.target("stores"))
    run.store.write("store_cnpjs", rows)


def _store_addresses(run: Run) -> None:
    rows = stores.addresses(
        run.source.table("store_records"), run.target("stores"), run.source.table("places")
    )
    run.store.write("addresses", rows, part=stores.OWNER)


def _store_contacts(run: Run) -> None:
    rows = stores.contacts(run.source.table("store_records"), run.target("stores"))
    run.store.write("contacts", rows, part=stores.OWNER)


def _users(run: Run) -> None:
    """PIP14: replace everything on request, else add only users not loaded yet (LOD6)."""
    rows = users.users(scope.sample(run.source.table("source_users"), run.params, "id"))
    if run.policy.clear:
        run.store.write("users", load.replace_all(rows))
    else:
        _append_new(run, "users", rows, ["legacy_id"])


def _user_roles(run: Run) -> None:
    if run.roles is None:
        raise ValueError("user_roles needs the table of roles")
    roles = users.require_roles(run.roles)
    rows = users.user_roles(run.target("users"), roles, run.preferred_role, run.default_role)
    run.store.write("user_roles", rows)


def _contracts(run: Run) -> None:
    rows = contracts.contracts(
        run.lines(), run.source.table("contract_master"), run.target("customer_legacy_ids"),
        run.terms, run.effective(), run.run_ts,
    )
    _load_by_policy(run, "contracts", rows, ["legacy_id"])


def _billings(run: Run) -> None:
    """PIP17 for contracts the sheet lists, then placeholders for customers left without any."""
    contract_rows = run.target("contracts")
    existing = run.store.read("billings")
    if run.terms is not None:
        wanted = scope.billing_scope(
            run.requested(), run.terms.select("contract_id"), match.key_map(contract_rows)
        )
        billed = billing.contracts_to_bill(
            run.lines(), wanted, run.target("customer_legacy_ids")
        )
        incoming = billing.billings(billed, run.terms, run.target("customers"), run.run_ts)
        existing = run.store.write(
            "billings", billing.load_billings(existing, incoming, run.policy, run.is_restricted)
        )
    elif existing is None:
        existing = run.store.write(
            "billings", billing.conform(contract_rows.limit(0).select("customer_id"), "billings")
        )
    run.store.append("billings", billing.placeholder_rows(existing, contract_rows, run.run_ts))


def _promoter_tasks(run: Run) -> None:
    """PIP18: existing tasks stay, new names are added."""
    incoming = contracts.promoter_tasks(run.lines(), run.effective(), run.run_ts)
    _append_new(run, "promoter_tasks", incoming, ["name"])


def _contract_scenarios(run: Run) -> None:
    """PIP19 after the hard stop on unknown tasks; the key map is kept for PIP20."""
    tasks = run.target("promoter_tasks")
    scenarios = contracts.distinct_scenarios(run.scoped_lines())
    quality.require_mapped(contracts.unknown_tasks(scenarios, tasks), "task names")
    keyed = contracts.keyed_scenarios(
        run.lines(), run.contract_billings(), run.effective(), run.run_ts
    )
    run.store.write("scenario_keys", contracts.scenario_key_map(keyed))
    _children_of_contracts(
        run, "contract_scenarios", contracts.contract_scenarios(keyed), run.scoped_lines()
    )


def _contract_scenario_stores(run: Run) -> None:
    """PIP20: a restricted run replaces the stores of the contracts it found.

    Only stores of scenarios that other contracts still have are kept, so none outlives its scenario.
    """
    rows = contracts.contract_scenario_stores(
        run.lines(), run.source.table("line_flags"), run.target("scenario_keys"),
        run.target("stores"), run.effective(), run.run_ts,
    )
    existing = run.store.read("contract_scenario_stores")
    if existing is not None and run.is_restricted and not run.policy.clear:
        held = run.target("contract_scenarios").select(
            F.col("id").alias("scenario_id"), "contract_id"
        )
        others = match.without(held, _keys_of(run, run.scoped_lines()), ["contract_id"])
        rows = load.append_all(match.within(existing, others, ["scenario_id"]), rows)
    run.store.write("contract_scenario_stores", rows)


def _contract_sellers(run: Run) -> None:
    if run.terms is None:
        raise ValueError("contract_sellers needs the contract sheet")
    terms = match.within(
        run.terms, run.scoped_lines().select("contract_id").distinct(), ["contract_id"]
    )
    rows = contracts.contract_sellers(
        run.contract_keys(), terms, run.target("users"), run.source.table("source_users"),
        run.run_ts, run.fallback_user_id,
    )
    run.store.write("contract_sellers", rows)


def _contract_team_members(run: Run) -> None:
    rows = contracts.contract_team_members(
        run.scoped_lines(), run.scoped("contract_master"), run.contract_keys(),
        match.key_map(run.target("users")), run.run_ts,
    )
    _children_of_contracts(run, "contract_team_members", rows, run.scoped_lines())


def _contract_contacts(run: Run) -> None:
    rows = contracts.contract_contacts(run.scoped_lines(), run.contract_keys(), run.run_ts)
    _children_of_contracts(run, "contract_contacts", rows, run.scoped_lines())


def _contract_partners(run: Run) -> None:
    if run.people is None:
        raise ValueError("contract_partners needs the table of people")
    rows = contracts.contract_partners(
        run.scoped_lines(), run.contract_keys(), run.people, run.run_ts
    )
    _children_of_contracts(run, "contract_partners", rows, run.scoped_lines())


def _contract_additional_charges(run: Run) -> None:
    rows = contracts.contract_additional_charges(
        run.scoped("contract_master"), run.contract_billings(), run.run_ts
    )
    _children_of_contracts(
        run, "contract_additional_charges", rows, run.scoped("contract_master")
    )


def _contract_scenarios_brands(run: Run) -> None:
    rows = contracts.contract_scenarios_brands(
        run.target("customer_customer_brand"), run.target("contract_scenarios")
    )
    run.store.write("contract_scenarios_brands", rows)


STEPS: dict[str, Callable[[Run], None]] = {
    name: globals()[f"_{name}"]
    for name in (*CUSTOMER_STEPS, *STORE_STEPS, *USER_STEPS, *CONTRACT_STEPS)
}

# Target table of the steps that are not named after it.
TABLE_OF_STEP = {
    "customer_addresses": "addresses",
    "customer_contacts": "contacts",
    "store_addresses": "addresses",
    "store_contacts": "contacts",
}


def run_step(run: Run, step: str) -> None:
    """One step, after the steps whose tables it needs and that were never loaded.

    All tables of a step come out together; a step that fails changes nothing.
    """
    for needed in NEEDS.get(step, ()):
        if run.store.read(TABLE_OF_STEP.get(needed, needed)) is None:
            run_step(run, needed)
    with run.store.step(step, run.run_id):
        STEPS[step](run)


def _run_all(run: Run, steps: Sequence[str]) -> None:
    """The steps in order; a run with an id leaves out those it has already published."""
    done = run.store.done(run.run_id) if run.run_id is not None else ()
    for step in steps:
        if step not in done:
            run_step(run, step)


def run_customers(run: Run, steps: Sequence[str] = CUSTOMER_STEPS) -> None:
    _run_all(run, steps)


def run_stores(run: Run, steps: Sequence[str] = STORE_STEPS) -> None:
    _run_all(run, steps)


def run_users(run: Run, steps: Sequence[str] = USER_STEPS) -> None:
    _run_all(run, steps)


def run_contracts(run: Run, steps: Sequence[str] = CONTRACT_STEPS) -> None:
    _run_all(run, steps)


def run_legacy_clients(run: Run) -> None:
    """PIP27: every table of the older client model, replaced as a whole and published at once."""
    with run.store.step("legacy_clients", run.run_id):
        for table, build in legacy_clients.TABLES.items():
            run.store.write(table, build(run.source.table("parties"), run.source.table("places")))


def save_scope(run: Run) -> DataFrame:
    """PIP28 + PIP29 + SNK2: refresh the scope under the run's parameters and save it.

    Later runs on the same store cover the saved contracts, whatever they ask for (SET5).
    """
    table = run.source.table
    with run.store.step("scope"):
        found = scope_refresh.refresh(
            run.lines(), table("contract_master"), table("store_records"), table("segments"),
            table("parties"), run.params,
        )
        saved = reports.save_scope(run.store, found)
        filled = scope_refresh.fill_dependencies(saved, run.lines(), table("store_records"))
        return reports.save_scope(run.store, filled)


def run_everything(run: Run) -> None:
    """PIP30: customers, stores, users, contracts, then the run's entry in the history.

    A run with an id that was lost on the way goes on at its first unfinished step.
    """
    started = time.monotonic()
    run_customers(run)
    run_stores(run)
    run_users(run)
    run_contracts(run)
    if run.run_id is None or "run_history" not in run.store.done(run.run_id):
        with run.store.step("run_history", run.run_id):
            reports.save_run(
                run.store, run.store.root, run.run_ts, time.monotonic() - started, measures(run)
            )


def measures(run: Run) -> dict[str, int]:
    """VAL10: rows of every loaded table and the legacy ids behind the customers.

    The rows were counted while they were written, so no table is read.
    """
    tables = {*(TABLE_OF_STEP.get(s, s) for s in STEPS), "customer_legacy_ids"}
    loaded = run.store.content().tables
    return {t: run.store.rows(t) for t in sorted(tables) if t in loaded}


def _filled_addresses(records: DataFrame, key_rows: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Owners and address types with a street, counted once each."""
    owned = match.map_key(
        records.withColumnRenamed("id", "legacy_id"), key_rows, "legacy_id", "owner_id"
    )
    streets = [
        {"type": F.lit(kind), "street": F.col(f"{prefix}street")} for prefix, kind in groups.items()
    ]
    filled = reshape.typed_rows(owned, ["owner_id"], streets).filter(
        text.not_blank(F.col("street"))
    )
    return rollup.count_groups(filled, ["owner_id", "type"], "rows")


def _filled_contacts(records: DataFrame, key_rows: DataFrame) -> DataFrame:
    kept = match.within(records, key_rows.select(F.col("legacy_id").alias("id")), ["id"])
    return quality.count_rows(reshape.contact_rows(kept, ["id"]))


Counts = dict[str, tuple[DataFrame, DataFrame | int]]


def _reconcile_customers(run: Run) -> Counts:
    parties, key_rows = run.source.table("parties"), run.target("customer_legacy_ids")
    names = run.scoped_lines().filter(text.not_blank(F.col("customer_name")))
    return {
        "customer_segments": (
            quality.count_rows(run.source.table("segments")), run.store.rows("customer_segments"),
        ),
        "customer_addresses": (
            _filled_addresses(parties, key_rows, customers.ADDRESS_GROUPS),
            run.store.rows("addresses", customers.OWNER),
        ),
        "customer_contacts": (
            _filled_contacts(parties, key_rows),
            run.store.rows("contacts", customers.OWNER),
        ),
        "customer_brands": (
            rollup.count_groups(names, [text.strip(F.col("customer_name"))], "rows"),
            run.store.rows("customer_brands"),
        ),
    }


def _reconcile_stores(run: Run) -> Counts:
    rows = run.store.rows
    records, key_rows = run.source.table("store_records"), match.key_map(run.target("stores"))
    loaded = match.within(records, key_rows.select(F.col("legacy_id").alias("id")), ["id"])
    in_lines = match.within(records, run.wanted("store_id"), ["id"])
    return {
        "store_segments": (rollup.count_ids(in_lines, "channel_id"), rows("store_segments")),
        "store_cnpjs": (
            quality.count_rows(loaded.filter(text.not_blank(F.col("tax_id")))), rows("store_cnpjs"),
        ),
        "store_addresses": (
            _filled_addresses(records, key_rows, {"main_": "main"}),
            run.store.rows("addresses", stores.OWNER),
        ),
        "store_contacts": (
            _filled_contacts(records, key_rows),
            run.store.rows("contacts", stores.OWNER),
        ),
    }


def _reconcile_contracts(run: Run) -> Counts:
    lines, count, rows = run.scoped_lines(), quality.count_rows, run.store.rows
    loaded = run.contract_keys().select(F.col("legacy_id").alias("contract_id"))
    own = match.within(lines, loaded, ["contract_id"])
    master = match.within(run.scoped("contract_master"), loaded, ["contract_id"])
    keys = ["contract_id", "frequency", "hours", F.coalesce("price", F.lit(0)).alias("price")]
    dates_of = ["contract_id", "contract_created_at", "contract_updated_at"]
    clients = own.filter("store_client_id IS NOT NULL AND store_client_name IS NOT NULL")
    sold = match.within(
        own, master.filter(F.col("seller_id").isNotNull()).select("contract_id"), ["contract_id"]
    )
    steps = {
        "contract_scenarios": (
            rollup.count_groups(own.filter(F.col("customer_id").isNotNull()), keys, "rows"),
            rows("contract_scenarios"),
        ),
        "contract_scenario_stores": (
            count(own.filter(F.col("customer_id").isNotNull())),
            rows("contract_scenario_stores"),
        ),
        "contract_team_members": (
            rollup.count_groups(sold, dates_of, "rows"), rows("contract_team_members"),
        ),
        "contract_partners": (
            rollup.count_groups(clients, [*dates_of, "store_client_id", "store_client_name"], "rows"),
            rows("contract_partners"),
        ),
        "contract_additional_charges": (
            rollup.count_charges(master), rows("contract_additional_charges"),
        ),
    }
    if run.terms is not None:
        listed = match.within(loaded, run.terms, ["contract_id"])
        steps["contract_sellers"] = (
            listed.agg((F.count("*") * 2).alias("rows")), rows("contract_sellers"),
        )
    return steps


#: Steps whose source count is the number of distinct ids of one column of the lines.
COUNTED_IDS = {
    "customers": "customer_id", "retail_chains": "chain_id", "store_brands": "brand_id",
    "stores": "store_id", "contracts": "contract_id",
}


def reconcile_run(run: Run) -> DataFrame:
    """VAL1 + VAL2: source and target counts of every step of a finished run.

    Like is compared with like: customers by the ids they stand for, shared child tables by owner
    type, sellers by the two rows each contract gets. Targets are counted where they were written;
    the ids of all dimensions are counted in one pass over the lines.
    """
    rows = run.store.rows
    loaded = {step: rows(step) for step in COUNTED_IDS} | {"customers": rows("customer_legacy_ids")}
    ids = quality.reconcile_row(rollup.distinct_counts(run.scoped_lines(), COUNTED_IDS), loaded)
    accounts: Counts = {
        "users": (quality.count_rows(run.source.table("source_users")), rows("users")),
        "user_roles": (quality.count_rows(run.target("users")), rows("user_roles")),
    }
    steps = {**_reconcile_customers(run), **_reconcile_stores(run), **accounts}
    return quality.reconcile({**steps, **_reconcile_contracts(run)}).unionByName(ids)


def reject_list(run: Run) -> DataFrame:
    """VAL9: the legacy keys a finished run left out, with the reason."""
    lines = run.scoped_lines()
    brands = match.within(run.source.table("brands"), run.wanted("brand_id"), ["id"])
    records = match.within(run.source.table("store_records"), run.wanted("store_id"), ["id"])
    sold = match.within(run.scoped("contract_master"), lines, ["contract_id"])
    parts = [
        match.unmapped(lines, run.contract_keys(), "contract_id", "contract not loaded"),
        match.unmapped(lines, run.target("customer_legacy_ids"), "customer_id", "customer not loaded"),
        match.unmapped(lines, match.key_map(run.target("stores")), "store_id", "store not loaded"),
        match.unmapped(
            records, match.key_map(run.target("store_brands")), "brand_id", "brand not loaded"
        ),
        match.unmapped(
            brands, match.key_map(run.target("retail_chains")), "chain_id", "chain not loaded"
        ),
        match.unmapped(sold, match.key_map(run.target("users")), "seller_id", "user not loaded"),
    ]
    return quality.union_all(parts)
