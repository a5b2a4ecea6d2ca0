from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import load, match, scope
from ledgerloom.operators.scope import ScopeParams
from ledgerloom.plans import runner
from ledgerloom.sources.catalog import TargetStore
from ledgerloom.sources.schemas import schema
from standin import rules


@pytest.fixture(scope="module")
def finished(spark, tables, tmp_path_factory):
    run = runner.Run(
        source=tables.source,
        store=TargetStore(spark, str(tmp_path_factory.mktemp("run"))),
        run_ts=rules.RUN_TS,
        params=ScopeParams(
            notice_min=rules.NOTICE_MIN, start_max=rules.START_MAX, statuses=rules.STATUSES
        ),
        sheet=tables["sheet"],
        roles=tables["roles"],
        people=tables["people"],
        preferred_role="role-asia",
    )
    runner.run_everything(run)
    return run


def rows(df):
    return sorted((str(r) for r in df.collect()))


def test_every_table_is_loaded(finished):
    for step in runner.STEPS:
        name = runner.TABLE_OF_STEP.get(step, step)
        table = finished.target(name)
        assert table.schema.simpleString() == schema(name).simpleString()
        assert table.count() > 0, name


def test_contracts_are_the_sheet_in_scope(finished, tables):
    listed = finished.terms.select("contract_id")
    lines = match.within(finished.scoped_lines(), listed, ["contract_id"])
    loaded = finished.target("contracts")
    assert loaded.select("legacy_id").distinct().count() == loaded.count()
    assert match.without(
        loaded.select(F.col("legacy_id").alias("contract_id")), lines, ["contract_id"]
    ).count() == 0


def test_every_party_is_in_one_group(finished):
    keys = finished.target("customer_legacy_ids")
    assert keys.select("legacy_id").distinct().count() == keys.count()
    assert rows(finished.target("customers").select("id")) == rows(keys.select("id").distinct())


CHILDREN = [
    ("contracts", "customer_id", "customers"),
    ("billings", "customer_id", "customers"),
    ("contract_scenarios", "contract_id", "contracts"),
    ("contract_scenarios", "billing_id", "billings"),
    ("contract_scenarios", "promoter_task_id", "promoter_tasks"),
    ("contract_scenario_stores", "scenario_id", "contract_scenarios"),
    ("contract_scenario_stores", "store_id", "stores"),
    ("contract_sellers", "contract_id", "contracts"),
    ("contract_sellers", "user_id", "users"),
    ("contract_team_members", "user_id", "users"),
    ("contract_contacts", "contract_id", "contracts"),
    ("contract_partners", "contract_id", "contracts"),
    ("contract_additional_charges", "billing_id", "billings"),
    ("contract_scenarios_brands", "scenario_id", "contract_scenarios"),
    ("contract_scenarios_brands", "customer_brand_id", "customer_brands"),
    ("customer_customer_brand", "customer_id", "customers"),
    ("store_brands", "retail_chain_id", "retail_chains"),
    ("store_brands", "store_segment_id", "store_segments"),
    ("stores", "store_brand_id", "store_brands"),
    ("store_cnpjs", "store_id", "stores"),
    ("user_roles", "user_id", "users"),
]


def test_no_child_is_an_orphan(finished):
    for child, key, parent in CHILDREN:
        parents = finished.target(parent).select(F.col("id").alias(key))
        assert match.without(finished.target(child).select(key), parents, [key]).count() == 0, (child, key)


def test_owners_of_shared_tables(finished):
    for table, owner, kind in (
        ("addresses", "addressable_id", "addressable_type"),
        ("contacts", "contactable_id", "contactable_type"),
    ):
        found = finished.target(table)
        assert {r[0] for r in found.select(kind).distinct().collect()} == {"Customer", "Store"}
        for name, parent in (("Customer", "customers"), ("Store", "stores")):
            parents = finished.target(parent).select(F.col("id").alias(owner))
            assert match.without(found.filter(F.col(kind) == name), parents, [owner]).count() == 0


def test_reconciliation_and_history(finished):
    report = {r["step"]: r for r in runner.reconcile_run(finished).collect()}
    assert len(report) == 21
    exact = (
        "customer_segments", "customer_addresses", "customer_contacts", "customer_brands",
        "store_addresses", "store_contacts", "user_roles", "contract_sellers",
        "contract_additional_charges", "contract_scenarios", "contract_partners",
    )
    assert [s for s in exact if not report[s]["ok"]] == []
    # What is left out is in the reject list or a line reject, so no step loads more than it reads.
    assert all(r["diff"] >= 0 for r in report.values())
    history = finished.store.read("run_history").collect()
    assert len(history) == 1
    assert history[0]["measures"]["contracts"] == finished.target("contracts").count()


def test_reject_list_explains_the_differences(finished):
    report = {r["step"]: r["diff"] for r in runner.reconcile_run(finished).collect()}
    rejects = {r["reason"]: r["n"] for r in runner.reject_list(finished).groupBy("reason").agg(
        F.count("*").alias("n")).collect()}
    assert rejects.get("contract not loaded", 0) == report["contracts"]
    assert rejects.get("customer not loaded", 0) == report["customers"]
    assert rejects.get("store not loaded", 0) == report["stores"]


RELOADED = ("customers", "customer_legacy_ids", "contracts", "billings", "contract_scenarios",
            "contract_scenario_stores", "contract_additional_charges", "stores", "addresses",
            "contacts", "users")


def test_second_run_changes_nothing(finished):
    before = {t: rows(finished.target(t)) for t in RELOADED}
    runner.run_customers(finished)
    runner.run_stores(finished)
    runner.run_users(finished)
    runner.run_contracts(finished, runner.CONTRACT_STEPS[:5])
    runner.run_step(finished, "contract_additional_charges")
    for table, old in before.items():
        assert rows(finished.target(table)) == old, table


def test_narrow_run_keeps_the_rest(spark, finished):
    """A run over one contract replaces that contract's rows and leaves all others."""
    before = finished.target("contracts")
    one = before.orderBy("legacy_id").first()
    narrow = runner.Run(
        source=finished.source, store=finished.store, run_ts="2030-01-01 00:00:00",
        params=ScopeParams(contract_ids=scope.id_table(spark, [one["legacy_id"]])),
        sheet=finished.sheet, roles=finished.roles, people=finished.people,
    )
    charges = rows(finished.target("contract_additional_charges"))
    count = before.count()
    runner.run_step(narrow, "contracts")
    assert finished.target("contracts").count() == count
    runner.run_step(narrow, "contract_additional_charges")
    assert rows(finished.target("contract_additional_charges")) == charges


def test_restricted_runs_keep_what_they_do_not_own(spark, tables, tmp_path):
    """Runs by status and by sheet replace their own contracts; an empty scope stops."""
    store = TargetStore(spark, str(tmp_path))

    def run(**scope_of):
        return runner.Run(source=tables.source, store=store, run_ts=rules.RUN_TS, **scope_of)

    steps = ("contracts", "contract_scenarios", "contract_scenario_stores", "contract_team_members")
    for step in steps:
        runner.run_step(run(), step)
    before = {s: rows(run().target(s)) for s in steps}
    by_status = run(params=ScopeParams(statuses=(6,)))
    for step in steps:
        runner.run_step(by_status, step)
    assert {s: rows(run().target(s)) for s in steps} == before
    by_sheet = run(sheet=tables["sheet"])
    runner.run_step(by_sheet, "contracts")
    assert run().target("contracts").count() == len(before["contracts"])
    with pytest.raises(ValueError, match="requested contracts"):
        runner.run_step(run(sheet=tables["sheet"].limit(0)), "contracts")
    assert run().target("contracts").count() == len(before["contracts"])


def test_limit_holds_in_every_module(spark, tables, tmp_path):
    run = runner.Run(
        source=tables.source, store=TargetStore(spark, str(tmp_path)), run_ts=rules.RUN_TS,
        params=ScopeParams(limit=5),
    )
    for step in ("customers", "stores", "users"):
        runner.run_step(run, step)
        assert run.target(step).count() <= 5
        # Of the first five source rows some may have no name.
        assert run.target(step).count() > 0


def test_missing_prerequisites_are_built(spark, tables, tmp_path):
    run = runner.Run(
        source=tables.source, store=TargetStore(spark, str(tmp_path)), run_ts=rules.RUN_TS,
        policy=load.LoadPolicy(clear=True),
    )
    runner.run_step(run, "stores")
    for table in ("retail_chains", "store_segments", "store_brands", "stores"):
        assert run.target(table).count() > 0
    with pytest.raises(ValueError, match="sheet"):
        runner.run_step(run, "contract_sellers")


def test_legacy_clients(spark, tables, tmp_path):
    run = runner.Run(source=tables.source, store=TargetStore(spark, str(tmp_path)), run_ts=rules.RUN_TS)
    runner.run_legacy_clients(run)
    assert run.target("client_customers").count() == tables["parties"].count()
    held = run.target("shareholders").select("shareholder_id")
    for child in ("shareholder_phones", "shareholder_pii"):
        assert match.without(run.target(child), held, ["shareholder_id"]).count() == 0


def test_narrow_customer_run_replaces_touched_groups(spark, tables, tmp_path):
    """LOD3: a restricted run replaces every golden record that holds one of its legacy ids."""
    store = TargetStore(spark, str(tmp_path))
    wide = runner.Run(source=tables.source, store=store, run_ts=rules.RUN_TS)
    runner.run_step(wide, "customers")
    before = rows(wide.target("customers"))
    keys = rows(wide.target("customer_legacy_ids"))
    sizes = wide.target("customer_legacy_ids").groupBy("id").agg(F.count("*").alias("n"))
    largest = sizes.orderBy(F.col("n").desc(), "id").first()["id"]
    members = wide.target("customer_legacy_ids").filter(F.col("id") == largest)
    group = sorted(r["legacy_id"] for r in members.collect())
    some = tables["contract_lines"].filter(F.col("customer_id") == group[1]).select("contract_id")
    narrow = runner.Run(
        source=tables.source, store=store, run_ts=rules.RUN_TS, params=ScopeParams(contract_ids=some)
    )
    runner.run_step(narrow, "customers")
    now = {i for r in wide.target("customer_legacy_ids").collect() for i in [r["legacy_id"]]}
    # The group is now the one customer in scope; its other ids left with the replaced record.
    assert now & set(group) == {group[1]}
    assert wide.target("customers").count() == len(before)
    runner.run_step(wide, "customers")
    assert rows(wide.target("customers")) == before
    assert rows(wide.target("customer_legacy_ids")) == keys


class Losing(TargetStore):
    """A store whose write of one table fails."""

    losing = None

    def _new_folder(self, table, df, part):
        if table == self.losing:
            raise RuntimeError(f"{table} was lost")
        return super()._new_folder(table, df, part)


def test_a_lost_run_goes_on_at_its_first_unfinished_step(spark, tables, tmp_path):
    store = Losing(spark, str(tmp_path))
    store.losing = "customer_legacy_ids"

    def run(run_id="night-1"):
        return runner.Run(source=tables.source, store=store, run_ts=rules.RUN_TS, run_id=run_id)

    # The first of the step's two tables is written, the second is lost: neither is published.
    with pytest.raises(RuntimeError, match="lost"):
        runner.run_customers(run())
    assert store.done("night-1") == ("customer_segments",)
    assert store.read("customers") is None and store.read("customer_legacy_ids") is None
    store.losing = None
    segments = store.content().folders("customer_segments")
    runner.run_customers(run())
    assert store.done("night-1") == runner.CUSTOMER_STEPS
    assert store.content().folders("customer_segments") == segments
    assert store.read("customers").count() == store.rows("customers") > 0
    # A finished run does nothing more under its id; another id, or none, loads again.
    before = store.versions()
    runner.run_customers(run())
    assert store.versions() == before
    runner.run_customers(run("night-2"), ["customer_segments"])
    runner.run_customers(run(None), ["customer_segments"])
    assert len(store.versions()) == len(before) + 2 and store.done("night-2") == ("customer_segments",)


def jobs_of(spark, build):
    """The result of a call and the number of Spark jobs it started."""
    context = spark.sparkContext
    context.setJobGroup("counted", "jobs of one call")
    try:
        found = build()
    finally:
        context._jsc.clearJobGroup()
    return found, len(context.statusTracker().getJobIdsForGroup("counted"))


def test_totals_of_a_run_start_no_job(spark, finished):
    found, jobs = jobs_of(spark, lambda: runner.measures(finished))
    assert jobs == 0
    assert found == {t: finished.target(t).count() for t in found} and len(found) == 25


def test_shared_tables_are_loaded_by_owner(finished):
    """LOD4 in a run: loading one owner type leaves the folders of the other as they are."""
    content = finished.store.content()
    of_stores = content.folders("addresses", "Store")
    assert of_stores and len(of_stores) + len(content.folders("addresses", "Customer")) == len(
        content.folders("addresses"))
    runner.run_step(finished, "customer_addresses")
    assert finished.store.content().folders("addresses", "Store") == of_stores


def test_accounts_are_appended(finished):
    """LOD6 in a run: accounts that are loaded stay in their folders."""
    before = finished.store.content().folders("users")
    runner.run_step(finished, "users")
    assert finished.store.content().folders("users") == before


def test_a_saved_scope_holds_in_every_step(spark, tables, tmp_path):
    """SNK2, SRC5, SET5: the saved contracts decide, not those a later run asks for."""
    store = TargetStore(spark, str(tmp_path))

    def run(ids=None, **options):
        wanted = ScopeParams(contract_ids=scope.id_table(spark, ids)) if ids else ScopeParams()
        return runner.Run(source=tables.source, store=store, run_ts=rules.RUN_TS, params=wanted, **options)

    owned = tables["contract_lines"].filter("customer_id IS NOT NULL").select("contract_id").distinct()
    first, second, third = (r[0] for r in owned.orderBy("contract_id").limit(3).collect())
    saved = runner.save_scope(run([first, second]))
    found = {r["id"] for r in saved.filter(F.col("dimension") == scope.CONTRACT).collect()}
    assert found == {first, second}
    dimensions = {r["dimension"] for r in saved.select("dimension").distinct().collect()}
    assert {scope.CUSTOMER, scope.STORE, scope.CONTRACT} <= dimensions
    for asked in (None, [third]):
        lines = run(asked).scoped_lines().select("contract_id").distinct().collect()
        assert {r[0] for r in lines} == {first, second}
    assert run([third]).is_restricted and not run(use_saved_scope=False).is_restricted
    assert {r[0] for r in run([third], use_saved_scope=False).scoped_lines().select("contract_id").collect()} == {third}
    # An empty scope document asks for nothing.
    store.write("scope", saved.limit(0))
    assert {r[0] for r in run([third]).scoped_lines().select("contract_id").collect()} == {third}
    assert not run().is_restricted


def test_a_saved_scope_chooses_the_segments(spark, tables, tmp_path):
    """PIP1: named segments, else those of the lines in scope; a scope without owners has none."""
    store = TargetStore(spark, str(tmp_path))
    run = runner.Run(source=tables.source, store=store, run_ts=rules.RUN_TS)

    def loaded(*entries):
        store.write("scope", spark.createDataFrame(list(entries), schema("scope")))
        fresh = runner.Run(source=tables.source, store=store, run_ts=rules.RUN_TS)
        runner.run_step(fresh, "customer_segments")
        return {r["legacy_id"] for r in fresh.target("customer_segments").collect()}

    runner.run_step(run, "customer_segments")
    every = {r["legacy_id"] for r in run.target("customer_segments").collect()}
    one = min(every)
    assert loaded((scope.SEGMENT, one), (scope.CONTRACT, 1)) == {one}
    assert loaded((scope.STORE, 1)) == set()
    contract = tables["contract_lines"].filter("segment_names IS NOT NULL").orderBy("contract_id").first()
    assert loaded((scope.CONTRACT, contract["contract_id"])) <= every


def test_precedence_plans_without_a_job(spark):
    """FIL13: no job while the plan is built; the first candidate with ids decides."""
    ids = [spark.createDataFrame([(i,) for i in rows], "k long") for rows in ([], [2, 2, 3], [1, 2])]
    found, jobs = jobs_of(spark, lambda: scope.precedence(ids, "k"))
    assert jobs == 0 and sorted(r[0] for r in found.collect()) == [2, 3]
