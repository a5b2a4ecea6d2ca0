"""Physical plans: what reaches the scan, what is aggregated before a shuffle, what never occurs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from conftest import SF
from ledgerloom import session
from standin.checks import QUERIES
from ledgerloom.operators import load, match, rollup, scope
from ledgerloom.plans import contracts, customers
from ledgerloom.sources import schemas
from ledgerloom.sources.catalog import TargetStore
from standin.registry import PARAMS


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_join_and_no_python(spark, name):
    plan = plan_of(spark_entry.queries()[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def written(spark, tables, tmp_path_factory):
    """The contract lines as files, so that plans show what the scan is asked for."""
    path = str(tmp_path_factory.mktemp("lines"))
    tables["contract_lines"].write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_scan_reads_only_what_is_needed(written):
    plan = plan_of(scope.scope_ids(scope.in_scope(written, PARAMS)))
    assert plan.count("FileScan") == 1
    columns = set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", plan)[1]))
    assert columns == {
        "contract_id", "customer_id", "store_id", "brand_id", "chain_id", "status", "start_at", "notice_at",
    }
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan)[1]
    assert "LessThan(start_at" in pushed and "In(status" in pushed and "IsNull(notice_at)" in pushed


def test_rollups_aggregate_before_the_shuffle(written, no_broadcast):
    for df in (
        scope.scope_ids(written),
        rollup.customer_of_contract(written),
        rollup.scenario_rollup(written),
        match.first_per_key(written, ["contract_id"], ["line_id"]),
    ):
        plan = plan_of(df)
        below = plan[plan.rindex("Exchange"):]
        assert "partial_" in below or "functions=[]" in below


def test_contract_rollup_shuffles_lines_once(written, tables, no_broadcast):
    """The lines are rolled up before the join, and the join reuses their partitioning."""
    plan = plan_of(rollup.contract_rollup(written, tables["contract_master"]))
    assert plan.count("Exchange hashpartitioning(contract_id") == 2


def test_distinct_right_side_shares_the_join_shuffle(written, tables, no_broadcast):
    wanted = written.select(F.col("customer_id").alias("id"))
    plan = plan_of(match.within(tables["customer"].withColumnRenamed("c_custkey", "id"), wanted, ["id"]))
    assert plan.count("Exchange") == 2


def test_customer_keys_need_no_shuffle(tables):
    assert "Exchange hash" not in plan_of(customers.customer_keys(tables["parties"]))


def test_golden_merge_is_one_shuffle(spark, tables, tmp_path, no_broadcast):
    path = str(tmp_path / "parties")
    tables["parties"].write.parquet(path)
    plan = plan_of(customers.golden_customers(spark.read.parquet(path)))
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan


def test_child_rows_need_no_shuffle(tables, written):
    from ledgerloom.operators import reshape

    for df in (
        reshape.contact_rows(tables["parties"], ["id"]),
        reshape.email_rows(tables["parties"], ["id"]),
        reshape.charge_rows(tables["contract_master"], ["contract_id"], "2024-01-01 00:00:00"),
        contracts.with_line_numbers(written).withColumns(contracts.scenario_key_columns()),
    ):
        assert "Exchange hash" not in plan_of(df)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_skew(spark):
    """Thresholds at which a hot key of a test table counts as skewed."""
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key in SKEW:
        spark.conf.unset(key)


def test_a_hot_join_key_is_split(spark, small_skew):
    """One key with most rows: adaptive execution splits its partition in every kind of join."""
    rows = spark.range(0, 120_000, 1, 8)
    hot = F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id"))
    # A payload that does not compress, so that the hot partition is large in bytes as well.
    left = rows.select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    right = rows.select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).filter("k % 2 = 0")
    keys = right.select(F.col("k").alias("legacy_id"), F.col("w").cast("string").alias("id"))
    found = match.left_lookup(left, right, ["k"])
    joins = {
        "lookup": found,
        "inner": match.map_key(left, keys, "k", "new"),
        "semi": match.within(left, right, ["k"]),
        "anti": match.without(left, right.filter("k <> 0"), ["k"]),
        "then grouped": found.groupBy("k").agg(F.count("w").alias("n")),
    }
    for name, df in joins.items():
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        assert "skew=true" in execution.executedPlan().toString(), name


def test_hot_null_keys_are_spread(spark, small_skew):
    nulls = spark.range(0, 50_000, 1, 8).select(
        F.lit(None).cast("bigint").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    right = spark.range(100).select(F.col("id").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [
            r["n"] for r in match.without(nulls, right, ["k"])
            .groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * 50_000 / 8


def test_replacing_by_key_shuffles_no_stored_row(spark, tables, tmp_path, no_broadcast):
    """LOD2: the target's side of the anti join and of the write has no exchange."""
    store = TargetStore(spark, str(tmp_path), buckets=4)
    orders = tables["orders"].select(
        F.concat(F.lit("o"), "o_orderkey").alias("id"), F.col("o_orderkey").alias("legacy_id")
    )
    existing = store.write("contracts", schemas.conform(orders, "contracts"))
    fresh = schemas.conform(orders.filter("legacy_id % 7 = 0").withColumn("title", F.lit("new")), "contracts")
    content = load.replace_in_buckets(existing, fresh, fresh, "legacy_id", store.bucket_count("contracts"))
    plan = plan_of(content)
    stored = plan[: plan.index("Exchange")]
    assert "FileScan" in stored and "Bucketed: true" in stored and "SortMergeJoin" in plan
    # Only the removed keys and the incoming rows move.
    assert plan.count("Bucketed: true") == 1
    found = store.write("contracts", content)
    assert store.bucket_count("contracts") == 4
    assert found.filter("title = 'new'").count() == orders.filter("legacy_id % 7 = 0").count()
    assert store.rows("contracts") == orders.count() == found.select("legacy_id").distinct().count()
    # A later session names the folder anew.
    spark.sql(f"DROP TABLE ledgerloom_{store.content().folders('contracts')[0].name.replace('-', '_')}")
    again = TargetStore(spark, str(tmp_path)).read("contracts")
    assert again.count() == orders.count() and "Exchange" not in plan_of(again.groupBy("legacy_id").count())


def test_one_scan_counts_all_dimensions(written, no_broadcast):
    """AGG16: no expansion per distinct count, hash aggregates only, one scan."""
    plan = plan_of(scope.scope_counts(written))
    assert plan.count("FileScan") == 1 and "Expand" not in plan
    assert "SortAggregate" not in plan and "partial_bit_or" in plan


@pytest.mark.parametrize(
    ("name", "most"),
    [("contract_scenario_stores", 9), ("contract_scenarios_brands", 6), ("contract_scenarios", 3),
     ("contract_additional_charges", 3)],
)
def test_ids_are_computed_not_joined(spark, name, most):
    """Ids of other tables are hashes of natural keys, so the lines behind those tables stay unread."""
    plan = plan_of(spark_entry.queries()[name](spark, SF))
    assert plan.count("lineitem.parquet") <= most


def test_staged_rows_leave_no_shuffle_files(spark, tmp_path):
    """The disk holds the shuffles of one step of a query, not of all steps before."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {str(b) for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllBlocks())}

    before = shuffled()
    counts = spark.range(1_000).groupBy((F.col("id") % 70).alias("k")).agg(F.max("id").alias("most"))
    found = session.staged(counts, str(tmp_path / "counts"))
    assert shuffled() <= before
    assert {(r.k, r.most) for r in found.collect()} == {(k, max(range(k, 1_000, 70))) for k in range(70)}
    # Of the lines only the flags are still to be read.
    plan = plan_of(spark_entry.queries()["contract_scenario_stores"](spark, SF))
    assert plan.count("lineitem.parquet") == 1 and plan.count("orders.parquet") == 0


def test_scenario_keys_move_no_other_columns(spark, tables, no_broadcast):
    """The key map of slim scenarios is that of whole ones, also with empty and repeated values."""
    day = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    pick = lambda n, *values: F.element_at(F.array(*map(F.lit, values)), (F.hash("id", F.lit(n)) % len(values) + len(values)) % len(values) + 1)
    lines = spark.range(4_000).select(
        (F.col("id") % 40).alias("contract_id"), pick(1, None, 1, 2).cast("bigint").alias("customer_id"),
        pick(2, None, "x", "1", "1.0", "2").alias("frequency"), pick(3, None, "8", "8,0", "n/d").alias("hours"),
        pick(4, None, "0", "10", "20").cast("decimal(18,2)").alias("price"),
        pick(5, None, " ", "Estoque", "Validade").alias("task_name"), pick(6, None, "a", "b").alias("customer_name"),
        pick(7, None, 6, 7).cast("int").alias("status"), pick(8, None, 1, 2).cast("bigint").alias("task_id"),
        day.alias("start_at"), day.alias("notice_at"), day.alias("line_created_at"), day.alias("line_updated_at"),
    )
    billed = spark.range(30).selectExpr(
        "id AS contract_legacy_id", "cast(id AS string) AS contract_id", "cast(id AS string) AS billing_id"
    )
    params = scope.ScopeParams()
    whole = contracts.scenario_key_map(contracts.keyed_scenarios(lines, billed, params, "2024-01-01 00:00:00"))
    slim = contracts.scenario_key_map(contracts.billed_scenarios(lines, billed, params, columns=[]))
    expected = sorted(map(tuple, whole.collect()), key=repr)
    assert len(expected) > 100 and sorted(map(tuple, slim.collect()), key=repr) == expected
    # What only the scenario table has is no part of the rows that are ranked, and ids are made after the join.
    plan = slim._jdf.queryExecution().optimizedPlan().toString()
    assert "max(line_created_at" not in plan and not re.search(r"struct\(task_name, task_name#\d+, ", plan)
    assert "scenario_id" not in plan[plan.index("Join Inner"):]
