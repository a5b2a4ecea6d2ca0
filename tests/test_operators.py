from __future__ import annotations

import datetime as dt
import random
import re
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from ledgerloom.functions import text
from ledgerloom.operators import golden, load, match, quality, reshape, rollup, scope
from ledgerloom.operators.scope import ScopeParams


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n):
    return dt.datetime(2025, 1, n)


@pytest.fixture(scope="module")
def dated(spark):
    data = [
        (1, None, day(5), 6),
        (2, day(10), day(5), 6),
        (3, dt.datetime(2025, 1, 10, 23, 59), dt.datetime(2025, 1, 20, 23, 59), 6),
        (4, day(9), day(5), 6),
        (5, day(10), None, 6),
        (6, day(10), day(21), 6),
        (7, day(10), day(5), 9),
    ]
    return spark.createDataFrame(
        data, "contract_id bigint, notice_at timestamp_ntz, start_at timestamp_ntz, status int"
    )


def test_scope_bounds(spark, dated):
    params = ScopeParams(notice_min="2025-01-10", start_max="2025-01-20", statuses=(6, 7))
    assert params.is_restricted and not ScopeParams().is_restricted
    found = scope.in_scope(dated, params)
    assert [r["contract_id"] for r in found.orderBy("contract_id").collect()] == [1, 2, 3]
    some = params.with_ids(scope.id_table(spark, [2, 3, 99]))
    assert scope.in_scope(dated, some).count() == 2
    assert scope.in_scope(dated, ScopeParams()).count() == 7


def test_scope_filters_reach_the_scan(spark, dated, folder):
    dated.write.parquet(f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    params = ScopeParams(notice_min="2025-01-10", start_max="2025-01-20", statuses=(6,))
    plan = scope.in_scope(lines, params).select("contract_id")._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "LessThan(start_at" in pushed and "EqualTo(status,6)" in pushed
    assert "IsNull(notice_at)" in pushed


def test_first_per_key_with_hot_key(spark):
    random.seed(3)
    data = [(1 if random.random() < 0.5 else random.randrange(50), random.randrange(9), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, o int, v int")
    best = {}
    for k, o, v in data:
        best[k] = min(best.get(k, (o, v)), (o, v))
    assert rows(match.first_per_key(df, ["k"], ["o"])) == sorted(
        ((k, o, v) for k, (o, v) in best.items()), key=repr
    )
    plan = match.first_per_key(df, ["k"], ["o"])._jdf.queryExecution().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_first_per_key_of_some_columns(spark):
    """The columns asked for are those of the whole first row, and no others are moved."""
    random.seed(4)
    data = [tuple(random.choice([None, *range(4)]) for _ in range(5)) for _ in range(2_000)]
    df = spark.createDataFrame(data, "k int, a int, b int, c int, d int")
    for order in ([], ["c"]):
        for columns in ([], ["a"], ["b"], ["d", "a"], ["a", "b", "c", "d"]):
            some = match.first_per_key(df, ["k"], order, columns)
            kept = [c for c in df.columns if c == "k" or c in columns]
            assert some.columns == kept
            assert rows(some) == rows(match.first_per_key(df, ["k"], order).select(*kept))
    plan = match.first_per_key(df.select("k", "a", "b"), ["k"], [], ["a"])._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"named_struct\([^)]*\bb\b", plan)


def test_first_per_key_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "c")], "k int, o int, v string")
    got = match.first_per_key(df, ["k"], list(match.nulls_last("o")))
    assert rows(got) == [(1, 5, "b"), (2, None, "c")]


def test_lookups_keep_null_keys(spark):
    left = spark.createDataFrame([(None, i) for i in range(500)] + [(1, 1000), (2, 1001)], "k int, v int")
    right = spark.createDataFrame([(1, "one"), (None, "none")], "k int, n string")
    found = match.left_lookup(left, right, ["k"])
    assert found.count() == 502 and found.filter("n IS NOT NULL").count() == 1
    assert match.without(left, right, ["k"]).count() == 501
    assert rows(match.within(left, right, ["k"])) == [(1, 1000)]
    # Null keys do not all go to one partition of the shuffle.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = match.left_lookup(left, right, ["k"]).withColumn("p", F.spark_partition_id())
        assert spread.select("p").distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_key_maps(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "legacy_id int, id string")
    lines = spark.createDataFrame([(1,), (2,), (2,), (3,)], "store int")
    keys = match.key_map(target)
    assert rows(match.map_key(lines, keys, "store", "store_id")) == [(1, "a"), (3, "c")]
    assert rows(match.unmapped(lines, keys, "store", "missing store")) == [("missing store", "2")]
    arrays = spark.createDataFrame([("g", [1, 2]), ("h", [3])], "id string, legacy_ids array<int>")
    assert rows(match.array_key_map(arrays)) == [(1, "g"), (2, "g"), (3, "h")]


def test_place_lookup(spark):
    places = spark.createDataFrame(
        [("3550308", "São Paulo", "SP"), ("99", "SAO PAULO", "sp"), ("0", "Nada", "SP"), ("12", "", "SP")],
        "code string, city string, state string",
    )
    data = [
        (1, "SP", "sao paulo!", None), (2, "SP", "SÃO  PAULO", "77-1"), (3, "SP", "Sao Paulo", "0"),
        (4, "RJ", "São Paulo", None), (5, None, "São Paulo", None), (6, "SP", "Nada", None),
    ]
    df = spark.createDataFrame(data, "i int, uf string, city string, own string")
    got = match.add_place_code(df, places, "uf", "city", "own", "code").select("i", "code")
    assert rows(got) == [(1, 99), (2, 771), (3, 99), (4, 0), (5, 0), (6, 0)]


def test_person_lookup(spark):
    users = spark.createDataFrame(
        [("u1", 1, "Ann", "ANN", None), ("u2", 2, "bob", "BOB", "ann"), ("u3", 3, None, None, None)],
        "id string, legacy_id int, user_name string, normalized_user_name string, email string",
    )
    source = spark.createDataFrame(
        [(1, "075.998.868-42"), (2, "7599886842"), (3, "12345678901"), (9, "55555555555")],
        "id int, national_id string",
    )
    cells = [(1, " ANN "), (2, "7599886842"), (3, "123.456.789-01"), (4, "12345"), (5, None), (6, "x"), (7, "")]
    df = spark.createDataFrame(cells, "i int, login string")
    got = match.add_user_by_login(
        df, "login", "user", match.login_keys(users), match.national_id_keys(source, users)
    ).select("i", "user")
    assert rows(got) == [(1, "u1"), (2, "u1"), (3, "u3"), (4, None), (5, None), (6, None), (7, None)]


def test_scope_sets(spark):
    sheet = spark.createDataFrame([(1,), (2,), (2,)], "contract_id bigint")
    asked = spark.createDataFrame([(2,), (3,)], "contract_id bigint")
    empty = asked.filter("contract_id > 9")
    assert rows(scope.intersect_sheet(asked, sheet)) == [(2,)]
    assert rows(scope.intersect_sheet(None, sheet)) == [(1,), (2,)]
    assert rows(scope.precedence([empty, asked, sheet], "contract_id")) == [(2,), (3,)]
    assert rows(scope.first_source([empty, asked.drop("contract_id"), sheet], "contract_id")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        scope.require_rows(scope.intersect_sheet(empty, sheet), "empty scope")
    with pytest.raises(ValueError):
        scope.first_source([sheet], "other")
    saved = spark.createDataFrame([("IdOrcamento", 9), ("IdCliente", 4)], "dimension string, id bigint")
    assert rows(scope.merge_scope(saved, sheet)) == [("IdCliente", 4), ("IdOrcamento", 1), ("IdOrcamento", 2)]
    assert rows(scope.merge_scope(saved, sheet, True)) == [("IdOrcamento", 1), ("IdOrcamento", 2)]


MERGED = ("tax_id", "legal_name", "trade_name")


def _records(spark, data):
    return spark.createDataFrame(
        data, "record_id bigint, code bigint, tax_id string, legal_name string, trade_name string"
    )


def test_golden_merge(spark):
    shared, zero = "12345678000195", text.DEFAULT_TAX_ID
    records = _records(
        spark,
        [
            (5, 50, shared, "Five", None), (3, 30, shared, "Three", "  "), (9, 90, shared, "Nine", "T9"),
            (1, 10, zero, "One", None), (2, 20, zero, "Two", None), (4, 40, "12345678901", "Four", None),
            (6, 60, "12345678901", "Six", None),
        ],
    )
    merged = golden.with_unique_tax_id(golden.merge_records(records, MERGED))
    got = {r["record_id"]: r for r in merged.collect()}
    assert set(got) == {3, 1, 2, 4, 6}
    assert (got[3]["legal_name"], got[3]["trade_name"], got[3]["code"], got[3]["id_count"]) == ("Three", "T9", 30, 3)
    assert got[1]["trade_name"] is None and got[1]["tax_id_status"] == "invalid"
    assert got[1]["tax_id"] != got[2]["tax_id"] and got[1]["tax_id"].startswith("9")
    assert got[4]["tax_id_status"] == "valid" and got[4]["tax_id"] == "12345678901"
    keys = golden.merged_ids(records)
    assert keys.count() == 7 and keys.select("id").distinct().count() == 5
    with_id = merged.withColumn("id", golden.golden_id(F.col("merge_key")))
    assert rows(golden.totals(with_id, keys)) == [(5, 7, 2)]
    assert golden.broken_groups(with_id, keys).count() == 0
    with pytest.raises(ValueError):
        golden.require_ids(with_id, keys.filter("legacy_id <> 1"))


def test_large_group_is_read_like_any_other(spark):
    """A group of 150 000 ids keeps them all, in arrays of bounded size."""
    ids = spark.range(150_001).select(F.col("id").alias("legacy_id"))
    keys = ids.withColumn("id", F.when(F.col("legacy_id") < 150_000, "big").otherwise("small"))
    golden_rows = keys.select("id").distinct()
    chunks = golden.chunked_ids(keys)
    assert chunks.agg(F.max(F.size("legacy_ids"))).first()[0] == golden.CHUNK_IDS
    assert rows(rollup.array_totals(golden_rows, chunks, "legacy_ids")) == [(2, 150_001, 149_999)]
    assert match.array_key_map(chunks).distinct().count() == 150_001
    one = spark.createDataFrame([(77_777,)], "i bigint")
    assert rows(load.replace_by_array_key(golden_rows, golden_rows.limit(0), keys, one)) == [("small",)]


def test_golden_merge_against_brute_force(spark):
    random.seed(11)
    names = [None, "", " ", "A", "B", "C"]
    hot = "99999999000199"
    data = [
        (i, i * 10, hot if random.random() < 0.4 else f"{random.randrange(1, 40):014d}",
         random.choice(names), random.choice(names))
        for i in random.sample(range(10000), 800)
    ]
    groups = defaultdict(list)
    for r in sorted(data):
        groups[r[2]].append(r)

    def filled(values):
        return next((v for v in values if v is not None and v.strip()), None)

    want = {
        k: (g[0][0], g[0][1], len(g), filled(r[3] for r in g), filled(r[4] for r in g))
        for k, g in groups.items()
    }
    got = {
        r["tax_id"]: (r["record_id"], r["code"], r["id_count"], r["legal_name"], r["trade_name"])
        for r in golden.merge_records(_records(spark, data), MERGED).collect()
    }
    assert got == want
    chunks = golden.chunked_ids(golden.merged_ids(_records(spark, data)), width=500).collect()
    assert max(len(c["legacy_ids"]) for c in chunks) <= 500
    assert sorted(i for c in chunks for i in c["legacy_ids"]) == sorted(r[0] for r in data)


CHARGES = (
    "contract_id int, equipment_amount decimal(18,2), trade_amount decimal(18,2), "
    "other_amount decimal(18,2), interest_amount decimal(18,2), discount_amount decimal(18,2), "
    "fine_amount decimal(18,2), equipment_charged boolean, equipment_start_at timestamp_ntz, "
    "created_at timestamp_ntz, updated_at timestamp_ntz"
)


def test_charges(spark):
    amount, none = Decimal("5.00"), None
    data = []
    for i in range(6):
        amounts = [none] * 6
        amounts[i] = amount
        data.append((i + 1, *amounts, False, day(9), day(1), None))
    data.append((7, *[none] * 6, True, None, None, day(2)))
    data.append((8, *[Decimal("0.00")] * 6, False, None, day(1), None))
    data.append((9, *[Decimal("-1.00")] * 6, None, None, None, None))
    df = spark.createDataFrame(data, CHARGES)
    got = rows(reshape.charge_rows(df, ["contract_id"], "2025-06-01 00:00:00").select(
        "contract_id", "position", "amount", "start_date"))
    assert got == [
        (1, 1, amount, dt.date(2025, 1, 9)),
        *[(i, i, amount, dt.date(2025, 1, 1)) for i in range(2, 7)],
        (7, 1, Decimal("0.00"), dt.date(2025, 1, 2)),
    ]
    assert rows(rollup.count_charges(df)) == [(7,)]
    kept = df.filter(reshape.any_positive(reshape.CHARGE_AMOUNTS, F.col("equipment_charged")))
    assert kept.count() == 7


def test_sellers(spark):
    df = spark.createDataFrame([(1, "f", "h"), (2, "f", None), (3, None, "h"), (4, None, None)], "c int, f string, h string")
    got = rows(reshape.seller_rows(df, ["c"], "f", "h", F.lit("admin")))
    assert got == [
        (1, "farmer", "f"), (1, "hunter", "h"), (2, "farmer", "f"), (2, "hunter", "f"),
        (3, "farmer", "h"), (3, "hunter", "h"), (4, "farmer", "admin"), (4, "hunter", "admin"),
    ]
    none = F.lit(None).cast("string")
    assert reshape.seller_rows(df, ["c"], "f", "h", none).count() == 6
    assert rows(reshape.sellers_missing(df, "f", "h", none).select("c")) == [(4,)]


def test_names_and_contacts(spark):
    df = spark.createDataFrame(
        [(1, " A ", "B"), (2, "A", "A"), (3, "A", None), (4, " ", "B"), (5, None, "B")], "i int, n string, s string")
    assert rows(reshape.name_rows(df, ["i"], "n", "s")) == [(1, "A"), (1, "B"), (2, "A"), (3, "A")]
    people = spark.createDataFrame(
        [(1, " X@Y ", "(1) 2", "n/a"), (2, " ", None, "9")], "i int, email string, phone string, cellphone string")
    assert rows(reshape.contact_rows(people, ["i"])) == [
        (1, "email", "x@y"), (1, "phone", "12"), (2, "cellphone", "9")]


@pytest.fixture(scope="module")
def old_new(spark):
    old = spark.createDataFrame([(1, 7, "old"), (2, 7, "old"), (None, 8, "old")], "k int, parent int, v string")
    new = spark.createDataFrame([(2, 7, "new"), (3, 9, "new")], "k int, parent int, v string")
    return old, new


def test_load_modes(spark, old_new):
    old, new = old_new
    assert rows(load.replace_by_key(old, new, new, ["k"])) == [
        (1, 7, "old"), (2, 7, "new"), (3, 9, "new"), (None, 8, "old")]
    assert rows(load.append_new(old, new, ["k"])) == [
        (1, 7, "old"), (2, 7, "old"), (3, 9, "new"), (None, 8, "old")]
    assert rows(load.replace_by_key(old, new, new, ["parent"])) == [
        (2, 7, "new"), (3, 9, "new"), (None, 8, "old")]
    assert rows(load.replace_by_type(old, new, "parent", 7)) == [
        (2, 7, "new"), (3, 9, "new"), (None, 8, "old")]
    groups = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    key_rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "legacy_id int, id string")
    ids = spark.createDataFrame([(2,), (9,)], "i int")
    fresh = spark.createDataFrame([("z",)], "id string")
    assert rows(load.replace_by_array_key(groups, fresh, key_rows, ids)) == [("b",), ("c",), ("z",)]
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert rows(load.insert_ignore(pairs.limit(1), pairs, ["a", "b"])) == [(1, 1), (1, 2)]


def test_load_is_idempotent(old_new):
    old, new = old_new
    once = load.replace_by_key(old, new, new, ["k"])
    assert rows(load.replace_by_key(once, new, new, ["k"])) == rows(once)
    added = load.append_new(old, new, ["k"])
    assert rows(load.append_new(added, new, ["k"])) == rows(added)


def test_load_policy():
    usual, by_ids = load.LoadPolicy(), load.LoadPolicy(keep_without_ids=False)
    assert load.LoadPolicy(clear=True).mode(True, True) == "replace_all"
    assert [usual.mode(r, i) for r, i in ((True, True), (False, True), (False, False), (True, False))] == [
        "replace_by_key", "replace_all", "replace_all", "append"]
    assert [by_ids.mode(False, True), by_ids.mode(True, False)] == ["replace_by_key", "replace_all"]


def test_quality(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", "q"), (3, "z", "r")], "k int, f string, g string")
    b = spark.createDataFrame([(1, "X", None), (2, "y", None), (4, "w", "s")], "k int, f string, g string")
    fields = {"f": F.lower("f"), "g": F.col("g")}
    assert rows(quality.field_diff(a, b, ["k"], fields)) == [(2, "g", "q", None)]
    assert rows(quality.set_difference(a, b, "k")) == [(3, "missing"), (4, "extra")]
    got = rows(quality.reconcile({"s": (quality.count_rows(a), quality.count_rows(b.limit(2)))}))
    assert got == [("s", 3, 2, 1, False)]
    errors = spark.createDataFrame([("no store: 1",), ("no store: 2",), ("other",)], "m string")
    assert rows(quality.error_types(errors, "m")) == [("no store", 2), ("other", 1)]
    quality.require_mapped(a.select("f").limit(0), "names")
    with pytest.raises(ValueError, match="'x', 'y'"):
        quality.require_mapped(a.select("f"), "names", shown=2)


def test_column_profile(spark):
    df = spark.createDataFrame([(1, -0.0, None), (2, 0.0, "b"), (2, 1.5, "a")], "i int, d double, s string")
    got = {(r["column"], r["metric"]): r["value"] for r in quality.column_profile(df).collect()}
    assert got[("i", "distinct")] == "2" and got[("d", "distinct")] == "2"
    assert (got[("s", "non_null")], got[("s", "min")], got[("s", "max")]) == ("2", "a", "b")
    empty = {(r["column"], r["metric"]): r["value"] for r in quality.column_profile(df.limit(0)).collect()}
    assert empty[("i", "rows")] == "0" and empty[("i", "distinct")] == "0" and empty[("i", "min")] is None


def test_required_check(spark):
    df = spark.createDataFrame([("1", None), ("x", "2024-01-01"), (None, "bad")], "n string, d string")
    got = rows(quality.required_check(df, {"n": "int", "d": "date", "z": "int"}))
    assert got == [("d", "date", True, 1, 1), ("n", "int", True, 1, 1), ("z", "int", False, 3, 0)]


def test_near_matches_keep_ten_per_key(spark):
    data = [(1, i, "1", day(3)) for i in range(25)] + [(2, 100, "1", day(3)), (1, 200, "2", day(3))]
    lines = spark.createDataFrame(data, "contract_id int, line_id int, frequency string, start_at timestamp_ntz")
    wanted = spark.createDataFrame([(1, "1", dt.date(2025, 1, 3))], "contract_id int, frequency string, start_day date")
    got = scope.near_matches(lines, wanted)
    assert [r["line_id"] for r in got.orderBy("line_id").collect()] == list(range(10))
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()


def test_shuffles_begin_with_more_partitions_on_larger_tables(spark, folder):
    """What one task sorts and groups does not grow with the tables under the session's few partitions."""
    query = spark_entry._configured(
        lambda s, _: match.first_per_key(s.range(1_000).selectExpr("id % 70 AS k", "id", "id % 3 AS v"), ["k"], ["id"])
    )
    try:
        for size, partitions in ((0, 8), (100 << 20, 100)):
            with open(f"{folder}/table", "wb") as f:
                f.truncate(size)
            first = query(spark, folder)
            plan = first._jdf.queryExecution().executedPlan().toString()
            assert re.search(rf"hashpartitioning\(k#\d+L, {partitions}\)", plan)
            assert rows(first) == sorted(((k, k, k % 3) for k in range(70)), key=repr)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
