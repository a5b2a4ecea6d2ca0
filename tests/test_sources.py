from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import headers
from ledgerloom.sources import catalog, reports, schemas, sheet
from ledgerloom.sources.catalog import FileSource, JdbcSource, TargetStore


def test_read_only():
    assert catalog.read_only(" select 1")
    assert catalog.read_only("WITH x AS (SELECT 1) SELECT * FROM x")
    for text in ("delete from t", "  UPDATE t SET a = 1", "insert into t", "truncate table t", "", "-- x"):
        with pytest.raises(ValueError):
            catalog.read_only(text)


def test_jdbc_source_reads_in_ranges(spark):
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **options):
            self.seen.update(options)
            return self

        def load(self):
            return spark.createDataFrame([(1, True)], "Id int, Ativo boolean")

    class Session:
        read = Reader()

    source = JdbcSource(Session, {"url": "jdbc:x"}, {"line_flags": ("Id", 1, 1000, 16)})
    assert source.table("line_flags").columns == ["line_id", "active"]
    assert Session.read.seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "OrcamentoLojas", "partitionColumn": "Id",
        "lowerBound": "1", "upperBound": "1000", "numPartitions": "16",
    }
    with pytest.raises(ValueError):
        source.query("drop table x")


def test_file_source_renames(spark, folder):
    spark.createDataFrame([(7, "Chain", 1)], "ID int, Nome string, extra int").write.parquet(
        f"{folder}/Rede"
    )
    assert FileSource(spark, folder).table("chains").columns == ["id", "name"]


def test_conform_adds_missing_columns(spark):
    df = spark.createDataFrame([(1, "n")], "legacy_id int, name string")
    got = schemas.conform(df, "promoter_tasks")
    assert got.schema.simpleString() == schemas.schema("promoter_tasks").simpleString()
    assert got.first()["name"] == "n" and got.first()["task_type"] is None


ROLES = "user_id string, role_id string"


def roles(spark, *ids):
    return spark.createDataFrame([(i, "r") for i in ids], ROLES)


def ids_of(df):
    return sorted(r[0] for r in df.collect())


def files(folder):
    """Data files below a folder, with the time of their last change."""
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    }


def test_target_store_versions(spark, folder):
    store = TargetStore(spark, folder, namespace="test")
    assert store.read("user_roles") is None and store.versions() == [] and store.rows("user_roles") == 0
    assert store.write("user_roles", roles(spark, "u1")).count() == 1
    # The new content is computed from the old one and written next to it.
    assert store.write("user_roles", store.read("user_roles").unionByName(roles(spark, "u2"))).count() == 2
    # A folder that no version lists is not part of the table.
    os.makedirs(f"{store.root}/user_roles/d-lost")
    roles(spark, "u9").write.mode("overwrite").parquet(f"{store.root}/user_roles/d-lost")
    assert ids_of(store.read("user_roles")) == ["u1", "u2"]
    store.write("user_roles", roles(spark, "u1"))
    assert ids_of(store.read("user_roles")) == ["u1"] and store.versions() == [1, 2, 3]
    assert [f.rows for f in store.content(2).folders("user_roles")] == [2]
    # Another session sees the same.
    assert ids_of(TargetStore(spark, folder, "test").read("user_roles")) == ["u1"]
    empty = store.write("user_roles", roles(spark, "u1").limit(0))
    assert empty.count() == 0 and empty.columns == ["user_id", "role_id"] and store.rows("user_roles") == 0


def test_append_writes_new_rows_only(spark, folder):
    store = TargetStore(spark, folder)
    store.write("user_roles", roles(spark, *map(str, range(1000))))
    before = files(folder)
    sizes = []
    for n in range(3):
        old = files(folder)
        assert store.append("user_roles", roles(spark, f"n{n}")).count() == 1001 + n
        new = {f: t for f, t in files(folder).items() if f not in old}
        sizes.append(sum(map(os.path.getsize, new)))
    # The old files are as they were, and later appends write no more than the first one.
    assert {f: t for f, t in files(folder).items() if f in before} == before
    assert max(sizes) <= 2 * min(sizes) and store.rows("user_roles") == 1003
    assert store.append("user_roles", roles(spark).limit(0)).count() == 1003
    assert len(store.content().folders("user_roles")) == 4
    with pytest.raises(ValueError, match="columns"):
        store.append("user_roles", roles(spark, "x").drop("role_id"))
    assert store.compact("user_roles").count() == 1003
    assert [f.rows for f in store.content().folders("user_roles")] == [1003]
    assert store.compact("nothing") is None


def test_one_part_is_replaced_alone(spark, folder):
    store = TargetStore(spark, folder)

    def owned(kind, *ids):
        return spark.createDataFrame([(i, kind) for i in ids], "id int, owner string")

    store.write("notes", owned("Store", 1, 2), part="Store")
    store.write("notes", owned("Customer", 3), part="Customer")
    of_stores = {f.name for f in store.content().folders("notes", "Store")}
    before = files(folder)
    found = store.write("notes", owned("Customer", 4, 5, 6), part="Customer")
    assert sorted(tuple(r) for r in found.collect()) == [
        (1, "Store"), (2, "Store"), (4, "Customer"), (5, "Customer"), (6, "Customer")]
    assert {f.name for f in store.content().folders("notes", "Store")} == of_stores
    assert {f: t for f, t in files(folder).items() if f in before} == before
    # Reading one part lists the files of that part only, and its count starts no job.
    only = store.read("notes", "Store")
    assert all(any(n in f for n in of_stores) for f in only.inputFiles())
    assert store.rows("notes", "Customer") == 3
    store.append("notes", owned("Store", 7), part="Store")
    assert ids_of(store.read("notes", "Store")) == [1, 2, 7]
    assert ids_of(store.compact("notes")) == [1, 2, 4, 5, 6, 7]
    assert {f.part for f in store.content().folders("notes")} == {"Store", "Customer"}
    assert store.write("notes", owned("Store"), part="Store").count() == 3
    store.write("plain", owned("Store", 1))
    with pytest.raises(ValueError, match="no part"):
        store.write("plain", owned("Store", 2), part="Store")


def test_failed_write_leaves_the_table(spark, folder):
    store = TargetStore(spark, folder)
    df = roles(spark, "u1")
    store.write("user_roles", df)
    broken = df.withColumn("role_id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.write("user_roles", broken)
    assert [tuple(r) for r in store.read("user_roles").collect()] == [("u1", "r")]


def test_tables_of_a_step_come_out_together(spark, folder):
    store, other = TargetStore(spark, folder), TargetStore(spark, folder)
    with store.step("both", "run-1"):
        store.write("a", roles(spark, "1"))
        store.append("a", roles(spark, "2"))
        # The step reads what it wrote; nobody else does yet.
        assert ids_of(store.read("a")) == ["1", "2"] and other.read("a") is None
        store.write("b", roles(spark, "3"))
        with pytest.raises(ValueError, match="inside"), store.step("inner"):
            pass
    assert ids_of(other.read("a")) == ["1", "2"] and ids_of(other.read("b")) == ["3"]
    assert other.versions() == [1] and other.done("run-1") == ("both",) and other.done("run-2") == ()
    with pytest.raises(RuntimeError), store.step("lost", "run-1"):
        store.write("a", roles(spark, "9"))
        raise RuntimeError("lost between two writes")
    assert ids_of(store.read("a")) == ["1", "2"] and store.done("run-1") == ("both",)
    with store.step("idle"):
        pass
    assert store.versions() == [1]


def test_two_runs_cannot_publish_the_same_version(spark, folder):
    store, other = TargetStore(spark, folder), TargetStore(spark, folder)
    store.write("a", roles(spark, "1"))
    with pytest.raises(Exception, match="[Ee]xist"), store.step("slow"):
        store.write("a", roles(spark, "2"))
        other.write("b", roles(spark, "3"))
    assert ids_of(store.read("a")) == ["1"] and ids_of(store.read("b")) == ["3"]


def test_clean_keeps_what_the_last_versions_list(spark, folder):
    store = TargetStore(spark, folder)
    for n in range(4):
        store.write("a", roles(spark, str(n)))
    store.write("b", roles(spark, "x"))
    assert len(os.listdir(f"{folder}/a")) == 4
    assert store.clean(keep=2) == 3  # both kept versions list the last folder
    assert len(os.listdir(f"{folder}/a")) == 1 and store.versions() == [4, 5]
    assert ids_of(store.read("a")) == ["3"] and ids_of(store.read("b")) == ["x"]


def test_store_defaults_to_the_shared_folder(spark):
    assert TargetStore(spark).root == spark.conf.get("spark.checkpoint.dir") + "/tables"


SHEET = """"ID
ORÇAMENTO:", Migrar ,Orcamento Ativo,Nome Cliente,Dia Faturamento,"Tipo fat
Descrição",Farmer (Login User)
7,sim,TRUE,First,5,5 weeks,ann
7,nao,TRUE,Second,6,,bob
8,sim,não,Inactive,7,,
x,sim,TRUE,Bad id,7,,
9,true,,No flag,z,4 weeks,#TBD
"""


def test_sheet(spark, folder):
    path = f"{folder}/sheet.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write(SHEET)
    table = sheet.read_sheet(spark, path)
    assert headers.contract_id_column(table) == "id_orçamento"
    got = {r["contract_id"]: r for r in sheet.sheet_terms(table).collect()}
    assert set(got) == {7, 9}
    assert (got[7]["sheet_name"], got[7]["sheet_billing_day"], got[7]["farmer_login"]) == ("First", 5, "ann")
    assert got[7]["sheet_calculation"] == "5 weeks" and got[7]["hunter_login"] is None
    assert got[9]["sheet_billing_day"] is None and got[9]["farmer_login"] is None
    marked = {r["contract_id"] for r in sheet.marked_contracts(table).collect()}
    assert marked == {7, 9}
    assert {r["contract_id"] for r in sheet.marked_contracts(table, False).collect()} == {7, 8, 9}
    with pytest.raises(ValueError):
        sheet.sheet_terms(spark.createDataFrame([(1,)], "other int"))


def test_scope_document(spark, folder):
    store = TargetStore(spark, folder)
    assert reports.load_scope(store) is None
    ids = spark.createDataFrame(
        [("IdCliente", 2), ("IdCliente", 2), ("IdRede", None), ("IdOrcamento", 5)], "dimension string, id int"
    )
    assert reports.save_scope(store, ids).count() == 2
    fresh = spark.createDataFrame([(8,), (9,)], "contract_id int")
    merged = reports.merge_sheet_scope(store, fresh)
    assert sorted(tuple(r) for r in merged.collect()) == [
        ("IdCliente", 2), ("IdOrcamento", 8), ("IdOrcamento", 9)]
    assert reports.merge_sheet_scope(store, fresh, reset_dependent=True).count() == 2


def test_run_history(spark, folder):
    store = TargetStore(spark, folder)
    for n in range(1, 23):
        reports.save_run(store, "t", dt.datetime(2025, 1, n), float(n), {"contracts": n})
    kept = store.read("run_history").collect()
    assert len(kept) == 20 and min(r["run_at"] for r in kept) == dt.datetime(2025, 1, 3)
    assert max(kept, key=lambda r: r["run_at"])["measures"] == {"contracts": 22}


def test_report(spark, folder):
    reports.write_report(spark.createDataFrame([(1, "x")], "k int, field string"), f"{folder}/diff")
    assert spark.read.csv(f"{folder}/diff", header=True).columns == ["k", "field"]
