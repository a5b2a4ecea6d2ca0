"""Where tables are read from and written to (SRC1, SRC2, SNK1)."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import session
from ledgerloom.sources import schemas

# Fixed value: rows per insert statement of a JDBC write.
INSERT_BATCH_ROWS = 20000

VERSIONS = "_versions"
KEPT_VERSIONS = 2


def read_only(query: str) -> str:
    """SRC1: accept a query only when it reads."""
    first = re.match(r"\s*(\w+)", query)
    if first is None or first.group(1).lower() not in ("select", "with"):
        raise ValueError("only SELECT queries may be sent to a source")
    return query


class JdbcSource:
    """Source tables behind JDBC, read in parallel ranges of a numeric key.

    Bounds and partition count are given by the caller, because a range read needs both; without
    them one task would read the whole table.
    """

    def __init__(
        self,
        spark: SparkSession,
        options: Mapping[str, str],
        ranges: Mapping[str, tuple[str, int, int, int]],
    ):
        self.spark, self.options, self.ranges = spark, dict(options), dict(ranges)

    def table(self, name: str) -> DataFrame:
        source = schemas.SOURCES[name][0]
        key, low, high, partitions = self.ranges[name]
        reader = self.spark.read.format("jdbc").options(
            **self.options,
            dbtable=source,
            partitionColumn=key,
            lowerBound=str(low),
            upperBound=str(high),
            numPartitions=str(partitions),
        )
        return schemas.rename_source(reader.load(), name)

    def query(self, text: str) -> DataFrame:
        """SRC1: a small read-only query, read by one task."""
        return self.spark.read.format("jdbc").options(**self.options, query=read_only(text)).load()


class FrameSource:
    """Source tables handed over as DataFrames that already carry the names used here."""

    def __init__(self, frames: Mapping[str, DataFrame]):
        self.frames = dict(frames)

    def table(self, name: str) -> DataFrame:
        return self.frames[name]


class FileSource:
    """Source tables as files, one folder or file per source table name."""

    def __init__(self, spark: SparkSession, root: str, file_format: str = "parquet"):
        self.spark, self.root, self.file_format = spark, root.rstrip("/"), file_format

    def table(self, name: str) -> DataFrame:
        source = schemas.SOURCES[name][0]
        df = self.spark.read.format(self.file_format).load(f"{self.root}/{source}")
        return schemas.rename_source(df, name)


@dataclass(frozen=True)
class Folder:
    """One folder of rows: its part (None: the table has no parts), its rows, and its buckets if any."""

    name: str
    part: str | None
    rows: int
    buckets: int | None = None


@dataclass(frozen=True)
class Content:
    """What a version of the store holds: the folders of every table, and the steps of each run."""

    version: int = 0
    tables: Mapping[str, tuple[Folder, ...]] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)
    done: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def folders(self, table: str, part: str | None = None) -> tuple[Folder, ...]:
        return tuple(f for f in self.tables.get(table, ()) if part is None or f.part == part)

    def to_json(self) -> str:
        tables = {t: [[f.name, f.part, f.rows, f.buckets] for f in fs] for t, fs in self.tables.items()}
        return json.dumps(
            {"version": self.version, "tables": tables, "schemas": dict(self.schemas), "done": dict(self.done)}
        )

    @staticmethod
    def from_json(text: str) -> Content:
        read = json.loads(text)
        tables = {t: tuple(Folder(*f) for f in fs) for t, fs in read["tables"].items()}
        done = {run: tuple(steps) for run, steps in read["done"].items()}
        return Content(read["version"], tables, read["schemas"], done)


class TargetStore:
    """Target tables as sets of Parquet folders on a shared file system, published in versions.

    A version is one small file that lists the folders of every table. Folders are never changed:

    - ``write`` puts new rows into a new folder that takes the place of the table's folders, or, with
      ``part``, of that part's folders only, so the rows of other parts are neither read nor written;
    - ``append`` adds a folder, so what is written does not grow with the table;
    - inside ``step`` all writes come out with one version, together with the step's name, so a run
      that dies leaves no step half done and goes on at its first unfinished step.

    The version file is put in place by a rename that fails when the file exists, so of two runs that
    publish at once one stops. Tables of ``schemas.BUCKETED`` are bucketed by their key while they are
    one folder, so joins on the key need no shuffle of them. The rows of a folder are counted while it is written. ``clean`` removes
    folders that the last versions do not list; ``compact`` makes one folder of many.

    Without a root the tables live in the shared folder the cluster names. ``namespace`` separates
    environments that hold the same tables.
    """

    def __init__(
        self, spark: SparkSession, root: str | None = None, namespace: str = "", buckets: int | None = None
    ):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        base = (root or f"{session.shared_folder(spark)}/tables").rstrip("/")
        self.root = f"{base}/{namespace}" if namespace else base
        self._pending: Content | None = None

    def _path(self, name: str):
        """A path below the root, and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        found = (re.fullmatch(r"([0-9]+)\.json", n) for n in self._names(VERSIONS))
        return sorted(int(m[1]) for m in found if m)

    def content(self, version: int | None = None) -> Content:
        """A published version, by default what the next read sees: the newest, or the open step's."""
        if version is None:
            if self._pending is not None:
                return self._pending
            known = self.versions()
            if not known:
                return Content()
            version = known[-1]
        path, fs = self._path(f"{VERSIONS}/{version}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Content.from_json(text)

    def _publish(self, content: Content) -> None:
        jvm = self.spark._jvm
        draft, fs = self._path(f"{VERSIONS}/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(content.to_json().encode()))
        finally:
            stream.close()
        final, _ = self._path(f"{VERSIONS}/{content.version}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        rule = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        context.rename(draft, final, self.spark.sparkContext._gateway.new_array(rule, 0))

    def _change(self, **changed) -> None:
        """Note a change in the open step, or publish it at once."""
        now = self.content()
        if self._pending is not None:
            self._pending = replace(now, **changed)
        else:
            self._publish(replace(now, version=now.version + 1, **changed))

    @contextmanager
    def step(self, name: str, run_id: str | None = None) -> Iterator[None]:
        """Publish all writes of a step as one version; with a run id the step counts as done."""
        if self._pending is not None:
            raise ValueError(f"{name} starts inside another step")
        before = self.content()
        self._pending = before
        try:
            yield
            after = self._pending
            if run_id is not None:
                after = replace(after, done={**after.done, run_id: (*after.done.get(run_id, ()), name)})
            if after is not before:
                self._publish(replace(after, version=before.version + 1))
        finally:
            self._pending = None

    def done(self, run_id: str) -> tuple[str, ...]:
        """The steps a run has published."""
        return self.content().done.get(run_id, ())

    def read(self, table: str, part: str | None = None) -> DataFrame | None:
        """The rows of a table or of one of its parts; None when it was never written."""
        content = self.content()
        if table not in content.tables:
            return None
        folders = content.folders(table, part)
        known = content.schemas[table]
        schema = schemas.schema(table) if table in schemas.TARGETS else T.StructType.fromJson(json.loads(known))
        if not folders:
            return self.spark.createDataFrame([], schema)
        if len(folders) == 1 and folders[0].buckets:
            return self._bucketed(table, folders[0], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{table}/{f.name}" for f in folders))

    def rows(self, table: str, part: str | None = None) -> int:
        """The rows of a table, as counted when they were written; starts no job."""
        return sum(f.rows for f in self.content().folders(table, part))

    def _bucketed(self, table: str, folder: Folder, schema: T.StructType) -> DataFrame:
        """A bucketed folder; Spark knows buckets of named tables only, so it is named in the session."""
        name, key = _session_name(folder), schemas.BUCKETED[table]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({schemas.TARGETS[table]}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {folder.buckets} BUCKETS "
            f"LOCATION '{self.root}/{table}/{folder.name}'"
        )
        return self.spark.table(name).select(*schema.names)

    def bucket_count(self, table: str) -> int | None:
        """The buckets of a table that is read as a bucketed one."""
        folders = self.content().folders(table)
        return folders[0].buckets if len(folders) == 1 else None

    def _new_folder(self, table: str, df: DataFrame, part: str | None) -> Folder:
        name, seen = f"d-{uuid.uuid4().hex}", Observation()
        path, key = f"{self.root}/{table}/{name}", schemas.BUCKETED.get(table)
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if key is None:
            counted.write.mode("errorifexists").parquet(path)
            return Folder(name, part, seen.get["rows"])
        folder = Folder(name, part, 0, self.buckets)
        counted.write.bucketBy(self.buckets, key).sortBy(key).option("path", path).saveAsTable(
            _session_name(folder), format="parquet", mode="errorifexists"
        )
        return replace(folder, rows=seen.get["rows"])

    def _put(self, table: str, df: DataFrame, kept: Sequence[Folder], part: str | None) -> DataFrame:
        if kept:
            known = T.StructType.fromJson(json.loads(self.content().schemas[table]))
            if sorted(known.names) != sorted(df.columns) or (
                df.select(*known.names).schema.simpleString() != known.simpleString()
            ):
                raise ValueError(f"{table} has other columns than the rows to add")
        folder = self._new_folder(table, df, part)
        now = self.content()
        # A folder without rows says nothing that the table's name does not.
        folders = (*kept, folder) if folder.rows else tuple(kept)
        self._change(
            tables={**now.tables, table: folders}, schemas={**now.schemas, table: df.schema.json()}
        )
        return self.read(table)

    def write(self, table: str, df: DataFrame, part: str | None = None) -> DataFrame:
        """SNK1: replace a table, or one part of it (LOD4), and return the table as read back."""
        now = self.content().folders(table)
        if part is not None and any(f.part is None for f in now):
            raise ValueError(f"{table} holds rows that belong to no part")
        kept = () if part is None else tuple(f for f in now if f.part != part)
        return self._put(table, df, kept, part)

    def append(self, table: str, df: DataFrame, part: str | None = None) -> DataFrame:
        """LOD6 / LOD7 / LOD9: add rows and return the table as read back; old rows stay as they are."""
        return self._put(table, df, self.content().folders(table), part)

    def compact(self, table: str) -> DataFrame | None:
        """One folder for each part of a table; the only change that rewrites rows it keeps."""
        now = self.content()
        if table not in now.tables:
            return None
        parts = dict.fromkeys(f.part for f in now.folders(table))
        folders = []
        for part in parts:
            old = tuple(f for f in now.folders(table) if f.part == part)
            if len(old) > 1:
                paths = [f"{self.root}/{table}/{f.name}" for f in old]
                rows = self.spark.read.schema(self.read(table).schema).parquet(*paths)
                old = (self._new_folder(table, rows, part),)
            folders += old
        self._change(tables={**now.tables, table: tuple(folders)})
        return self.read(table)

    def clean(self, keep: int = KEPT_VERSIONS) -> int:
        """Remove the folders that none of the last ``keep`` versions lists, and older versions.

        Run it while nothing is written: a folder of an unpublished step is listed nowhere yet.
        """
        known = self.versions()
        kept = {v: self.content(v) for v in known[-keep:]}
        listed = {(t, f.name) for c in kept.values() for t, fs in c.tables.items() for f in fs}
        removed = 0
        for table in self._names(""):
            if table == VERSIONS:
                continue
            for name in self._names(table):
                if (table, name) not in listed:
                    self.spark.sql(f"DROP TABLE IF EXISTS {_session_name(Folder(name, None, 0))}")
                    path, fs = self._path(f"{table}/{name}")
                    removed += fs.delete(path, True)
        for version in known:
            if version not in kept:
                path, fs = self._path(f"{VERSIONS}/{version}.json")
                fs.delete(path, False)
        return removed


def _session_name(folder: Folder) -> str:
    return "ledgerloom_" + folder.name.replace("-", "_")


def append_jdbc(df: DataFrame, options: Mapping[str, str], table: str) -> None:
    """SNK1: batched insert from every partition; a failed batch fails the write."""
    df.write.format("jdbc").mode("append").options(
        **options, dbtable=table, batchsize=str(INSERT_BATCH_ROWS)
    ).save()
