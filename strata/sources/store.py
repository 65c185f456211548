"""Table store on plain Parquet with an append-only commit log (IO-06..IO-10 sinks).

A table is a folder of immutable versions plus a ``_commits`` dataset.  A load
writes its files under a version folder of its own and commits by appending rows
to the log; nothing committed is ever overwritten, so a job that dies anywhere
leaves the last committed state readable, and a state may be computed from the
one that it replaces.  What has no commit row is not read.

A commit names the folders that it puts in force, the table's layout and its
schema.  A *whole* table's state is one folder.  A table laid out *by partition*
(a load day, or a bucket of the load key) has one folder for each partition
value: the latest version that replaced it.  A read opens exactly the folders in
force with the committed schema, so its cost does not grow with past loads.  An
update in another layout than the committed one is refused; a full load may
change the layout.  One writer at a time is assumed for a table.

Only Spark's reader and writer are used; the root must be a shared folder.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import loads

#: ``full`` marks a version that replaces the whole table.
COMMIT_SCHEMA = ("version int, folder string, layout string, part string, committed_at timestamp_ntz, tag string, "
                 "full boolean, schema string")
WHOLE = "whole"


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


@dataclass
class Snapshot:
    """The committed state of a table: one folder for each partition value in force (None: empty)."""
    version: int
    layout: str
    schema: StructType
    parts: dict[str | None, str | None]


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def commits(self, name: str) -> DataFrame | None:
        path = f"{self._table(name)}/_commits"
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(path) if children(self.spark, path) else None

    def snapshot(self, name: str) -> Snapshot | None:
        """Version, layout, schema and folders in one job; one row for each partition value reaches the driver."""
        log = self.commits(name)
        if log is None:
            return None
        order = F.struct("version", "committed_at", "folder")
        rows = log.groupBy("part").agg(
            F.max_by(F.struct("version", "layout", "schema", "folder", "committed_at"), order).alias("last"),
            F.max(F.when(F.col("full"), F.col("version"))).alias("full")).collect()
        if not rows:
            return None
        start = max(r["full"] for r in rows if r["full"] is not None)
        last = max((r["last"] for r in rows), key=lambda x: (x["version"], x["committed_at"]))
        parts = {r["part"]: r["last"]["folder"] for r in rows if r["last"]["version"] >= start}
        return Snapshot(last["version"], last["layout"], StructType.fromJson(json.loads(last["schema"])), parts)

    def version(self, name: str) -> int | None:
        """Latest committed version number."""
        state = self.snapshot(name)
        return None if state is None else state.version

    def rows(self, name: str, state: Snapshot, folders: list[str]) -> DataFrame:
        """The rows of these folders, with the committed schema."""
        if not folders:
            return self.spark.createDataFrame([], state.schema)
        return self.spark.read.schema(state.schema).parquet(*[f"{self._table(name)}/{f}" for f in folders])

    def read(self, name: str) -> DataFrame | None:
        state = self.snapshot(name)
        return None if state is None else self.rows(name, state, sorted(f for f in state.parts.values() if f))

    def has_tag(self, name: str, tag: str) -> bool:
        """Whether a version carrying ``tag`` (e.g. a stream epoch) is committed."""
        log = self.commits(name)
        return log is not None and not log.filter(F.col("tag") == tag).isEmpty()

    def commit(self, name: str, version: int, parts: dict, layout: str, schema: StructType, full: bool,
               tag: str | None = None) -> int:
        rows = [(version, folder, layout, part, _now(), tag, full, schema.json()) for part, folder in parts.items()]
        self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{self._table(name)}/_commits")
        return version

    @staticmethod
    def next_folder(state: Snapshot | None) -> tuple[int, str]:
        v = 0 if state is None else state.version + 1
        return v, f"v={v:06d}-{uuid.uuid4().hex[:12]}"

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written beside the table and read back: looked at as often as needed, computed once."""
        path = f"{self._table(name)}/_staged/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read_placed(self, name: str, column: str = "place") -> DataFrame | None:
        """A whole table with each row's place, from 1, in the order that its writer gave it.

        The files of a sorted write are numbered by range, so a row's place is
        its place in its file behind the rows of the files before.
        """
        df = self.read(name)
        if df is None:
            return None
        df = df.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        counts = sorted(map(tuple, df.groupBy("_file").count().collect()))  # one row for each file
        starts, total = [], 0
        for file, n in counts:
            starts.append((file, total))
            total += n
        first = F.broadcast(self.spark.createDataFrame(starts, "_file string, _first long"))
        return df.join(first, "_file").withColumn(column, F.col("_first") + F.col("_row") + 1).drop(
            "_file", "_row", "_first")

    def write(self, name: str, df: DataFrame, tag: str | None = None, sort_within: list[str] | None = None) -> int:
        """Write ``df`` as the next version of the whole table and commit it (optionally tagged).

        ``sort_within``: order rows by the load key inside each file (SL-05),
        which keeps files clustered for readers; no global sort.  The order of a
        sorted ``df`` survives in the files (``read_placed``).
        """
        v, folder = self.next_folder(self.snapshot(name))
        (df.sortWithinPartitions(*sort_within) if sort_within else df).write.parquet(f"{self._table(name)}/{folder}")
        return self.commit(name, v, {None: folder}, WHOLE, df.schema, True, tag)

    # --- append-only rows (audit logs): generations, so that compaction never replaces what is read

    def _generations(self, name: str) -> list[tuple[int, list[str]]]:
        """Generations of an append-only dataset, each with the files of the one before that it took over."""
        path = f"{self._table(name)}/_generation"
        if not children(self.spark, path):
            return [(0, [])]
        rows = self.spark.read.schema("g int, taken array<string>").parquet(path).orderBy("g").collect()
        return [(0, [])] + [(r["g"], r["taken"]) for r in rows]

    def _row_files(self, name: str) -> list[str]:
        """Files in force: those of every generation that the next one has not taken over."""
        known, out = self._generations(name), []
        for i, (g, _) in enumerate(known):
            taken = set(known[i + 1][1]) if i + 1 < len(known) else set()
            folder = f"{self._table(name)}/g={g:06d}"
            out += [f"{folder}/{f}" for f in children(self.spark, folder) if f[0] not in "_." and f not in taken]
        return out

    def append_rows(self, name: str, df: DataFrame) -> None:
        """Append to an append-only dataset (audit logs)."""
        df.write.mode("append").parquet(f"{self._table(name)}/g={self._generations(name)[-1][0]:06d}")

    def compact_rows(self, name: str, files: int = 8) -> None:
        """Rewrite an append-only dataset (audit log) into ``files`` files.

        Every run appends small files; reading thousands of them slows each
        watermark lookup.  The new generation names the files that it took over,
        so rows appended meanwhile, to either generation, stay in force.
        """
        found = self._row_files(name)
        if not found:
            return
        g = self._generations(name)[-1][0] + 1
        self.spark.read.parquet(*found).repartition(files).write.parquet(f"{self._table(name)}/g={g:06d}")
        taken = [f.rsplit("/", 1)[1] for f in found]
        self.spark.createDataFrame([(g, taken)], "g int, taken array<string>").write.mode("append").parquet(
            f"{self._table(name)}/_generation")

    def read_rows(self, name: str) -> DataFrame | None:
        found = self._row_files(name)
        return self.spark.read.parquet(*found) if found else None


class PartitionedTable:
    """A table kept by partition, updated partition by partition.

    ``column`` is a column of the rows (a load day), or a bucket of the load key
    in a number of ``buckets``.  Every update writes the incoming rows once, then
    adds the kept rows of the partitions that those touch; all other partitions
    stay as written.  The driver holds one entry for each partition value.
    """

    def __init__(self, spark: SparkSession, path: str, column: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        root, _, self.name = self.path.rpartition("/")
        self.store = TableStore(spark, root)
        self.column = column
        self.layout = column if buckets is None else f"{column}/{buckets}"

    def read(self) -> DataFrame | None:
        return self.store.read(self.name)

    def _part(self) -> Column:
        return F.concat(F.lit("p"), F.coalesce(F.col(self.column).cast("string"), F.lit("")))

    def _write(self, df: DataFrame, folder: str) -> None:
        (df.withColumn("_part", self._part()).write.mode("append").option("partitionOverwriteMode", "static")
         .partitionBy("_part").parquet(f"{self.path}/{folder}"))

    def _written(self, folder: str) -> dict[str, str]:
        """Partition value -> folder of what a version holds so far."""
        names = [n for n in children(self.spark, f"{self.path}/{folder}") if n.startswith("_part=")]
        return {unquote(n[len("_part="):]): f"{folder}/{n}" for n in names}

    def _state(self) -> Snapshot | None:
        state = self.store.snapshot(self.name)
        if state is not None and state.layout != self.layout:
            raise ValueError(f"{self.name} is laid out by {state.layout}, not by {self.layout}: "
                             "a full load changes the layout, an update does not")
        return state

    def replace_all(self, df: DataFrame, tag: str | None = None) -> int:
        """Replace the whole table (full load), whatever its layout was."""
        version, folder = self.store.next_folder(self.store.snapshot(self.name))
        self._write(df, folder)
        parts = self._written(folder) or {"p": None}
        return self.store.commit(self.name, version, parts, self.layout, df.schema, True, tag)

    def _replace(self, incoming: DataFrame, lost: Column | None, keys: list[str] | None, tag: str | None) -> int:
        state = self._state()
        if state is None:
            return self.replace_all(incoming, tag)
        schema = merged_schema(state.schema, incoming.schema)
        version, folder = self.store.next_folder(state)
        self._write(incoming, folder)
        new = self._written(folder)
        touched = set(new)
        if lost is not None:
            mine = self.store.rows(self.name, state, sorted(f for f in state.parts.values() if f))
            touched |= {r[0] for r in mine.filter(lost).select(self._part()).distinct().collect()}
        held = sorted(state.parts[p] for p in touched if state.parts.get(p))
        if held:
            mine = self.store.rows(self.name, state, held)
            if lost is not None:
                kept = mine.filter(~lost)
            else:
                fresh = self.spark.read.schema(incoming.schema).parquet(*[f"{self.path}/{f}" for f in new.values()])
                fresh = fresh.select(*keys)
                kept = mine.join(fresh, [mine[k].eqNullSafe(fresh[k]) for k in keys], "left_anti")
            self._write(kept, folder)
        now = self._written(folder)
        parts = {p: now.get(p) for p in touched}
        # A delivery that touches nothing still makes a version: an empty partition of its own.
        return self.store.commit(self.name, version, parts or {"p": state.parts.get("p")}, self.layout, schema, False, tag)

    def replace_window(self, incoming: DataFrame, window: Column | None, scope: Column | None = None,
                       tag: str | None = None) -> int:
        """Idempotent window append (IO-08): rows inside the window (and scope) give way to ``incoming``."""
        if window is None and scope is None:
            return self.replace_all(incoming, tag)
        lost = F.lit(True)
        for part in (window, scope):
            if part is not None:
                lost = lost & F.coalesce(part, F.lit(False))
        return self._replace(incoming, lost, None, tag)

    def upsert(self, incoming: DataFrame, keys: list[str], order_by: list[str] | None = None,
               tag: str | None = None) -> int:
        """Upsert (IO-10) into a table whose partition column is a function of the keys (see ``bucketed``)."""
        if not keys:
            raise ValueError("an upsert needs a load key")
        return self._replace(loads.latest_per_key(incoming, keys, order_by or []), None, keys, tag)


def merged_schema(old: StructType, new: StructType) -> StructType:
    """Old columns, then those that the new rows add; a column never changes its type."""
    types = {f.name: f.dataType for f in old.fields}
    changed = [f.name for f in new.fields if f.name in types and types[f.name] != f.dataType]
    if changed:
        raise ValueError(f"columns of another type than the table's: {changed}")
    return StructType(old.fields + [f for f in new.fields if f.name not in types])


BUCKET_COLUMN = "load_bucket"


def bucketed(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """``df`` with a bucket of its load key: a delivery touches only the buckets of its keys."""
    return df.withColumn(BUCKET_COLUMN, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
