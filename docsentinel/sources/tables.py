"""Parquet tables on the shared filesystem: versioned folders, partitioned upserts.

Paths may be any Hadoop-supported URI (``file:``, ``hdfs:``, object stores);
filesystem calls go through the JVM's Hadoop ``FileSystem``, as PySpark jobs
usually do for existence checks and deletes.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsentinel.operators.incremental import delete_insert, evolve_columns
from docsentinel.session import work_path

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_COMMIT = "commit_id"
_CLEAN_EVERY = 16
#: A partition of so many folders is put together by the next write to it.
_MOST_FOLDERS = 8


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole: under another name first, then renamed."""
    fs, target = _fs_path(spark, path)
    _, fresh = _fs_path(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(fresh, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(fresh, target):
        fs.delete(fresh, False)
        raise RuntimeError(f"{path} could not be written")


#: File systems whose rename fails if the target exists; others cannot hold a versioned table.
_EXCLUSIVE_RENAME = ("file", "hdfs", "viewfs", "ofs", "abfs", "abfss")


#: Takes the rows that are about to be written and the version they are made from; gives them back to be written.
Watch = Callable[[DataFrame, "int | None"], DataFrame]


def _listed(held: str | list[str]) -> list[str]:
    """The folders of a partition, of which a manifest names one as text."""
    return [held] if isinstance(held, str) else held


def _name(value) -> str:
    """A partition value as manifests name it."""
    return NULL_PARTITION if value is None else str(value)


class ConcurrentWrite(RuntimeError):
    """Another job published a version after the one this change was made from."""


@dataclass(frozen=True)
class Change:
    """A staged write: it may become the version after ``based_on`` and no other."""

    based_on: int
    folder: str | None  # None: partitions only go
    schema: T.StructType
    replaced: tuple[str, ...] | None  # partitions it takes the place of, others it adds to; None: all
    dropped: tuple[str, ...] = ()
    note: dict | None = None  # what the writer wants to find again; None: as it was


class VersionedTable:
    """A parquet table whose current state is named by its newest manifest.

    Every write goes to a folder of its own (``data/commit_id=...``); a manifest
    (``versions/v0000000001.json``) lists the schema and, for each partition value,
    the folder that holds it, or a list of them: rows without an older copy are added in a
    folder of their own, so a load reads and writes again only partitions that hold old copies
    of its keys, or that have come to ``_MOST_FOLDERS`` folders. Creating the next manifest, which only one job can, is
    the only step that changes what readers see: a job lost before it leaves the table
    as it was. A change carries the version it was made from. If another job has
    published since, it is made again from the new version, so no job's rows are lost.

    Files older than a schema change are read with the current schema: added columns
    are NULL in them, removed ones are not read. A version stays readable for
    ``lease_hours`` after it was replaced, and so does a staged folder that no version
    names yet; older ones are deleted. The lease must exceed the longest job.

    The table's file system must refuse to rename onto an existing file (HDFS, ABFS
    with a hierarchical namespace, local files); S3-like stores are an error.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, partition_col: str | None = None,
                 key_determines_partition: bool = False, lease_hours: float = 24.0, sort_by: Sequence[str] = ()):
        """``sort_by`` orders the rows within files, so that row groups are skipped by those columns' statistics."""
        self.spark, self.path, self.key, self.partition_col = spark, path.rstrip("/"), key, partition_col
        self.key_determines_partition, self.lease_hours, self.sort_by = key_determines_partition, lease_hours, list(sort_by)

    # -- state ---------------------------------------------------------------------

    def _versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.path}/versions")
        return [int(m[1]) for n in names if (m := re.fullmatch(r"v(\d{10})\.json", n))]

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/versions/v{version:010d}.json"

    def _manifest(self, version: int | None = None) -> dict | None:
        version = version or max(self._versions(), default=0)
        if not version:
            return None
        return {"version": version, **json.loads(read_text(self.spark, self._manifest_path(version)))}

    def version(self) -> int:
        """The current version's number; 0 before the first load."""
        return max(self._versions(), default=0)

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self._manifest(version)["schema"])

    def dropped(self, version: int | None = None) -> tuple[str, ...]:
        return tuple(self._manifest(version)["dropped"])

    def note(self, version: int | None = None) -> dict:
        """What the version's writer left with it; empty before the first load."""
        return (self._manifest(version) or {}).get("note", {})

    def exists(self) -> bool:
        return bool(self._versions())

    def _leaf(self, value: str, folder: str) -> str:
        base = f"{self.path}/data/{_COMMIT}={folder}"
        return f"{base}/{self.partition_col}={value}" if self.partition_col else base

    def read(self, version: int | None = None) -> DataFrame | None:
        """The current state, or that of a version; None before the first load, no rows after an empty one."""
        m = None if version == 0 else self._manifest(version)
        if m is None:
            return None
        schema = T.StructType.fromJson(m["schema"])
        if not m["folders"]:
            return self.spark.createDataFrame([], schema)
        leaves = [self._leaf(v, f) for v, held in m["folders"].items() for f in _listed(held)]
        stored = T.StructType([*schema.fields, T.StructField(_COMMIT, T.StringType())])
        files = self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*leaves)
        return files.select(*schema.names)

    def partition_values(self) -> list[str]:
        """Partition values present, NULL left out, from the manifest (metadata only)."""
        return sorted(v for v in (self._manifest() or {"folders": {}})["folders"] if v != NULL_PARTITION)

    def folder(self) -> str | None:
        """Where an unpartitioned table's current files are."""
        m = self._manifest()
        return None if m is None or not m["folders"] else self._leaf("", m["folders"][""])

    def max_in_last_partition(self, column: str):
        """``max(column)`` when the partition value is monotone in ``column``.

        The partition column is the day (or month) of ``column``, so the maximum lies in
        the greatest partition that is not NULL: only that one is read. None when the
        table is absent or has no such partition.
        """
        values = self.partition_values()
        if not values:
            return None
        last = F.col(self.partition_col) == F.lit(max(values)).cast("date")  # ISO dates order as strings
        return self.read().filter(last).agg(F.max(column)).first()[0]

    # -- writes --------------------------------------------------------------------

    def stage(self, df: DataFrame) -> str:
        """Write ``df`` to a folder that no version names yet; its id."""
        folder = uuid.uuid4().hex
        writer = df
        if self.partition_col:
            # AQE sizes the write tasks: small partitions are coalesced, a skewed one
            # split, so files per partition stay few without one task per partition.
            writer = df.hint("rebalance", self.partition_col)
        if self.sort_by:
            order = [c for c in [self.partition_col, *self.sort_by] if c in df.columns]
            writer = writer.sortWithinPartitions(*order)
        w = writer.write.mode("errorifexists")
        if self.partition_col:
            w = w.partitionBy(self.partition_col)
        w.parquet(f"{self.path}/data/{_COMMIT}={folder}")
        return folder

    def staged(self, folder: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/{_COMMIT}={folder}")

    def discard(self, folder: str) -> None:
        delete_path(self.spark, f"{self.path}/data/{_COMMIT}={folder}")

    def _values_in(self, folder: str) -> list[str]:
        path = f"{self.path}/data/{_COMMIT}={folder}"
        if not path_exists(self.spark, path):
            raise RuntimeError(f"staged folder {path} is gone: its job outlasted the lease")
        if not self.partition_col:
            return [""]
        prefix = f"{self.partition_col}="
        return [n[len(prefix):] for n in list_names(self.spark, path) if n.startswith(prefix)]

    def publish(self, change: Change) -> None:
        """Make a staged change current: the version after the one it was made from, or ``ConcurrentWrite``."""
        before = self._manifest() or {"version": 0, "folders": {}, "dropped": []}
        if before["version"] != change.based_on:
            raise ConcurrentWrite(f"{self.path} is at version {before['version']}, the change at {change.based_on}")
        gone = set(change.replaced or ())
        kept = {} if change.replaced is None else {v: f for v, f in before["folders"].items() if v not in gone}
        folders = dict(kept)
        for v in self._values_in(change.folder) if change.folder else ():
            folders[v] = [*_listed(kept[v]), change.folder] if v in kept else change.folder
        body = {"schema": change.schema.jsonValue(), "folders": folders, "dropped": sorted(set(change.dropped)),
                "note": before.get("note", {}) if change.note is None else change.note}
        self._create_manifest(change.based_on + 1, json.dumps(body))
        # Looking through a lease's manifests is left to a share of the versions: a stream makes many.
        if (change.based_on + 1) % _CLEAN_EVERY == 0 or self.lease_hours <= 0:
            self._forget()

    def _create_manifest(self, version: int, text: str) -> None:
        """Write a version's manifest; of several jobs only one can."""
        fs, target = _fs_path(self.spark, self._manifest_path(version))
        scheme = fs.getUri().getScheme()
        if scheme not in _EXCLUSIVE_RENAME:
            raise ValueError(f"{scheme}: renames overwrite there, so two jobs could publish one version")
        _, fresh = _fs_path(self.spark, f"{self.path}/versions/new-{uuid.uuid4().hex}")
        out = fs.create(fresh, False)
        out.write(bytearray(text.encode()))
        out.close()
        if scheme == "file":  # a hard link, as a local rename would overwrite
            source, link = (unquote(urlparse(x.toUri().toString()).path) for x in (fresh, target))
            try:
                os.link(source, link)
                made = True
            except FileExistsError:
                made = False
            fs.delete(fresh, False)
        else:
            made = fs.rename(fresh, target)
            if not made:
                fs.delete(fresh, False)
        if not made:
            raise ConcurrentWrite(f"version {version} of {self.path} was written by another job")

    def _forget(self) -> None:
        """Delete versions and folders that have been out of use for longer than the lease."""
        fs, data = _fs_path(self.spark, f"{self.path}/data")
        _, versions = _fs_path(self.spark, f"{self.path}/versions")
        horizon = (time.time() - 3600 * self.lease_hours) * 1000
        written = {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(versions)}
        numbers = self._versions()
        live, over = set(), []
        for v, successor in zip(numbers, [*numbers[1:], None]):
            if successor is None or written.get(f"v{successor:010d}.json", horizon) >= horizon:
                for held in (self._manifest(v) or {"folders": {}})["folders"].values():
                    live.update(_listed(held))
            else:
                over.append(v)
        for s in fs.listStatus(data):
            if s.getModificationTime() < horizon and s.getPath().getName().removeprefix(f"{_COMMIT}=") not in live:
                fs.delete(s.getPath(), True)
        for v in over:
            delete_path(self.spark, self._manifest_path(v))
        for name, at in written.items():
            if name.startswith("new-") and at < horizon:
                delete_path(self.spark, f"{self.path}/versions/{name}")

    def change(self, make: Callable[[int], Change | None], attempts: int = 8) -> None:
        """Publish what ``make`` stages from the current version, made again whenever another job came first."""
        for left in reversed(range(attempts)):
            staged = make(self.version())
            if staged is None:
                return
            try:
                self.publish(staged)
                return
            except ConcurrentWrite:
                if staged.folder:
                    self.discard(staged.folder)
                if not left:
                    raise

    def replace(self, df: DataFrame, watch: Watch | None = None) -> DataFrame:
        """Full refresh; the new state. It does not depend on the old one, so it is staged once."""
        folder = self.stage(watch(df, None) if watch else df)
        for left in reversed(range(8)):
            try:
                self.publish(Change(self.version(), folder, df.schema, None))
                return self.read()
            except ConcurrentWrite:
                if not left:
                    raise

    def annotate(self, name: str, value) -> None:
        """Leave a value in the note of a new version; the rows stay as they are."""
        self.change(lambda v: Change(v, None, self.schema(v), (), self.dropped(v), {**self.note(v), name: value}))

    def changed_since(self, version: int) -> list[str] | None:
        """Partitions that the current version holds in other folders than ``version`` did; None if that is forgotten."""
        if version not in self._versions():
            return None
        before, now = self._manifest(version)["folders"], self._manifest()["folders"]
        return sorted(v for v, folder in now.items() if before.get(v) != folder)

    def read_partitions(self, values: Sequence[str]) -> DataFrame:
        """The rows of some partitions, named as in the manifest."""
        known = [None if v == NULL_PARTITION else v for v in values]
        return self.read().filter(self._in_partitions(known))

    def upsert(self, batch: DataFrame, policy: str = "ignore", watch: Watch | None = None) -> None:
        """delete+insert ``batch`` by ``key`` with schema policy ``policy``.

        The batch is computed once (written to the checkpoint folder); the merge is made
        from the version read, and again if another job published meanwhile.
        """
        if self.partition_col not in batch.columns:
            raise ValueError(f"batch lacks partition column {self.partition_col}")
        before = self._manifest()
        if before is None or not before["folders"]:  # no rows yet: the batch is written once
            first = (Change(0, self.stage(watch(batch, 0) if watch else batch), batch.schema, None) if before is None
                     else self.merge(batch, policy, before["version"], watch=watch))
            try:
                if first is not None:
                    self.publish(first)
                return
            except ConcurrentWrite:  # another job came first: merge into its version
                if first.folder:
                    self.discard(first.folder)
        rows, path = checkpoint_table(self.spark, batch, "batch")
        try:
            self.change(lambda version: self.merge(rows, policy, version, watch=watch))
        finally:
            delete_path(self.spark, path)

    def merge(self, rows: DataFrame, policy: str, version: int, note: dict | None = None,
              watch: Watch | None = None) -> Change | None:
        """Stage the upsert of ``rows`` into a version; None if it changes nothing. ``watch`` sees what is written.

        The partitions to rewrite are those that hold an older row with a batch key; to others
        the batch's rows are added. A column that comes back after it was removed is the one
        case in which all partitions are rewritten: older files may still hold its old values.
        """
        target, state = self.read(version), self._manifest(version)
        data_cols = [c for c in target.columns if c != self.partition_col]
        columns = evolve_columns(data_cols, [c for c in rows.columns if c != self.partition_col], policy)
        gone = set(state["dropped"])
        values = None
        if not state["folders"]:
            values = []
        elif not gone & set(columns):
            values, own = self._touched_partitions(target, rows)
            if not own and columns == data_cols:
                return None  # empty batch: nothing to delete or insert
            values += [v for v in own if v not in values and len(_listed(state["folders"].get(_name(v), []))) >= _MOST_FOLDERS]
        scope = target if values is None else target.filter(self._in_partitions(values)) if values else target.limit(0)
        merged = delete_insert(scope, rows, self.key, policy)
        names = None if values is None else tuple(_name(v) for v in values)
        folder = self.stage(watch(merged, version) if watch else merged)
        if not state["folders"] and columns == data_cols and not self._values_in(folder):
            self.discard(folder)
            return None
        return Change(version, folder, merged.schema, names, tuple(sorted((gone | set(data_cols)) - set(columns))), note)

    def _in_partitions(self, values: list) -> F.Column:
        known = F.col(self.partition_col).cast("string").isin([str(v) for v in values if v is not None])
        return known | F.col(self.partition_col).isNull() if None in values else known

    def _touched_partitions(self, target: DataFrame, batch: DataFrame) -> tuple[list, list]:
        """Partition values that hold an older copy of a batch key, and the batch's own, NULL included.

        Keys meet as 64-bit hashes: a false match has a partition rewritten, which changes no
        row of it. Only the target's key and partition columns are read, and of the batch's own
        partitions only, if the key determines the partition.
        """
        own = [r[0] for r in batch.select(self.partition_col).distinct().collect()]
        if not own:
            return [], own
        if self.key_determines_partition:
            target = target.filter(self._in_partitions(own))
        keys = batch.filter(F.col(self.key).isNotNull()).select(F.xxhash64(self.key).alias("_key"))
        holders = target.filter(F.col(self.key).isNotNull()).select(F.xxhash64(self.key).alias("_key"), self.partition_col)
        return [r[0] for r in holders.join(keys, "_key", "left_semi").select(self.partition_col).distinct().collect()], own

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def checkpoint_table(spark: SparkSession, df: DataFrame, name: str,
                     partition_by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """Materialise ``df`` as parquet in the shared checkpoint folder; return it re-read, and its path.

    Cuts lineage for a result several downstream plans share (instead of
    caching it in executor memory, which a lost executor would drop). The
    caller deletes the path once the consumers have run.
    """
    path = work_path(spark, "tables", name, unique=True)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path
