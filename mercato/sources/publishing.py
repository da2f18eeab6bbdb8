"""Published versions of a set of tables: snapshot folders and a pointer switched by one atomic rename.

Layout under a root in the shared store::

    versions/<run id>/<layer>/<table>/...   written by one run, never changed afterwards
    published/000000000007.json             pointer: the tables of version 7 and their folders

A run writes all its tables into a folder of its own, passes its checks there,
and is published by renaming a finished pointer file to the next number. Readers
take the largest number. So a reader sees all tables of one version or none; a
run that is killed, or that fails its gate, leaves nothing that a reader looks
at, and of two runs that publish at once the second fails (the number is taken)
and may rebase. A version may keep folders of an older one: a table, or a part
of a table, that did not change is not copied. ``prune`` keeps the newest
versions and the folders that they name.

Pointers are small (folder names only) and are read through the Hadoop
FileSystem, so any store that Spark writes to will do, provided that its rename
is atomic and does not replace a file.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Digits of a pointer's file name, so that names sort by number.
WIDTH = 12


class PublishConflict(RuntimeError):
    """Another run has published this version number in the meantime."""


@dataclass(frozen=True)
class Table:
    """Folders of a table (its parts, in a version's own or an older folder) and its schema, as JSON."""

    paths: tuple[str, ...]
    schema: str

    def read(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema))
        if not self.paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*self.paths)


@dataclass(frozen=True)
class Version:
    number: int
    run: str
    tables: Mapping[str, Table]
    notes: Mapping[str, object] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"version {self.number} has no table {name}; it has {', '.join(sorted(self.tables))}")
        return self.tables[name].read(spark)

    def folders(self) -> set[str]:
        return {p for t in self.tables.values() for p in t.paths}


class _Files:
    """The few file operations needed, on whatever file system the root is in."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), False)
        try:
            out.write(bytearray(text.encode()))
            out.hsync()
        finally:
            out.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def age(self, name: str) -> float:
        """Seconds since a folder was last changed."""
        return time.time() - self.fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def rename_new(self, old: str, new: str) -> bool:
        """Atomic, and never over an existing file."""
        if self.fs.exists(self.path(new)):
            return False
        try:
            rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
            none = self.gateway.new_array(rename, 1)
            none[0] = rename.NONE
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(new).toUri(), self.conf)
            context.rename(self.path(old), self.path(new), none)
            return True
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def history(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    names = _Files(spark, root).names(f"{root.rstrip('/')}/published")
    return [int(n[:WIDTH]) for n in names if len(n) == WIDTH + 5 and n[:WIDTH].isdigit() and n.endswith(".json")]


def resolve(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """A version, the current one by default; None where nothing is published yet."""
    numbers = history(spark, root)
    if number is None:
        if not numbers:
            return None
        number = numbers[-1]
    elif number not in numbers:
        raise KeyError(f"version {number} is not kept; there are {numbers}")
    got = json.loads(_Files(spark, root).read(f"{root.rstrip('/')}/published/{number:0{WIDTH}d}.json"))
    tables = {k: Table(tuple(v["paths"]), v["schema"]) for k, v in got["tables"].items()}
    return Version(number, got["run"], tables, got.get("notes", {}))


def read_published(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """All tables of one version."""
    version = resolve(spark, root, number)
    if version is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return {name: version.read(spark, name) for name in version.tables}


class Run:
    """One writer: tables go to its own folder until ``publish``.

    ``base`` is the version that it started from; publishing fails with
    ``PublishConflict`` if a later one has been published since.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.base = resolve(spark, self.root)
        self.id = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"
        self.folder = f"{self.root}/versions/{self.id}"
        self.tables: dict[str, Table] = {}

    def write(self, name: str, df: DataFrame, folder: str | None = None) -> DataFrame:
        """Writes a table of this run and reads it back (lineage is cut at the files)."""
        path = f"{self.folder}/{folder or name}"
        df.write.mode("errorifexists").parquet(path)
        return self.adopt(name, [path], df.schema)

    def write_parts(self, name: str, df: DataFrame, part: str, replaced: Sequence[int]) -> DataFrame:
        """Replaces the parts ``replaced`` of the base version's table by the rows of ``df``; other parts keep their folders.

        ``part`` is an int column, one folder a value, and is not stored. A part that gets no rows is gone.
        """
        path = f"{self.folder}/{name}"
        stored = T.StructType([f for f in df.schema.fields if f.name != part])
        df.write.mode("errorifexists").partitionBy(part).parquet(path)
        files = _Files(self.spark, self.root)
        new = [f"{path}/{n}" for n in files.names(path) if n.startswith(f"{part}=")]
        gone = {f"{part}={int(p)}" for p in replaced}
        unplanned = {p.rsplit("/", 1)[1] for p in new} - gone
        if unplanned:
            raise ValueError(f"{name}: rows for parts that are not replaced: {sorted(unplanned)}")
        old = self.base.tables[name].paths if self.base and name in self.base.tables else ()
        return self.adopt(name, [*(p for p in old if p.rsplit("/", 1)[1] not in gone), *new], stored)

    def keep(self, *names: str) -> None:
        """Tables that this version takes over from its base as they are."""
        for name in names:
            self.tables[name] = self.base.tables[name]

    def adopt(self, name: str, paths: Sequence[str], schema: T.StructType) -> DataFrame:
        """Names folders that other code has written as a table of this version."""
        flat = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        self.tables[name] = Table(tuple(paths), json.dumps(flat.jsonValue()))
        return self.tables[name].read(self.spark)

    def discard(self, *names: str) -> None:
        """Working tables of this run: their folders go, no version names them."""
        files = _Files(self.spark, self.root)
        for name in names:
            for path in self.tables.pop(name).paths if name in self.tables else ():
                files.delete(path)

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read(self.spark)

    def publish(self, gate: Callable[[Mapping[str, DataFrame]], Mapping | None] | None = None, notes: Mapping | None = None) -> Version:
        """Makes the tables visible, all at once, if ``gate`` (over this version's tables) does not raise; what it returns is
        kept in the version's notes."""
        notes = dict(notes or {})
        if gate is not None:
            notes |= gate({name: self.read(name) for name in self.tables}) or {}
        number = (self.base.number if self.base else 0) + 1
        files = _Files(self.spark, self.root)
        files.fs.mkdirs(files.path(f"{self.root}/published"))
        body = {"run": self.id, "notes": notes, "tables": {k: {"paths": list(t.paths), "schema": t.schema} for k, t in self.tables.items()}}
        draft = f"{self.root}/published/.draft-{self.id}"
        files.write(draft, json.dumps(body))
        if not files.rename_new(draft, f"{self.root}/published/{number:0{WIDTH}d}.json"):
            files.delete(draft)
            raise PublishConflict(f"version {number} of {self.root} has been published by another run")
        return Version(number, self.id, dict(self.tables), body["notes"])


def prune(spark: SparkSession, root: str, keep: int = 3, abandoned_after: float = 7 * 86_400) -> list[int]:
    """Drops all but the ``keep`` newest versions, and run folders that no kept version names.

    A folder without a version may belong to a run that is still writing: it goes
    only when it has not changed for ``abandoned_after`` seconds. Pointers go
    first, so a reader that resolves a pointer finds its folders; readers that
    hold an older version than the kept ones must be done.
    """
    root, files = root.rstrip("/"), _Files(spark, root)
    numbers = history(spark, root)
    dropped = numbers[:-keep] if keep else []
    old = [resolve(spark, root, n) for n in dropped]
    kept = [resolve(spark, root, n) for n in numbers if n not in dropped]
    for n in dropped:
        files.delete(f"{root}/published/{n:0{WIDTH}d}.json")
    named = set().union(*(v.folders() for v in kept)) if kept else set()
    for path in set().union(*(v.folders() for v in old)) - named if old else ():
        files.delete(path)
    runs, used = {v.run for v in old}, {p[len(f"{root}/versions/"):].split("/")[0] for p in named}
    for run in files.names(f"{root}/versions"):
        if run not in used and run not in {v.run for v in kept} and (run in runs or files.age(f"{root}/versions/{run}") > abandoned_after):
            files.delete(f"{root}/versions/{run}")
    return dropped
