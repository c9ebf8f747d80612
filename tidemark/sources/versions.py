"""Tables that change together: numbered manifests, each created only if no other writer has created it.

A manifest names the folders of every table at one version, by slice. Data folders are written first and belong to nobody until a manifest
names them, so a writer that dies leaves the last version as it was. A writer says which version it has read; if another manifest with the
next number is there by then, nothing is published and ``Conflict`` is raised. Manifests also carry counters (ids that were given out) and
the last batch of each writer, so a batch that is run again finds that it has been published.

Replacing a slice writes that slice only: the other slices' folders are named again. Manifests are small (a path a slice and table) and are
the only thing that passes through the driver.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The slice of tables that have none.
WHOLE = ""
SLICE = "__slice"


class Conflict(RuntimeError):
    """Another writer has published since the version was read."""


class Part(NamedTuple):
    """What a version changes of one table. slices: those that the rows replace, by the column ``by`` (None: the whole table); a slice
    that is named and has no rows becomes empty. append: the rows come on top."""

    table: str
    rows: DataFrame
    by: str | None = None
    slices: tuple[str, ...] = ()
    append: bool = False


@dataclass(frozen=True)
class Version:
    number: int = 0
    #: table -> slice -> folders
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    counters: dict[str, int] = field(default_factory=dict)
    batches: dict[str, str] = field(default_factory=dict)


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def numbers(self) -> list[int]:
        at = self.path("_versions")
        fs = at.getFileSystem(self.conf)
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()) if fs.exists(at) else []

    def version(self, number: int) -> Version:
        return Version(**json.loads(self.spark.read.text(f"{self.root}/_versions/{number:020d}", wholetext=True).first()[0])) if number else Version()

    def latest(self) -> Version:
        return self.version(max(self.numbers(), default=0))

    def read(self, table: str, version: Version | None = None, slices: list[str] | None = None) -> DataFrame | None:
        """Rows of a table, of some slices only if they are named; None if no version has the table."""
        version = version or self.latest()
        if table not in version.tables:
            return None
        paths = [p for s, ps in version.tables[table].items() if slices is None or s in slices for p in ps]
        reader = self.spark.read.schema(version.schemas[table])
        return reader.parquet(*(f"{self.root}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], version.schemas[table])

    def written(self, part: Part) -> dict[str, list[str]]:
        """Folders of the new rows by slice. Slices that are named have one even if they get no row."""
        folder = f"{part.table}-{uuid.uuid4().hex}"
        if part.by is None:
            part.rows.write.parquet(f"{self.root}/{folder}")
            return {WHOLE: [folder]}
        # a slice's rows come from as many tasks as AQE makes of it: a hot one is split
        dealt = part.rows.withColumn(SLICE, F.col(part.by).cast("string")).hint("rebalance", F.col(SLICE))
        dealt.write.partitionBy(SLICE).parquet(f"{self.root}/{folder}")
        at = self.path(folder)
        names = (s.getPath().getName() for s in at.getFileSystem(self.conf).listStatus(at) if s.isDirectory())
        found = {unquote(n.removeprefix(f"{SLICE}=")): [f"{folder}/{n}"] for n in names if n.startswith(f"{SLICE}=")}
        if stray := set(found) - set(part.slices):
            raise ValueError(f"{part.table}: rows outside of the slices named: {', '.join(sorted(stray)[:5])}")
        return {s: found.get(s, []) for s in part.slices}

    def publish(self, parts: list[Part], on: Version, counters: dict[str, int] | None = None, batch: tuple[str, str] | None = None) -> Version:
        """The version after ``on`` with these changes, all of them or none."""
        tables, schemas = {t: dict(s) for t, s in on.tables.items()}, dict(on.schemas)
        for part in parts:
            new, old = self.written(part), tables.get(part.table, {})
            if part.append:
                tables[part.table] = old | {s: [*old.get(s, []), *ps] for s, ps in new.items()}
            else:
                tables[part.table] = new if part.by is None else old | new
            schemas[part.table] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in part.rows.schema)
        made = Version(on.number + 1, tables, schemas, on.counters | (counters or {}), on.batches | (dict([batch]) if batch else {}))
        self.commit(made)
        return made

    def commit(self, made: Version) -> None:
        """Creates the manifest under its number, unless it is there: a finished file gets its name in one step that fails on a taken one."""
        at, draft = self.path(f"_versions/{made.number:020d}"), self.path(f"_drafts/{uuid.uuid4().hex}")
        fs = draft.getFileSystem(self.conf)
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(made.__dict__).encode()))
        finally:
            out.close()
        fs.mkdirs(at.getParent())
        taken = "FileAlreadyExists"
        try:
            if fs.getScheme() == "file":  # local renames replace; links don't
                files = self.jvm.java.nio.file.Files
                files.createLink(self.jvm.java.io.File(at.toUri().getPath()).toPath(), self.jvm.java.io.File(draft.toUri().getPath()).toPath())
                fs.delete(draft, False)
            else:
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.conf)
                none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                context.rename(draft, at, none)
        except Exception as e:
            fs.delete(draft, False)
            if taken in str(e):
                raise Conflict(f"version {made.number} of {self.root} has been published by another writer") from e
            raise

    def unnamed(self, keep: int) -> list[str]:
        """Folders that none of the last ``keep`` versions names: leftovers of failed writers and of old versions."""
        named = {p.split("/")[0] for n in self.numbers()[-keep:] for slices in self.version(n).tables.values() for ps in slices.values() for p in ps}
        at = self.path("")
        return sorted(n for s in at.getFileSystem(self.conf).listStatus(at) if s.isDirectory() and not (n := s.getPath().getName()).startswith("_") and n not in named)
