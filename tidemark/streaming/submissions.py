"""From submitted files to governed tables, as a stream: gates, staging, merge and load history of a micro-batch in one step.

A submission is a file of JSON lines: a control record (template, version, domain, base_load), then the rows of its sheet. Each file gets
one outcome, the first rule that fits: REJECTED_CONTROL, REJECTED_VERSION (or _STRUCTURE, _LOADER), REJECTED_DOMAIN, REJECTED_STALE,
SKIPPED_UNCHANGED, ERROR_STAGING (any row with an error: nothing of the file is taken), MERGE_OK. Accepted files replace their domain's
staging slice and are merged into the domain's slice of the governed table; staging, governed rows, audit lines and load history are
published as one version, so readers see all of a batch's effects or none.

Files of one domain take effect one after the other, by name, as each may build on the one before: a batch is applied in waves, each with
one file a domain at most. Waves are numbered in the published version; a batch that is run again goes on behind the last one. If another
writer publishes in between, the wave is done anew on its version.

Each wave's files also go to ``outcomes``. With ``dry`` that is all: rows are typed, judged and merged against the last version, and no
version is published.

Only the slices of the batch's domains are read or written. What the driver gets is one row a file, ``files_per_batch`` at most.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import gates as G
from ..operators import reconcile as R
from ..sources.sheets import Contract
from ..sources.versions import Conflict, Part, Store
from .intake import content, line_places, lines_of

STAGED, GOVERNED, AUDIT, LOADS = "staged", "governed", "audit", "loads"
CONTROL = "struct<template string, version string, domain string, base_load string>"
#: The slice of loads whose domain isn't known.
NOWHERE = "?"
LOAD = "id_load long, file string, domain string, state string, hash string, base_id long, n_rows long, n_errors long, message string, insert long, update long, replace long, delete long, skip_date_regressed long"
ACTIONS = tuple(a.lower() for a in (R.INSERT, R.UPDATE, R.REPLACE, R.DELETE, R.SKIP))
WORK = "_work"


@dataclass
class Submissions:
    """What a folder's submissions must be. typed: rows (the contract's columns as text) to keys, fields, date and ``errors``."""

    store: Store
    contract: Contract
    registry: DataFrame
    template: str
    loader: str
    today: Column
    typed: Callable[[DataFrame], DataFrame]
    keys: list[str]
    fields: list[str]
    date: str = "approval_date"
    name: str = "submissions"
    #: A dry run judges and merges as any run, and publishes nothing: ``outcomes`` has what the load history would get.
    dry: bool = False
    outcomes: list[dict] = field(default_factory=list)

    def heads(self, lines: DataFrame) -> list[dict]:
        """One record a file: control, domain of its rows, fingerprint of its columns, content, gate before its base is looked at."""
        told = self.parsed(lines, "value").select("*", F.get_json_object("row", f"$.{self.contract.key}").alias("anchor"), F.json_object_keys("row").alias("names"))
        row = F.col("row").isNotNull()
        # rows with other columns than the first ones' are another structure
        facts = told.groupBy("file").agg(
            F.max("control").alias("control"), F.when(F.min("anchor") == F.max("anchor"), F.min("anchor")).alias("anchor_domain"), F.count_if(row).alias("n_rows"),
            F.min_by("names", F.when(row, F.col("place"))).alias("names"), (F.min("names") == F.max("names")).alias("one_header"), content(F.col("place"), ["value"]).alias("hash"),
        )
        # one pass over the lines gives a row a file, from which all gates are told
        files = lines.sparkSession.createDataFrame(facts.toArrow())
        headers = files.select("file", F.lit(self.contract.name).alias("sheet"), F.posexplode("names").alias("pos", "name"))
        files = files.join(G.fingerprints(headers), "file", "left")
        files = files.select("*", F.col("control.template").alias("template"), F.col("control.version").alias("version"), F.col("control.domain").alias("declared_domain"), F.col("control").isNotNull().alias("has_control"))
        files = files.withColumn("fingerprint", F.when(F.col("one_header"), F.col("fingerprint")))
        identity = G.identity_gate(files, self.template).withColumnRenamed("gate", "identity")
        decided = G.version_decisions(files.select("file", "template", "version", "fingerprint"), self.registry, self.loader, self.today)
        gate = F.when(F.col("identity").isin("REJECTED_CONTROL", "REJECTED_VERSION"), F.col("identity")).when(F.col("decision") != "ACCEPTED", F.col("decision")).otherwise(F.col("identity"))
        base = F.col("control.base_load").try_cast("bigint")
        out = files.join(identity, "file").join(decided.select("file", "decision", "reason"), "file").select("file", F.col("anchor_domain").alias("domain"), "hash", base.alias("base_id"), "n_rows", gate.alias("gate"), "reason")
        wave = F.row_number().over(Window.partitionBy(F.coalesce("domain", "file")).orderBy("file"))
        return [r.asDict() for r in out.withColumn("wave", wave).collect()]

    @staticmethod
    def parsed(lines: DataFrame, *more: str) -> DataFrame:
        """file, place, control, row (JSON)."""
        return lines.select("file", "place", *more, F.from_json(F.get_json_object("value", "$.control"), CONTROL).alias("control"), F.get_json_object("value", "$.row").alias("row"))

    def rows(self, lines: DataFrame, loads: dict[str, int]) -> DataFrame:
        """The contract's columns as text, stamped with their load and place."""
        told = self.parsed(lines).filter(F.col("file").isin(list(loads)) & F.col("row").isNotNull())
        columns = self.contract.columns
        values = F.from_json("row", ", ".join(f"`{c}` string" for c in columns))
        load = F.element_at(F.create_map(*(F.lit(x) for kv in loads.items() for x in kv)), F.col("file")).cast("bigint")
        return told.select(load.alias("id_load"), "place", values.alias("v")).select("id_load", "place", *(F.col(f"v.`{c}`") for c in columns))

    def wave(self, lines: DataFrame, files: list[dict], mark: str) -> None:
        """Judges these files against the last version, applies those that pass, and publishes all of it."""
        spark, now = lines.sparkSession, self.store.latest()
        if now.batches.get(self.name) == mark:
            return
        domains = sorted({f["domain"] for f in files if f["domain"]})
        first_load = now.counters.get("load", 0) + 1
        for k, f in enumerate(sorted(files, key=lambda f: f["file"])):
            f |= {"id_load": first_load + k, "state": f["gate"], "n_errors": 0, "message": f["reason"] if f["gate"] != "ACCEPTED" else "", **dict.fromkeys(ACTIONS, 0)}
        passed = [f for f in files if f["state"] == "ACCEPTED"]
        if passed:
            history = self.store.read(LOADS, now, domains)
            history = spark.createDataFrame([], LOAD) if history is None else history
            asked = spark.createDataFrame([(f["file"], f["domain"], f["hash"], f["base_id"]) for f in passed], "file string, domain string, hash string, base_id long")
            gates = {r["file"]: r["gate"] for r in G.base_gate(asked, history).collect()}
            for f in passed:
                f["state"] = gates[f["file"]]
        parts, counters = [], {"load": first_load + len(files) - 1}
        accepted = {f["file"]: f for f in files if f["state"] == "ACCEPTED"}
        work = f"{self.store.root}/{WORK}/{mark}"
        if accepted:
            # one pass reads and types the rows; what follows reads them from there
            typed = self.kept(self.typed(self.rows(lines, {n: f["id_load"] for n, f in accepted.items()})), f"{work}/typed")
            bad = {r["id_load"]: (r["n"], r["m"]) for r in typed.filter("errors <> ''").groupBy("id_load").agg(F.count("*").alias("n"), F.min("errors").alias("m")).collect()}
            for f in accepted.values():
                n, message = bad.get(f["id_load"], (0, ""))
                f |= {"n_errors": n, "message": message, "state": "ERROR_STAGING" if n else "MERGE_OK"}
            good = [f for f in accepted.values() if f["state"] == "MERGE_OK"]
            if good:
                parts += self.merged(typed.filter(F.col("id_load").isin([f["id_load"] for f in good])).drop("errors"), good, now, counters, work)
        self.outcomes += files
        if self.dry:
            return
        loads = spark.createDataFrame([tuple(f[c] for c in ("id_load", "file", "domain", "state", "hash", "base_id", "n_rows", "n_errors", "message", *ACTIONS)) for f in files], LOAD)
        parts.append(Part(LOADS, loads.withColumn("place", F.coalesce("domain", F.lit(NOWHERE))), "place", tuple(sorted({f["domain"] or NOWHERE for f in files})), append=True))
        self.store.publish(parts, now, counters, batch=(self.name, mark))

    def kept(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def merged(self, rows: DataFrame, files: list[dict], now, counters: dict[str, int], work: str) -> list[Part]:
        """Staging, governed and audit parts of the domains whose files are good; fills in the files' counts."""
        spark, domain = rows.sparkSession, self.contract.key
        slices = tuple(f["domain"] for f in files)
        current = self.store.read(GOVERNED, now, list(slices))
        if current is None:
            types = {f.name: f.dataType.simpleString() for f in rows.schema}
            current = spark.createDataFrame([], f"id long, {', '.join(f'`{c}` {types[c]}' for c in (*self.keys, *self.fields, self.date))}, version string, active boolean, end_date date")
        incoming = R.last_row(rows, self.keys, "place")
        applied = self.kept(R.apply_versions(current, incoming, self.keys, self.fields, self.today, self.date), f"{work}/applied")
        start = now.counters.get("id", 0)
        fresh = R.new_ids(applied.filter("id is null"), self.keys, start, "__id").withColumn("id", F.col("__id").cast("bigint")).drop("__id")
        governed = applied.filter("id is not null").unionByName(fresh).drop("action")
        load = F.element_at(F.create_map(*(F.lit(x) for f in files for x in (f["domain"], f["id_load"]))), F.col(domain)).cast("bigint")
        told = R.action_counts(applied.withColumn("action", F.regexp_replace("action", "^(INSERT)_NEW$", "$1")).filter("action <> 'REPLACE_NEW'"), [domain]).collect()
        counts = {r[domain]: r.asDict() for r in told}
        for f in files:
            f |= {a: counts.get(f["domain"], {}).get(a, 0) for a in ACTIONS}
        counters["id"] = start + sum(f["insert"] + f["replace"] for f in files)
        return [Part(STAGED, rows.drop("place"), domain, slices), Part(GOVERNED, governed, domain, slices), Part(AUDIT, R.audit_lines(applied, self.keys, load), append=True)]

    def each(self, batch: DataFrame, batch_id: int) -> None:
        lines = line_places(batch)
        last, _, wave = self.store.latest().batches.get(self.name, "-1:0").partition(":")
        if int(last) > batch_id:
            return
        done = int(wave) if int(last) == batch_id else 0
        files = self.heads(lines)
        for k in range(done + 1, max((f["wave"] for f in files), default=0) + 1):
            for last_try in (False, False, False, True):
                try:
                    self.wave(lines, [dict(f) for f in files if f["wave"] == k], f"{batch_id}:{k}")
                    break
                except Conflict:
                    if last_try:
                        raise

    def start(self, spark: SparkSession, folder: str, checkpoint: str, files_per_batch: int = 8) -> StreamingQuery:
        stream = lines_of(spark.readStream.option("maxFilesPerTrigger", files_per_batch).format("text").load(folder))
        return stream.writeStream.foreachBatch(self.each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
