"""Submission gates and load history: fingerprints, version decisions, stale and unchanged files, status, retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import semver

SUCCESS = ("MERGE_OK", "SKIPPED_UNCHANGED")


def trimmed_headers(headers: DataFrame) -> DataFrame:
    """headers(file, sheet, pos, name): blank ones behind the last named one go, inner blanks stay."""
    last = F.max(F.when(F.coalesce(F.trim("name"), F.lit("")) != "", F.col("pos"))).over(Window.partitionBy("file", "sheet"))
    return headers.withColumn("last", last).filter("pos <= last").drop("last")


def fingerprints(headers: DataFrame, contract_sheets: DataFrame | None = None) -> DataFrame:
    """file, fingerprint: SHA-256 of lines ``sheet TAB col|col``, sheets sorted, columns in their order."""
    if contract_sheets is not None:
        headers = headers.join(contract_sheets.select("sheet"), "sheet", "left_semi")
    listed = F.array_sort(F.collect_list(F.struct("pos", F.coalesce("name", F.lit("")).alias("name"))))
    lines = headers.groupBy("file", "sheet").agg(F.array_join(F.transform(listed, lambda x: x["name"]), "|").alias("columns"))
    text = F.array_join(F.array_sort(F.collect_list(F.concat("sheet", F.lit("\t"), "columns"))), "\n")
    return lines.groupBy("file").agg(F.sha2(text, 256).alias("fingerprint"))


def structure_differences(found: DataFrame, declared: DataFrame) -> DataFrame:
    """file, sheet, missing, unexpected, reordered: found(file, sheet, columns array), declared(sheet, columns array)."""
    told = found.join(declared.select("sheet", F.col("columns").alias("want")), "sheet")
    same_set = F.array_sort("columns") == F.array_sort("want")
    return told.select("file", "sheet", F.array_except("want", "columns").alias("missing"), F.array_except("columns", "want").alias("unexpected"), (same_set & (F.col("columns") != F.col("want"))).alias("reordered"))


def version_decisions(files: DataFrame, registry: DataFrame, loader: str, today: Column) -> DataFrame:
    """Each file's decision by the first rule that fits; reason tells which.

    files: file, template, version, fingerprint. registry: template, version, state, fingerprint, columns_fingerprint, min_loader, grace_end.
    """
    r = registry.select("template", "version", "state", F.col("fingerprint").alias("registered"), "columns_fingerprint", "min_loader", "grace_end")
    told = files.join(r, ["template", "version"], "left")
    expired = F.col("grace_end").isNull() | (today > F.col("grace_end"))
    reason = (
        F.when(F.col("state").isNull(), "unknown version").when(F.col("state") == "DRAFT", "draft").when(F.col("state") == "RETIRED", "retired")
        .when((F.col("state") == "DEPRECATED") & expired, "deprecated past its grace").when(semver(F.lit(loader))[0] < semver(F.col("min_loader"))[0], "loader too old")
        .when(~F.col("registered").eqNullSafe(F.col("columns_fingerprint")), "registry inconsistent").when(~F.col("fingerprint").eqNullSafe(F.col("registered")), "structure differs")
        .when(F.col("state") == "DEPRECATED", "deprecated, in its grace").otherwise("accepted")
    )
    decision = F.when(reason == "loader too old", "REJECTED_LOADER").when(reason == "structure differs", "REJECTED_STRUCTURE").when(reason.isin("accepted", "deprecated, in its grace"), "ACCEPTED").otherwise("REJECTED_VERSION")
    return told.select("file", "template", "version", decision.alias("decision"), reason.alias("reason"))


def identify(files: DataFrame, registry: DataFrame) -> DataFrame:
    """The version of files without control block, by fingerprint: never drafts, live ones first, then the highest version."""
    known = registry.filter("state <> 'DRAFT'").groupBy("fingerprint").agg(F.max_by("version", F.struct(F.col("state") == "LIVE", semver(F.col("version"))[0])).alias("version"))
    return files.join(known, "fingerprint", "left")


def last_good(loads: DataFrame) -> DataFrame:
    """domain, last_id, last_hash, last_state of the latest successful load of each domain."""
    return loads.filter(F.col("state").isin(*SUCCESS)).groupBy("domain").agg(F.max_by(F.struct("id_load", "hash", "state"), "id_load").alias("l")).select("domain", F.col("l.id_load").alias("last_id"), F.col("l.hash").alias("last_hash"), F.col("l.state").alias("last_state"))


def base_gate(files: DataFrame, loads: DataFrame) -> DataFrame:
    """files: file, domain, hash, base_id. A declared base that is not the last good load is stale; the last load's hash means unchanged."""
    told = files.join(last_good(loads), "domain", "left")
    gate = F.when(F.col("base_id").isNotNull() & ~F.col("base_id").eqNullSafe(F.col("last_id")), "REJECTED_STALE").when(F.col("hash") == F.col("last_hash"), "SKIPPED_UNCHANGED").otherwise("ACCEPTED")
    return told.select("file", "domain", gate.alias("gate"), (F.col("base_id").isNull() & F.col("last_id").isNotNull()).alias("base_warning"))


def identity_gate(files: DataFrame, template: str) -> DataFrame:
    """files: file, template, declared_domain, anchor_domain, has_control."""
    gate = F.when(~F.col("has_control"), "REJECTED_CONTROL").when(F.col("template") != template, "REJECTED_VERSION").when(F.col("anchor_domain").isNull() | (F.col("declared_domain") != F.col("anchor_domain")), "REJECTED_DOMAIN")
    return files.select("file", F.coalesce(gate, F.lit("ACCEPTED")).alias("gate"))


def load_status(steps: DataFrame, objects: int = 7) -> DataFrame:
    """One state a load from its steps. steps: id_load, step (gate, sheet, merge), outcome, error."""
    bad = lambda step: F.count_if((F.col("step") == step) & F.col("error").isNotNull())
    g = steps.groupBy("id_load").agg(
        F.min(F.when((F.col("step") == "gate") & (F.col("outcome") != "ACCEPTED"), F.col("outcome"))).alias("gate"), bad("sheet").alias("bad_sheets"), bad("merge").alias("bad_merges"),
    )
    state = F.coalesce("gate", F.when(F.col("bad_sheets") > 0, "ERROR_STAGING").when(F.col("bad_merges") >= objects, "ERROR_MERGE").when(F.col("bad_merges") > 0, "MERGE_PARTIAL").otherwise("MERGE_OK"))
    return g.select("id_load", state.alias("state"), "bad_sheets", "bad_merges")


def load_details(applied: DataFrame) -> DataFrame:
    """id_load, stage, object, n: counts to append to the history."""
    return applied.groupBy("id_load", "stage", "object").agg(F.count("*").alias("n"))


def current_loads(events: DataFrame, columns: list[str]) -> DataFrame:
    """Each load's latest value of each column, nulls not counting: events are only ever appended."""
    return events.groupBy("id_load").agg(*(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in columns))


def retention(loads: DataFrame, today: Column, days: int = 365) -> DataFrame:
    """Archived, not purged, older than ``days``, and never the last good load of a domain (null is a domain too)."""
    newest = loads.filter(F.col("state").isin(*SUCCESS)).groupBy("domain").agg(F.max("id_load").alias("id_load")).select("id_load")
    old = loads.filter("archived_path is not null and purged is null").filter(F.col("started") < F.date_sub(today, days))
    return old.join(newest, "id_load", "left_anti")


def generation_diagnosis(domains: DataFrame, loads: DataFrame, staged: DataFrame, consumption: DataFrame, live_version: str) -> DataFrame:
    """Per domain: last good load, rows staged under it and under others, live consumption rows, verdict."""
    good = loads.filter(F.col("state").isin(*SUCCESS)).groupBy("domain").agg(F.max_by(F.struct("id_load", "version"), "id_load").alias("l"))
    rows = staged.groupBy("domain", "id_load").agg(F.count("*").alias("n"))
    used = consumption.groupBy("domain").agg(F.count("*").alias("n_consumption"))
    told = rows.join(good.select("domain", F.col("l.id_load").alias("last_id")), "domain", "left").groupBy("domain").agg(F.sum(F.when(F.col("id_load") == F.col("last_id"), F.col("n")).otherwise(0)).alias("n_own"), F.sum(F.when(F.col("id_load").eqNullSafe(F.col("last_id")), 0).otherwise(F.col("n"))).alias("n_other"))
    all_ = reduce(lambda a, b: a.join(b, "domain", "left"), (good.select("domain", F.col("l.id_load").alias("last_id"), F.col("l.version").alias("version")), told, used), domains.select("domain")).na.fill(0, ["n_own", "n_other", "n_consumption"])
    verdict = F.when(F.col("last_id").isNull(), "NO_GOOD_LOAD").when((F.col("n_own") > 0) & (F.col("n_other") == 0), "FROM_STAGING").when(F.col("version") == live_version, "NEEDS_ARCHIVE").otherwise("OLD_VERSION")
    return all_.withColumn("verdict", verdict)
