"""Reconciliation by natural key: merge plan, versioned apply, cascade, re-attachment, pairing, audit.

The plan of all domains is one full outer join; applying it is a projection per action and a union. Nothing loops over domains or rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERT, UPDATE, REPLACE, DELETE, SKIP = "INSERT", "UPDATE", "REPLACE", "DELETE", "SKIP_DATE_REGRESSED"


def last_row(df: DataFrame, keys: list[str], row_no: str) -> DataFrame:
    """Of repeated keys the row that was read last."""
    w = Window.partitionBy(*keys).orderBy(F.col(row_no).desc_nulls_last())
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def merge_plan(existing: DataFrame, incoming: DataFrame, keys: list[str], date: str = "approval_date", id_col: str = "id") -> DataFrame:
    """keys, action, existing_id, old_date, new_date: what has to happen to every key. Dates decide between update, new version and skip."""
    old = existing.select(*keys, F.col(id_col).alias("existing_id"), F.col(date).alias("old_date"), F.lit(True).alias("is_old"))
    new = incoming.select(*keys, F.col(date).alias("new_date"), F.lit(True).alias("is_new"))
    both = old.join(new, keys, "full_outer")
    what = action(F.col("is_old").isNotNull(), F.col("is_new").isNotNull(), F.col("old_date"), F.col("new_date"))
    return both.select(*keys, what.alias("action"), "existing_id", "old_date", "new_date")


def action(is_old: Column, is_new: Column, old_date: Column, new_date: Column) -> Column:
    """What happens to a key that one side or both have."""
    same_day = old_date.isNull() | new_date.isNull() | (old_date == new_date)
    return F.when(~is_old, INSERT).when(~is_new, DELETE).when(same_day, UPDATE).when(new_date > old_date, REPLACE).otherwise(SKIP)


def undated_plan(existing: DataFrame, incoming: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """A plan without dates: only inserts, updates and deletes can come of it."""
    none = F.lit(None).cast("date")
    return merge_plan(existing.withColumn("approval_date", none), incoming.withColumn("approval_date", none), keys, id_col=id_col)


def changed(old: list[Column], new: list[Column]) -> Column:
    """Whether any written field differs, nulls being equal to nulls."""
    same = F.lit(True)
    for a, b in zip(old, new, strict=True):
        same = same & a.eqNullSafe(b)
    return ~same


def next_version(c: Column) -> Column:
    """null: 1; whole number: one more; any other text: 1."""
    return F.coalesce((F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint")) + 1).cast("string"), F.lit("1"))


def new_ids(df: DataFrame, order: list[str], start: Column | int = 0, name: str = "id") -> DataFrame:
    """Gapless ids in the order of ``order``, without sorting all rows in one task: range partitions, their counts' prefix sums (one row a
    partition), and row numbers inside each partition."""
    ranged = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    local = ranged.withColumn("__row", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    counts = local.groupBy("__part").agg(F.count("*").alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    first = start if isinstance(start, Column) else F.lit(start)
    return local.join(F.broadcast(offsets), "__part").withColumn(name, first + F.col("__before") + F.col("__row")).drop("__part", "__row", "__before")


def apply_versions(current: DataFrame, incoming: DataFrame, keys: list[str], fields: list[str], end_date: Column, date: str = "approval_date") -> DataFrame:
    """The next snapshot of a versioned table: current(id, keys, fields, date, version, active, end_date), all rows of which stay as history.

    INSERT: version 1. UPDATE: in place, only where a field differs. REPLACE: the old row ends, a new one has version + 1.
    DELETE: the row ends. SKIP: nothing. ``action`` tells what happened to a row; new rows have a null id (see ``new_ids``).

    One full outer join, one exchange a side: either row travels as a struct, and a pair gives its one or two rows where it meets.
    History takes no part in it.
    """
    kept = [*fields, date, "version", "active", "end_date"]
    old = current.filter("active").select(*keys, F.struct("id", *kept).alias("o"))
    new = incoming.select(*keys, F.struct(*fields, date).alias("n"))
    o, n = (lambda c: F.col(f"o.`{c}`")), (lambda c: F.col(f"n.`{c}`"))
    same_day = o(date).isNull() | n(date).isNull() | (o(date) == n(date))
    differs = changed([o(c) for c in (*fields, date)], [*(n(f) for f in fields), F.coalesce(n(date), o(date))])
    action = (
        F.when(F.col("o").isNull(), INSERT).when(F.col("n").isNull(), DELETE).when(same_day & ~differs, "UNCHANGED").when(same_day, UPDATE)
        .when(n(date) > o(date), REPLACE).otherwise(SKIP)
    )
    what = F.col("what")
    ends, update = what.isin(REPLACE, DELETE), what == UPDATE
    stays = F.struct(
        o("id").alias("id"), *(F.when(update, n(f)).otherwise(o(f)).alias(f) for f in fields), F.when(update, F.coalesce(n(date), o(date))).otherwise(o(date)).alias(date),
        o("version").alias("version"), (~ends).alias("active"), F.when(ends, end_date).otherwise(o("end_date")).alias("end_date"), what.alias("action"),
    )
    comes = F.struct(
        F.lit(None).cast(current.schema["id"].dataType).alias("id"), *(n(f).alias(f) for f in fields), n(date).alias(date),
        F.when(what == INSERT, F.lit("1")).otherwise(next_version(o("version"))).alias("version"), F.lit(True).alias("active"),
        F.lit(None).cast(current.schema["end_date"].dataType).alias("end_date"), F.concat(what, F.lit("_NEW")).alias("action"),
    )
    rows = F.array_compact(F.array(F.when(what != INSERT, stays), F.when(what.isin(INSERT, REPLACE), comes)))
    told = old.join(new, keys, "full_outer").withColumn("what", action).select(*keys, F.explode(rows).alias("r"))
    columns = ["id", *keys, *kept]
    live = told.select(F.col("r.id").alias("id"), *keys, *(F.col(f"r.`{c}`").alias(c) for c in (*kept, "action")))
    return live.unionByName(current.filter("not active").select(*columns, F.lit("HISTORY").alias("action")))


def apply_linked(current: DataFrame, incoming: DataFrame, keys: list[str], fields: list[str], parents: DataFrame, on: list[str], link: str, end_date: Column) -> DataFrame:
    """The next snapshot of undated rows that hang on versioned ones: current(id, keys, fields, link, active, end_date).

    Inserts, updates and deletes only. ``link`` is a field like the others: the id of the live row of ``parents`` (on, id), so a row whose
    parent has a new version moves to it in the same pass; where no parent lives, it keeps the link that it had.
    """
    live = parents.select(*on, F.col("id").alias(link))
    none = {"approval_date": F.lit(None).cast("date"), "version": F.lit(None).cast("string")}
    had = current.filter("active").select(*keys, F.col(link).alias("__had"))
    # a row whose parent has gone is rare: only those ask for the link that they had
    told = incoming.join(live, on, "left")
    gone = told.filter(F.col(link).isNull()).drop(link).join(had, keys, "left").withColumnRenamed("__had", link)
    linked = told.filter(F.col(link).isNotNull()).unionByName(gone)
    return apply_versions(current.withColumns(none), linked.withColumns({"approval_date": none["approval_date"]}), keys, [*fields, link], end_date).drop("approval_date", "version")


def cascade(children: DataFrame, plan: DataFrame, parent: str, end_date: Column, follow: bool = False) -> DataFrame:
    """Ends active children of parents that a plan ends. ``follow``: children of a replaced parent stay and move to its next version, which
    ``new_parent`` tells; the others end."""
    ended = plan.filter(F.col("action").isin(REPLACE, DELETE)).select(F.col("existing_id").alias(parent), F.col("action").alias("parent_action"))
    told = children.join(ended, parent, "left")
    gone = F.col("active") & F.col("parent_action").isNotNull()
    moves = gone & (F.col("parent_action") == REPLACE) if follow else F.lit(False)
    return told.withColumn("moves", F.coalesce(moves, F.lit(False))).withColumns({"end_date": F.when(gone & ~moves, end_date).otherwise(F.col("end_date")), "active": F.col("active") & ~(gone & ~moves)}).drop("parent_action")


def reattach(children: DataFrame, new_parents: DataFrame, parent: str) -> DataFrame:
    """Active children of a replaced parent get the id of its new version; new_parents: old_id, new_id."""
    moved = children.join(new_parents.select(F.col("old_id").alias(parent), "new_id"), parent, "left")
    return moved.withColumn(parent, F.when(F.col("active"), F.coalesce("new_id", parent)).otherwise(F.col(parent))).drop("new_id")


def pair_by_formula(existing: DataFrame, incoming: DataFrame, base: list[str], formula: str = "formula", date: str = "approval_date", id_col: str = "id") -> DataFrame:
    """A plan on a conditional key: one existing and one incoming row of a base key are the same source whatever their formula; otherwise
    the formula belongs to the key.

    Both sides are one table, sorted once by base key and formula, where each row sees the others of its key: sides that lie by base key in
    as many partitions are shuffled no more. Repeated keys meet each row of the other side; rows without a base key take no part.
    """
    old = existing.select(*base, F.col(formula).alias("__formula"), F.struct(F.col(id_col).alias("existing_id"), F.col(date).alias("old_date")).alias("o"))
    new = incoming.select(*base, F.col(formula).alias("__formula"), F.struct(F.col(date).alias("new_date")).alias("n"))
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    sides = old.select("*", none(new, "n")).unionByName(new.select("*", none(old, "o"))).dropna(subset=base)
    whole = Window.partitionBy(*base).orderBy("__formula").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = Window.partitionBy(*base, "__formula")
    told = sides.withColumn("__formula", F.coalesce(F.trim("__formula"), F.lit(""))).withColumns(
        {"n_old": F.count("o").over(whole), "n_new": F.count("n").over(whole), "other": F.first("n", ignorenulls=True).over(whole), "n_alike": F.count("o").over(same), "alike": F.collect_list("n").over(same)}
    )
    single, is_old = (F.col("n_old") == 1) & (F.col("n_new") == 1), F.col("o").isNotNull()
    # an existing row stands for its pairs, an incoming one for itself where it has none
    met = F.when(is_old, F.when(single, F.array("other")).when(F.size("alike") > 0, F.col("alike")).otherwise(F.array(none(new, "n")))).when(~single & (F.col("n_alike") == 0), F.array("n"))
    key = F.when(single, "").otherwise(F.col("__formula"))
    pairs = told.select(*base, key.alias("formula_key"), "o", F.explode(met).alias("n"))
    what = action(F.col("o").isNotNull(), F.col("n").isNotNull(), F.col("o.old_date"), F.col("n.new_date"))
    return pairs.select(*base, "formula_key", what.alias("action"), "o.existing_id", "o.old_date", "n.new_date")


def with_formula_key(existing: DataFrame, incoming: DataFrame, base: list[str], formula: str = "formula") -> tuple[DataFrame, DataFrame]:
    """Both sides with ``formula_key``: empty where a base key has one row on each, else the formula."""
    sides = existing.select(*base, F.lit(1).alias("e"), F.lit(0).alias("i")).unionByName(incoming.select(*base, F.lit(0).alias("e"), F.lit(1).alias("i")))
    single = sides.groupBy(*base).agg(((F.sum("e") == 1) & (F.sum("i") == 1)).alias("single"))
    told = lambda df: df.join(single, base).withColumn("formula_key", F.when(F.col("single"), "").otherwise(F.coalesce(F.trim(formula), F.lit("")))).drop("single")
    return told(existing), told(incoming)


def planned(plan: DataFrame, sink: Callable[[DataFrame], None] | None) -> DataFrame:
    """Hands the plan to its sink, if there is one; a dry run has none and computes the same."""
    if sink is not None:
        sink(plan)
    return plan


def duplicate_rules(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, n, n_distinct, verdict: identical repeats count once, repeats with other values are an error."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*(F.coalesce(F.col(f).cast("string"), F.lit("\0")).alias(f) for f in fields))).alias("n_distinct"))
    return g.filter("n > 1").withColumn("verdict", F.when(F.col("n_distinct") > 1, "CONFLICT").otherwise("DUPLICATE"))


def without_failing_groups(rows: DataFrame, errors: DataFrame, group: list[str]) -> DataFrame:
    """All or nothing: a group with any error keeps none of its rows."""
    return rows.join(errors.select(*group).distinct(), group, "left_anti")


def audit_lines(applied: DataFrame, keys: list[str], load_id: Column) -> DataFrame:
    """One line for each action that had an effect; a new version has one line, skips have theirs."""
    return applied.filter(~F.col("action").isin("UNCHANGED", "HISTORY", REPLACE)).select(load_id.alias("id_load"), *keys, F.regexp_replace("action", "_NEW$", "").alias("action"), "version")


def action_counts(applied: DataFrame, group: list[str], actions: tuple[str, ...] = (INSERT, UPDATE, REPLACE, DELETE, SKIP)) -> DataFrame:
    return applied.groupBy(*group).agg(*(F.count_if(F.col("action") == a).alias(a.lower()) for a in actions))


def complete_links(staged: DataFrame, governed: DataFrame, targets: DataFrame, ignore_dates: bool = False) -> DataFrame:
    """Outcome of each staged link, the first rule that fits.

    staged: domain, code, primary_name, primary_domain, approval_date. governed: domain, code, id, approval_date, primary_id, primary_domain_id.
    targets: name, domain_name, target_id, target_domain_id (one row a pair of names).
    """
    names = targets.select(F.col("name").alias("primary_name"), F.col("domain_name").alias("primary_domain"), "target_id", "target_domain_id")
    g = governed.select("domain", "code", "id", F.col("approval_date").alias("governed_date"), "primary_id", "primary_domain_id")
    told = staged.filter("code is not null").join(g, ["domain", "code"], "left").join(names, ["primary_name", "primary_domain"], "left")
    other = lambda have, want: F.col(have).isNotNull() & ~F.col(have).eqNullSafe(F.col(want))
    late = ~F.col("approval_date").eqNullSafe(F.col("governed_date"))
    outcome = (
        F.when(F.col("primary_name").isNull() | F.col("primary_domain").isNull(), "NO_TEXT")
        .when(F.col("id").isNull(), "NOT_GOVERNED")
        .when(F.col("primary_id").isNotNull() & F.col("primary_domain_id").isNotNull(), "ALREADY_LINKED")
        .when(late & F.lit(not ignore_dates), "DATE_SKIPPED")
        .when(F.col("target_id").isNull(), "NO_MATCH")
        .when(other("primary_id", "target_id") | other("primary_domain_id", "target_domain_id"), "CONFLICT")
        .otherwise("RESOLVED")
    )
    done = outcome == "RESOLVED"
    fill = lambda have, want: F.when(done, F.coalesce(have, want)).otherwise(F.col(have))
    return told.select("domain", "code", "id", outcome.alias("outcome"), late.alias("dates_differ"), fill("primary_id", "target_id").alias("primary_id"), fill("primary_domain_id", "target_domain_id").alias("primary_domain_id"))
