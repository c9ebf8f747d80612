"""Catalogue resolution as joins: texts to ids, with errors as rows instead of exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .reconcile import new_ids

#: Equality of catalogue texts: case, accents and trailing blanks don't count.
COLLATION = "UNICODE_CI_AI_RTRIM"


def one_per_text(catalogue: DataFrame, texts: list[str], id_col: str, collated: bool = True) -> DataFrame:
    """Texts that are equal under the collation would multiply rows: the lowest id stands for them."""
    keys = [F.collate(F.col(t), COLLATION).alias(f"__{t}") if collated else F.col(t).alias(f"__{t}") for t in texts]
    return catalogue.groupBy(*keys).agg(F.min(id_col).alias(id_col))


def controlled(df: DataFrame, column: str, catalogue: DataFrame, text: str, id_col: str, out: str, collated: bool = True) -> DataFrame:
    """``out``: the catalogue's id; null passes as null, an unknown text gets ``out_error``."""
    known = one_per_text(catalogue, [text], id_col, collated).withColumnRenamed(id_col, out)
    key = F.collate(F.col(column), COLLATION) if collated else F.col(column)
    found = df.join(known, key == F.col(f"__{text}"), "left").drop(f"__{text}")
    return found.withColumn(f"{out}_error", F.when(F.col(column).isNotNull() & F.col(out).isNull(), F.concat(F.lit("unknown value: "), F.col(column))))


def composite(df: DataFrame, columns: list[str], catalogue: DataFrame, codes: list[str], id_col: str, out: str) -> DataFrame:
    """Several codes name one id; without the first code there is nothing to look up, and partial codes never match."""
    known = catalogue.select(*(F.col(c).alias(f"__{c}") for c in codes), F.col(id_col).alias(out))
    same = [F.col(a) == F.col(f"__{b}") for a, b in zip(columns, codes, strict=True)]
    found = df.join(known, same, "left").drop(*(f"__{c}" for c in codes))
    return found.withColumn(f"{out}_error", F.when(F.col(columns[0]).isNotNull() & F.col(out).isNull(), F.concat_ws("/", *columns)))


def chain(df: DataFrame, levels: list[tuple[str, DataFrame, str, str, str | None]]) -> DataFrame:
    """Lookups below each other. A level: column, catalogue, its text, its id, and the catalogue column that holds the upper level's id
    (None at the top). ``<id>`` and the first level that fails, ``failed_level``, are added."""
    failed: list[Column] = []
    upper: str | None = None
    for column, catalogue, text, id_col, parent in levels:
        known = catalogue.select(F.col(text).alias("__text"), F.col(id_col), *([F.col(parent).alias("__parent")] if parent else []))
        same = F.col(column) == F.col("__text")
        if parent and upper:
            same = same & (F.col(upper) == F.col("__parent"))
        df = df.join(known, same, "left").drop("__text", "__parent")
        failed.append(F.when(F.col(column).isNotNull() & F.col(id_col).isNull(), F.lit(column)))
        upper = id_col
    return df.withColumn("failed_level", F.coalesce(*failed))


def created_chain(df: DataFrame, top: tuple[str, DataFrame, str, str], levels: list[tuple[str, DataFrame, str, str, str, str | None]]) -> tuple[DataFrame, DataFrame]:
    """Lookups below a level that makes what it lacks: rows with all ids, ``failed_level`` and ``reason`` (unknown, inactive), and the top
    catalogue with its new members.

    top: column, catalogue, its text, its id. A level: column, catalogue, its text, its id, the column with the upper level's id, the
    column that tells whether it is active (None: not asked). A new member of the top has nothing below it yet, so its rows fail one level
    down. New ids feed the next level's join in the same job.
    """
    column, catalogue, text, id_col = top
    members = get_or_create(df.filter(F.col(column).isNotNull()).select(F.col(column).alias(text)), catalogue, text, id_col)
    df = df.join(members.select(F.col(text).alias("__text"), id_col), F.col(column) == F.col("__text"), "left").drop("__text")
    failed = [F.when(F.col(column).isNull(), F.struct(F.lit(column).alias("level"), F.lit("unknown").alias("reason")))]
    upper = id_col
    for column, catalogue, text, id_col, parent, active in levels:
        known = catalogue.select(F.col(text).alias("__text"), F.col(parent).alias("__parent"), F.col(id_col), (F.col(active) if active else F.lit(True)).alias(f"__{id_col}"))
        df = df.join(known, (F.col(column) == F.col("__text")) & (F.col(upper) == F.col("__parent")), "left").drop("__text", "__parent")
        bad = F.when(F.col(id_col).isNull(), "unknown").when(~F.col(f"__{id_col}"), "inactive")
        failed.append(F.when(bad.isNotNull(), F.struct(F.lit(column).alias("level"), bad.alias("reason"))))
        upper = id_col
    told = df.withColumn("__failed", F.coalesce(*failed))
    told = told.withColumns({"failed_level": F.col("__failed.level"), "reason": F.col("__failed.reason")})
    return told.drop("__failed", *(f"__{level[3]}" for level in levels)), members


def best_effort(df: DataFrame, columns: list[str], targets: DataFrame, names: list[str], id_col: str, active: str) -> DataFrame:
    """All texts must match together; no match gives null. Of several targets the active ones come first, then the highest id."""
    w = Window.partitionBy(*names).orderBy(F.col(active).desc(), F.col(id_col).desc())
    best = targets.withColumn("__n", F.row_number().over(w)).filter("__n = 1").select(*(F.col(n).alias(f"__{n}") for n in names), id_col)
    return df.join(best, [F.col(a) == F.col(f"__{b}") for a, b in zip(columns, names, strict=True)], "left").drop(*(f"__{n}" for n in names))


def get_or_create(values: DataFrame, existing: DataFrame, key: str | list[str], id_col: str) -> DataFrame:
    """The dimension with the keys that it lacked; new ids go on from the highest, in the order of the keys. null is a member too."""
    keys = [key] if isinstance(key, str) else key
    known = existing.select(*(F.col(k).alias(f"__{k}") for k in keys))
    fresh = values.select(*keys).distinct().join(known, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_anti")
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    made = new_ids(fresh, keys, 0, "__id").select((top + F.col("__id")).alias(id_col), *keys)
    return existing.select(id_col, *keys, F.lit(False).alias("created")).unionByName(made.select(F.col(id_col).cast(existing.schema[id_col].dataType), *keys, F.lit(True).alias("created")))


def unmatched(staged: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """Staged rows that no step of the plan speaks for, null keys among them."""
    known = plan.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    return staged.join(known, [F.col(k) == F.col(f"__{k}") for k in keys], "left_anti")


def latest_per(df: DataFrame, keys: list[str], value: Column, order: list[str], name: str) -> DataFrame:
    """The value of the row with the highest order, without sorting groups."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(name))


def orphans(children: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    return children.join(parents.select(*keys).distinct(), keys, "left_anti")


def unused(catalogue: DataFrame, key: str, *users: tuple[DataFrame, str]) -> DataFrame:
    """Catalogue rows that no other table refers to."""
    for df, column in users:
        catalogue = catalogue.join(df.select(F.col(column).alias(key)).filter(F.col(key).isNotNull()), key, "left_anti")
    return catalogue


def required(df: DataFrame, *columns: str) -> DataFrame:
    """``missing``: which of the columns are null or blank, comma-joined."""
    absent = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in columns]
    return df.withColumn("missing", F.array_join(F.array_compact(F.array(*absent)), ","))
