"""Checks of submitted sheets: errors are rows, and what has errors is left out as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import text_or_null


def errors_of(df: DataFrame, rules: dict[str, Column], group: list[str], row_no: str) -> DataFrame:
    """group, row_no, column, message: one row for each rule that failed in a row."""
    told = F.explode(F.array_compact(F.array(*(F.when(e.isNotNull(), F.struct(F.lit(c).alias("column"), e.alias("message"))) for c, e in rules.items()))))
    return df.select(*group, row_no, told.alias("e")).select(*group, row_no, "e.*")


def required_values(df: DataFrame, columns: list[str], group: list[str], row_no: str, shown: int = 20) -> DataFrame:
    """group, row_no, missing and n_more: the first rows with blanks in required columns, and how many more there are."""
    missing = F.array_compact(F.array(*(F.when(text_or_null(F.col(c).cast("string")).isNull(), F.lit(c)) for c in columns)))
    bad = df.select(*group, row_no, F.array_join(missing, ",").alias("missing")).filter("missing <> ''")
    w = Window.partitionBy(*group)
    ranked = bad.withColumns({"rank": F.row_number().over(w.orderBy(row_no)), "n_bad": F.count("*").over(w)})
    return ranked.filter(F.col("rank") <= shown).select(*group, row_no, "missing", F.greatest(F.col("n_bad") - shown, F.lit(0)).alias("n_more"))


def inherited_key(sheets: DataFrame, anchor: DataFrame, file: str, key: str) -> DataFrame:
    """Sheets without the key get the one of their file's anchor sheet; ``key_error`` where the anchor has none or several."""
    keys = anchor.groupBy(file).agg(F.collect_set(text_or_null(F.col(key))).alias("keys"))
    told = sheets.join(keys, file, "left")
    n = F.coalesce(F.size("keys"), F.lit(0))
    return told.withColumns({key: F.when(n == 1, F.col("keys")[0]), "key_error": F.when(n == 0, "no key in the anchor sheet").when(n > 1, "several keys in the anchor sheet")}).drop("keys")


def isolated(df: DataFrame, errors: DataFrame, unit: list[str]) -> DataFrame:
    """Without the (file, sheet) units that have errors; the others go on."""
    return df.join(errors.select(*unit).distinct(), unit, "left_anti")


def unit_results(df: DataFrame, errors: DataFrame, unit: list[str]) -> DataFrame:
    """unit, n_rows, n_errors, first_error of each unit."""
    rows = df.groupBy(*unit).agg(F.count("*").alias("n_rows"))
    bad = errors.groupBy(*unit).agg(F.count("*").alias("n_errors"), F.min("message").alias("first_error"))
    return rows.join(bad, unit, "full_outer").na.fill(0, ["n_rows", "n_errors"])


def width_audit(df: DataFrame, widths: dict[str, int], row_no: str, preview: int = 60) -> DataFrame:
    """column, width, longest, n_over, first_row, preview: texts against the widths of a target table."""
    told = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(w).alias("width"), F.col(c).cast("string").alias("value")) for c, w in widths.items())))
    long = df.select(row_no, told.alias("x")).select(row_no, "x.*")
    over = F.length("value") > F.col("width")
    first = F.min_by(F.struct(F.col(row_no).alias("r"), F.substring("value", 1, preview).alias("p")), F.when(over, F.col(row_no)))
    return long.groupBy("column", "width").agg(F.coalesce(F.max(F.length("value")), F.lit(0)).alias("longest"), F.count_if(over).alias("n_over"), first.alias("f")).select("column", "width", "longest", "n_over", F.when(F.col("n_over") > 0, F.col("f.r")).alias("first_row"), F.when(F.col("n_over") > 0, F.col("f.p")).alias("preview"))


def consistent_rows(df: DataFrame, keys: list[str], date: str) -> tuple[DataFrame, DataFrame]:
    """Exact repeats collapse; keys with several dates are errors. Gives (rows, errors)."""
    day = F.coalesce(F.col(date).cast("string"), F.lit(""))
    g = df.groupBy(*keys).agg(F.count_distinct(day).alias("n_dates"), F.max(date).alias(date))
    return g.filter("n_dates = 1").drop("n_dates"), g.filter("n_dates > 1").drop(date)
