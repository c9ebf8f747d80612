"""Cleaning and scalar rules as column expressions. A rule that can fail gives a pair (value, error): the error is null where all is well."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

Rule = tuple[Column, Column]


def _accents() -> tuple[str, str]:
    """Latin letters with marks and the letters below the marks, from their decompositions."""
    marked = [chr(c) for c in range(0xC0, 0x250) if len(unicodedata.normalize("NFD", chr(c))) > 1]
    return "".join(marked), "".join(unicodedata.normalize("NFD", c)[0] for c in marked)


MARKED, PLAIN = _accents()


#: Fixed value: white space as ``\s`` has it.
SPACE = " \t\n\x0b\f\r"


def strip(c: Column) -> Column:
    """Without white space at both ends (tabs and line breaks too)."""
    return F.btrim(c, F.lit(SPACE))


def once(c: Column, rule: Callable[[Column], Column]) -> Column:
    """rule(c) with one mention of c: a filter on a rule is pushed below the projections that make c, and would make it at every mention."""
    return F.transform(F.array(c), rule)[0]


def text_or_null(c: Column) -> Column:
    """Stripped text; empty texts and the blank marker ``-`` are null."""
    return F.nullif(F.nullif(strip(c), F.lit("")), F.lit("-"))


def fold(c: Column) -> Column:
    """Without marks, lower case, stripped: for comparisons that ignore case and accents."""
    return F.lower(F.translate(strip(c), MARKED, PLAIN))


def fold_spaces(c: Column) -> Column:
    return F.regexp_replace(fold(c), r"\s+", " ")


def nfc(c: Column) -> Column:
    """Canonical composition; Spark has no function for it."""

    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return F.pandas_udf(compose, StringType())(c)


def header_name(c: Column) -> Column:
    return F.regexp_replace(strip(nfc(c)), r"\s+", " ")


def x_flag(c: Column) -> Rule:
    """``X`` is true; ``-``, empty and null are false; anything else is an error."""
    s = strip(F.coalesce(c, F.lit("")))
    value = F.when(s == "X", True).when(s.isin("-", ""), False)
    return value, F.when(value.isNull(), F.concat(F.lit("flag is neither X nor -: "), s))


def yes_no(c: Column) -> Rule:
    """Sí or No, whatever the case and accent; anything else, null too, is an error."""
    said = F.coalesce(c, F.lit(""))
    value = lambda x: F.when(fold(x) == "si", True).when(fold(x) == "no", False)
    return once(said, value), once(said, lambda x: F.when(value(x).isNull(), F.concat(F.lit("neither Sí nor No: "), x)))


def tolerant_int(c: Column) -> Rule:
    """Whole numbers, also written with decimals (cut off); blank markers and names of nothing are null."""
    s = strip(c)
    said = F.when(~F.coalesce(s, F.lit("")).isin("", "-", "<NA>", "nan", "None"), s)
    number = F.expr("1") * said.try_cast("double")
    value = F.when(F.abs(number) < 2147483648, F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))).cast("int")
    return value, F.when(said.isNotNull() & value.isNull(), F.concat(F.lit("no whole number: "), said))


def code_parts(c: Column) -> tuple[Column, Column, Column]:
    """domain, number and error of a code such as ``ADS-4``, cut at its last hyphen."""
    s = strip(c)
    domain = F.nullif(F.regexp_extract(s, r"^(.*)-([^-]*)$", 1), F.lit(""))
    number = strip(F.regexp_extract(s, r"^(.*)-([^-]*)$", 2))
    number = F.when(number.rlike(r"^[+-]?\d+$"), number.try_cast("int"))
    return domain, number, F.when(s.isNotNull() & (domain.isNull() | number.isNull()), F.concat(F.lit("no domain-number code: "), s))


def leading_code(c: Column, levels: int = 1) -> Rule:
    """``6.`` at one level, ``6.1.`` at two, in front of a text; null stays null, a text without it is an error."""
    pattern = r"^(\d+)\." if levels == 1 else r"^(\d+\.\d+)\."
    found = F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    return found, F.when(c.isNotNull() & found.isNull(), F.concat(F.lit("no leading code: "), c))


#: The forms in which dates arrive, in the order in which they are tried.
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "d-M-yyyy", "d/M/yyyy")


def shape(declared: str) -> str | None:
    """A pattern that every text of a format of numbers matches; None for formats with other parts. Single letters take any number of
    digits, year letters theirs or more, other runs just theirs; a sign is let through, as the format itself judges."""
    def part(run: re.Match) -> str:
        n = len(run[0])
        return r"[+-]?\d+" if n == 1 else rf"[+-]?\d{{{n},}}" if run[0][0] == "y" else rf"\d{{{n}}}"

    return f"^{re.sub(r'([yMdHms])\1*', part, declared)}$" if not re.search(r"[^yMdHms/: -]|([MdHms])\1\1|(?<!y)y{1,3}(?!y)|y{5}", declared) else None


def any_date(c: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Rule:
    """The first format that fits; a text that fits none is an error. Only formats whose shape the text has are tried: a failure costs far
    more than a date."""
    def tried(x: Column) -> Column:
        fits = lambda f: F.try_to_timestamp(x, F.lit(f))
        return F.coalesce(*(F.when(x.rlike(p), fits(f)) if (p := shape(f)) else fits(f) for f in formats)).cast("date")

    s = once(c, text_or_null)
    return once(s, tried), once(s, lambda x: F.when(x.isNotNull() & tried(x).isNull(), F.concat(F.lit("no date: "), x)))


def declared_date(c: Column, declared: str, stored: str = "yyyy-MM-dd HH:mm:ss", local: str = "d/M/yyyy") -> Rule:
    """The declared format and exactly one other: the local one for columns stored as dates, else the stored one."""
    return any_date(c, (declared, local if declared == stored else stored))


def canonical(c: Column, kind: str) -> Column:
    """One text for any value: null is empty, flags Sí or No, whole days without time, numbers without trailing zeros."""
    if kind == "boolean":
        text = F.when(c, "Sí").otherwise("No")
        return F.when(c.isNull(), "").otherwise(text)
    if kind == "date":
        return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    if kind.startswith("timestamp"):
        return F.coalesce(F.when(F.date_trunc("day", c) == c, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss")), F.lit(""))
    if kind.startswith("decimal") or kind in ("double", "float"):
        plain = (c if kind.startswith("decimal") else c.cast("decimal(38,10)")).cast("string")
        return F.coalesce(F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", ""), F.lit(""))
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def join_present(separator: str, *columns: Column) -> Column:
    return F.concat_ws(separator, *(F.nullif(strip(c), F.lit("")) for c in columns))


def cut(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def semver(c: Column) -> Rule:
    """(major, minor, patch) compares as numbers; anything else is an error."""
    ok = c.rlike(r"^\d+\.\d+\.\d+$")
    parts = F.split(c, r"\.")
    value = F.when(ok, F.struct(*(parts[k].try_cast("int").alias(n) for k, n in enumerate(("major", "minor", "patch")))))
    return value, F.when(~F.coalesce(ok, F.lit(False)), F.concat(F.lit("no version: "), F.coalesce(c, F.lit(""))))


def progress_bucket(c: Column) -> Column:
    return (
        F.when(c.isNull(), "no data").when(c <= 0, "0 %").when(c <= 25, "1-25 %").when(c <= 50, "26-50 %")
        .when(c <= 75, "51-75 %").when(c < 100, "76-99 %").otherwise("100 %")
    )


def overdue(due: Column, state: Column, today: Column) -> Column:
    return F.coalesce((due < today) & (F.coalesce(fold(state), F.lit("")) != "finalizado"), F.lit(False))


def initial(c: Column) -> Column:
    first = F.upper(F.substring(fold(c), 1, 1))
    return F.when(first.rlike("^[A-Z]$"), first).otherwise("#")


def percent(part: Column, whole: Column) -> Column:
    """One decimal, ties to even; null for nothing."""
    return F.when(whole > 0, F.bround(100 * part / whole, 1))


def state_class(c: Column) -> Column:
    """Publication states: empty or active, inactive, and all others confidential."""
    s = fold(F.coalesce(c, F.lit("")))
    return F.when(s.isin("", "activo"), "Activo").when(s == "inactivo", "Inactivo").otherwise("Confidencial")


def natural_key(c: Column) -> Column:
    """Sorts digit strings first, by number, then texts without case."""
    digits = c.rlike("^[0-9]+$")
    return F.struct(F.when(digits, 0).otherwise(1).alias("kind"), F.when(digits, c.try_cast("decimal(38,0)")).alias("number"), F.lower(c).alias("text"))


def chunk_key(c: Column) -> Column:
    """Sorts CAC-9 before CAC-10: digit runs count as numbers (up to 20 digits)."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\d+$"), F.lpad(r, 20, "0")).otherwise(r)), "")


def dotted_key(c: Column) -> Column:
    """Sorts 2.9. before 2.10.: the numbers between the dots."""
    return F.transform(F.split(c, r"\."), lambda x: x.try_cast("int"))
