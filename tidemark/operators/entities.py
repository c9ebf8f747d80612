"""From staged sheets to entities, each as one projection with its errors; entities read back with their catalogues as text; their orders."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..sources import contracts

#: Texts of an attribute that hold only where it is personal data.
PERSONAL = ("categoria_nivel_1", "tipo_dato", "sensibilidad")
FLAGS = ("reporte", "proyecto", "proceso", "estructura")
#: States of plans in their order.
PLAN_STATES = ("alertado", "en proceso", "finalizado")
NO_DATE = "9999"


def with_errors(df: DataFrame, values: dict[str, Column], errors: list[Column]) -> DataFrame:
    """The values, and ``errors``: what is wrong with the row, joined by ``; ``."""
    return df.select(*(c.alias(k) for k, c in values.items()), F.concat_ws("; ", *errors).alias("errors"))


def missing(*columns: str) -> list[Column]:
    return [F.when(C.text_or_null(F.col(c)).isNull(), F.concat(F.lit("missing: "), F.lit(c))) for c in columns]


def attributes(staged: DataFrame) -> DataFrame:
    """The 18 declared columns, typed; texts about personal data are null unless the flag says Sí."""
    code, code_error = C.tolerant_int(F.col("codigo_atributo"))
    personal, personal_error = C.yes_no(F.col("es_dato_personal"))
    date, date_error = C.declared_date(F.col("fecha_aprobada"), contracts.STORED)
    values, errors = {"codigo_dominio": C.strip(F.col("codigo_dominio")), "codigo_atributo": code}, [code_error, personal_error, date_error]
    for c in contracts.ATTRIBUTES.columns[2:]:
        values[c] = C.text_or_null(F.col(c))
    for c in FLAGS:
        values[c], error = C.x_flag(F.col(c))
        errors.append(error)
    for c in PERSONAL:
        values[c] = F.when(personal, values[c])
    values |= {"es_dato_personal": personal, "fecha_aprobada": date}
    return with_errors(staged, values, errors)


def official_sources(staged: DataFrame) -> DataFrame:
    """One primary source a row; field and length stay as stripped texts, blank marker included."""
    date, date_error = C.any_date(F.col("fecha_aprobada"))
    nulls, nulls_error = C.yes_no(F.col("acepta_valores_nulos"))
    plain = ("codigo_dominio_atributo", "nombre_campo_fuente_oficial", "longitud_campo_fuente_oficial")
    values = {c: C.strip(F.col(c)) if c in plain else C.text_or_null(F.col(c)) for c in contracts.OFFICIAL_SOURCES.columns}
    return with_errors(staged, values | {"acepta_valores_nulos": nulls, "fecha_aprobada": date, "primaria": F.lit(True)}, [date_error, nulls_error])


def consumption(staged: DataFrame) -> DataFrame:
    """Exact repeats are one row; a key with several dates, or without a destination, is an error."""
    date, date_error = C.declared_date(F.col("fecha_aprobada"), contracts.STORED)
    keys = list(contracts.CONSUMPTION.columns[:-1])
    typed = with_errors(staged, {c: C.text_or_null(F.col(c)) for c in keys} | {"fecha_aprobada": date}, [*missing(*contracts.CONSUMPTION.columns[2:-1]), date_error])
    day = F.coalesce(F.col("fecha_aprobada").cast("string"), F.lit(""))
    one = typed.groupBy(*keys).agg(F.max("fecha_aprobada").alias("fecha_aprobada"), F.count_distinct(day).alias("n"), F.max("errors").alias("e"))
    several = F.when(F.col("n") > 1, F.lit("several dates"))
    return one.select(*keys, F.when(F.col("n") == 1, F.col("fecha_aprobada")).alias("fecha_aprobada"), F.array_join(F.array_compact(F.array(F.nullif("e", F.lit("")), several)), "; ").alias("errors"))


def paired(staged: DataFrame, contract: contracts.Contract) -> DataFrame:
    """Sheets whose rows need two columns: research, responsibles, evidence and plans. Dates are typed as declared."""
    values, errors = {c: C.text_or_null(F.col(c)) for c in contract.columns}, missing(*contracts.PAIRS[contract.name])
    for c, declared in contract.dates.items():
        values[c], error = C.declared_date(F.col(c), declared)
        errors.append(error)
    return with_errors(staged, values, errors)


def typed(rows: DataFrame, contract: contracts.Contract) -> DataFrame:
    """A scanned sheet with its contract's types: whole numbers and declared dates, all else as text, and ``errors``."""
    values, errors = {c: C.text_or_null(F.col(f"`{c}`")) for c in contract.columns}, []
    for c in contract.whole:
        values[c], error = C.tolerant_int(F.col(f"`{c}`"))
        errors.append(error)
    for c, declared in contract.dates.items():
        values[c], error = C.declared_date(F.col(f"`{c}`"), declared)
        errors.append(error)
    return with_errors(rows, values, errors) if errors else rows.select(*(c.alias(k) for k, c in values.items()), F.lit("").alias("errors"))


def star(facts: DataFrame, lookups: list[tuple[str, DataFrame, str, str, str]], by: tuple[str, ...] = ()) -> DataFrame:
    """Ids as texts. A lookup: the facts' column, the catalogue, its id, its text, the name of the text; unknown ids give null.

    Lookups that follow each other by the same column in the same catalogue are one join. Facts without an id are dealt out by their other
    columns, so they don't meet in one task however many they are. by: columns that tell most facts apart and are enough for that; then
    columns that nobody reads aren't kept for it.
    """
    for (column, _, id_col), some in groupby(lookups, lambda x: (x[0], id(x[1]), x[2])):
        some = list(some)
        # 0 for every known id, which the optimizer must not see: it would take this half of the key away
        known = some[0][1].select(F.col(id_col).alias("__id"), F.pmod(F.xxhash64(id_col), F.lit(1).cast("bigint")).alias("__zero"), *(F.col(text).alias(name) for _, _, _, text, name in some))
        rest = [F.col(f"`{f.name}`") for f in facts.schema if (f.name in by if by else "map<" not in f.dataType.simpleString())]
        # told where rows are dealt out, and not sent along
        deal = F.when(F.col(column).isNull(), F.xxhash64(*rest)).otherwise(F.lit(0).cast("bigint"))
        facts = facts.join(known, (F.col(column) == F.col("__id")) & (deal == F.col("__zero")), "left").drop("__id", "__zero")
    return facts


def model(entities: dict[str, DataFrame], domain: str = "domain") -> DataFrame:
    """entity, domain, fields (JSON): all active rows of all entities, for all domains at once."""
    rows = [df.select(F.lit(name).alias("entity"), F.col(domain).cast("string").alias("domain"), F.to_json(F.struct(*(c for c in df.columns if c != domain)), {"ignoreNullFields": "false"}).alias("fields")) for name, df in entities.items()]
    return reduce(DataFrame.unionByName, rows)


def compliance(domains: DataFrame, consumption: DataFrame, evidence: DataFrame, terms: DataFrame, links: DataFrame) -> DataFrame:
    """domain, whether it has consumption, evidence, terms, and no pending link (null without links). links: domain, resolved."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("domain").agg(F.count("*").alias(name))

    parts = [counted(consumption, "n_consumption"), counted(evidence, "n_evidence"), counted(terms, "n_terms")]
    told = reduce(lambda a, b: a.join(b, "domain", "left"), parts, domains).na.fill(0, ["n_consumption", "n_evidence", "n_terms"])
    linked = links.groupBy("domain").agg(F.count_if("resolved").alias("n_resolved"), F.count_if(~F.col("resolved")).alias("n_pending"))
    flags = {"has_consumption": F.col("n_consumption") > 0, "has_evidence": F.col("n_evidence") > 0, "has_terms": F.col("n_terms") > 0, "links_complete": F.col("n_pending") == 0}
    return told.join(linked, "domain", "left").withColumns(flags)


def section_counts(domains: DataFrame, sections: dict[str, DataFrame]) -> DataFrame:
    """A row a domain with the number of rows of each section, and a row without domain with the totals."""
    rows = reduce(DataFrame.unionByName, (df.select("domain", F.lit(name).alias("section")) for name, df in sections.items()))
    counts = rows.groupBy("domain").pivot("section", list(sections)).agg(F.count(F.lit(1)))
    told = domains.join(counts, "domain", "left").na.fill(0, list(sections))
    return told.unionByName(told.agg(F.lit(None).cast(domains.schema["domain"].dataType).alias("domain"), *(F.sum(s).alias(s) for s in sections)))


def details(chosen: DataFrame, keys: list[str], details: dict[str, DataFrame]) -> DataFrame:
    """section, keys, detail: rows of the detail tables that belong to the chosen attributes."""
    rows = [df.join(chosen.select(*keys), keys, "left_semi").select(F.lit(name).alias("section"), *keys, "detail") for name, df in details.items()]
    return reduce(DataFrame.unionByName, rows)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """value, n: the distinct values; null and blank are one row without value."""
    return df.groupBy(C.text_or_null(F.col(key)).alias("value")).agg(F.count("*").alias("n"))


def plan_order(state: Column, due: Column, *codes: Column) -> list[Column]:
    """Alerted, in progress, finished, others; then by date, none last; then codes by number."""
    rank = F.array_position(F.array(*map(F.lit, PLAN_STATES)), F.coalesce(C.fold_spaces(state), F.lit("")))
    return [F.when(rank > 0, rank).otherwise(len(PLAN_STATES) + 1), F.coalesce(F.date_format(due, "yyyy-MM-dd"), F.lit(NO_DATE)), *(C.natural_key(F.coalesce(c, F.lit(""))) for c in codes)]


def source_order(primary: Column, *texts: Column) -> list[Column]:
    """Primary sources first, then by texts."""
    return [~F.coalesce(primary, F.lit(False)), *(F.coalesce(c, F.lit("")) for c in texts)]


def any_order(c: Column, numeric: bool, descending: bool = False) -> list[Column]:
    """Numbers by value, other columns by folded text and natural number; null last."""
    keys = [c] if numeric else [C.natural_key(C.fold(c))]
    return [c.isNull(), *(k.desc() if descending else k.asc() for k in keys)]


def plans(staged: DataFrame) -> DataFrame:
    """Plans as ``paired`` has them, with their progress as a whole number and their code as domain and attribute."""
    told = paired(staged, contracts.PLANS)
    progress, progress_error = C.tolerant_int(F.col("avance"))
    domain, attribute, code_error = C.code_parts(F.col("codigo_dominio_atributo"))
    errors = F.array_join(F.array_compact(F.array(F.nullif("errors", F.lit("")), progress_error, code_error)), "; ")
    return told.withColumns({"errors": errors, "avance": progress, "codigo_dominio": domain, "codigo_atributo": attribute})


#: Fixed value: the class of research that is a glossary's term.
TERM = "termino"


def is_term(classification: Column) -> Column:
    return F.coalesce(F.trim(C.fold(classification)) == TERM, F.lit(False))


def with_terms(sections: dict[str, DataFrame], research: DataFrame, classification: str = "classification") -> dict[str, DataFrame]:
    """Sections to be counted, research being two of them: terms and all else."""
    return sections | {"research": research.filter(~is_term(F.col(classification))), "terms": research.filter(is_term(F.col(classification)))}


def text_order(*texts: Column) -> list[Column]:
    """By texts, missing ones as empty."""
    return [F.coalesce(t, F.lit("")) for t in texts]


def responsible_order(role: Column, area: Column, place: Column) -> list[Column]:
    return text_order(role, area, place)


def evidence_order(kind: Column, link: Column) -> list[Column]:
    return text_order(kind, link)


def research_order(classification: Column, name: Column) -> list[Column]:
    """Names whatever their case."""
    return text_order(classification, F.lower(name))


def consumption_order(kind: Column, *path: Column) -> list[Column]:
    return text_order(kind, *path)


def relation_details(chosen: DataFrame, links: DataFrame) -> DataFrame:
    """direction, domain, code, other_domain, other, state: links that the chosen attributes declare (uses), and links of others that name
    one of them inside its domain (used by), case and accents apart.

    chosen: domain, code, name. links: origin_domain, origin_code, origin_name, target_domain, target_name, state.
    """
    own = chosen.select("domain", "code", F.trim(C.fold(F.col("name"))).alias("__name"))
    uses = links.join(own.select("domain", "code"), (F.col("origin_domain") == F.col("domain")) & (F.col("origin_code") == F.col("code")))
    uses = uses.select(F.lit("uses").alias("direction"), "domain", "code", F.col("target_domain").alias("other_domain"), F.col("target_name").alias("other"), "state")
    named = own.groupBy("domain", "__name").agg(F.max("code").alias("code"))
    used = links.join(named, (F.col("target_domain") == F.col("domain")) & (F.trim(C.fold(F.col("target_name"))) == F.col("__name")))
    used = used.select(F.lit("used by").alias("direction"), "domain", "code", F.col("origin_domain").alias("other_domain"), F.concat(F.col("origin_code").cast("string"), F.lit(" · "), F.col("origin_name")).alias("other"), "state")
    return uses.unionByName(used)
