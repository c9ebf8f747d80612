"""Quality scores, coverage, person grouping, explorer rows and remediation-plan measures, all domains at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import MARKED, fold, fold_spaces, overdue, percent, progress_bucket, strip
from ..functions.clean import PLAIN as PLAIN_LETTERS
from .paging import Pages

#: Points that an attribute without official source costs.
PENALTIES = {"critical_structure": 5, "critical": 3, "other": 1}
REQUIRED_ROLES = (1, 2, 3, 4)


def penalty_class(critical: Column, structure: Column, has_source: Column) -> Column:
    return F.when(has_source, "none").when(critical & structure, "critical_structure").when(critical, "critical").otherwise("other")


def points(category: Column) -> Column:
    return reduce(lambda c, kv: c.when(category == kv[0], kv[1]), PENALTIES.items(), F.when(category == "none", 0))


def domain_scores(attributes: DataFrame, domains: DataFrame) -> DataFrame:
    """Every domain: counts and points by class, score (0 to 100; null without attributes), coverage. attributes: domain, critical,
    structure, has_source."""
    told = attributes.withColumn("category", penalty_class(F.col("critical"), F.col("structure"), F.col("has_source"))).withColumn("points", points(F.col("category")))
    g = told.groupBy("domain").agg(
        F.count("*").alias("n_attributes"), F.sum("points").alias("penalty"),
        *(F.count_if(F.col("category") == k).alias(f"n_{k}") for k in PENALTIES),
        F.count_if(F.col("critical")).alias("n_all_critical"), F.count_if(F.col("critical") & F.col("has_source")).alias("n_covered_critical"), F.count_if(F.col("has_source")).alias("n_covered"),
    )
    g = g.withColumns({"score": F.greatest(F.lit(0), 100 - F.col("penalty")), "coverage": percent(F.col("n_covered"), F.col("n_attributes")), "critical_coverage": percent(F.col("n_covered_critical"), F.col("n_all_critical"))})
    counts = ["n_attributes", "penalty", *(f"n_{k}" for k in PENALTIES), "n_all_critical", "n_covered_critical", "n_covered"]
    return domains.select("domain").join(g, "domain", "left").na.fill(0, counts)


def penalised(attributes: DataFrame) -> DataFrame:
    told = attributes.withColumn("category", penalty_class(F.col("critical"), F.col("structure"), F.col("has_source"))).withColumn("points", points(F.col("category")))
    return told.filter("points > 0")


def portfolio(scores: DataFrame, good: int = 90) -> DataFrame:
    """One row over all domains; the mean takes evaluated ones only."""
    return scores.agg(
        F.count("*").alias("n_domains"), F.count("score").alias("n_evaluated"), F.bround(F.avg("score"), 1).alias("mean_score"), F.sum("n_attributes").alias("n_attributes"),
        F.sum("penalty").alias("penalty"), F.count_if(F.col("score") >= good).alias("n_good"), percent(F.sum("n_covered"), F.sum("n_attributes")).alias("coverage"),
    )


def missing_roles(people: DataFrame, domains: DataFrame, roles: tuple[int, ...] = REQUIRED_ROLES) -> DataFrame:
    """domain, missing_roles (comma-joined), complete. Null and unknown roles don't count."""
    have = people.filter(F.col("role_id").isin(*roles)).groupBy("domain").agg(F.collect_set("role_id").alias("have"))
    wanted = F.array(*(F.lit(r) for r in roles))
    gone = F.array_except(wanted, F.coalesce("have", F.array().cast("array<int>")))
    return domains.select("domain").join(have, "domain", "left").select("domain", F.array_join(gone.cast("array<string>"), ",").alias("missing_roles"), (F.size(gone) == 0).alias("complete"))


def role_columns(people: DataFrame, roles: tuple[int, ...] = REQUIRED_ROLES) -> DataFrame:
    """One row a domain, one column a role: its distinct names, sorted and joined; other roles share a column."""
    names = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("name")))), " | ")
    return people.groupBy("domain").agg(*(names(F.col("role_id") == r).alias(f"role_{r}") for r in roles), names(F.col("role_id").isNull() | ~F.col("role_id").isin(*roles)).alias("other_roles"))


def persons(people: DataFrame) -> DataFrame:
    """One row a person, by folded name: preferred spelling (most frequent, then most accents, then mixed case, then the last in order),
    assignments, domains. Rows without a name belong to nobody."""
    named = people.withColumn("person", fold_spaces(F.col("name"))).filter("person <> ''")
    spelt = named.groupBy("person", "name").agg(F.count("*").alias("n"))
    accents = F.length("name") - F.length(F.translate("name", MARKED, ""))
    mixed = (F.upper("name") != F.col("name")) & (F.lower("name") != F.col("name"))
    best = spelt.groupBy("person").agg(F.max_by("name", F.struct("n", accents, mixed, "name")).alias("spelling"), F.sum("n").alias("n_assignments"))
    sets = named.groupBy("person").agg(F.count_distinct("domain").alias("n_domains"), F.array_join(F.array_sort(F.collect_set(F.col("domain").cast("string"))), ",").alias("domains"))
    return best.join(sets, "person")


def gap_histogram(df: DataFrame, column: str) -> DataFrame:
    """value, n from 1 to the highest value, values that nobody has included."""
    counts = df.groupBy(F.col(column).cast("long").alias("value")).agg(F.count("*").alias("n"))
    steps = counts.agg(F.max("value").alias("top")).filter("top >= 1").select(F.explode(F.sequence(F.lit(1).cast("long"), "top")).alias("value"))
    return steps.join(counts, "value", "left").na.fill(0, ["n"])


def facets(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, value, n over all rows; null and empty are one value."""
    told = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value")) for f in fields)))
    return df.select(told.alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


def faceted(df: DataFrame, chosen: dict[str, list[str]]) -> DataFrame:
    """And across fields, or inside a field; the empty text can be chosen."""
    for field, values in chosen.items():
        df = df.filter(F.coalesce(F.col(field).cast("string"), F.lit("")).isin(*values))
    return df


def text_search(df: DataFrame, words: str, columns: list[str]) -> DataFrame:
    """Rows whose joined texts contain every word, accents and case apart."""
    everything = fold(F.concat_ws(" ", *columns))
    for w in words.split():
        df = df.filter(F.contains(everything, fold(F.lit(w))))
    return df


def any_field(df: DataFrame, part: str, columns: list[str]) -> DataFrame:
    """Rows of which some field contains the text, case apart (accents count)."""
    return df.filter(reduce(lambda a, b: a | b, (F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(part.lower())) for c in columns)))


def page(df: DataFrame, order: list[Column], number: int, size: int = 100) -> DataFrame:
    """One page of the ordered rows, numbered from 1 and clamped to the last one. Keep ``Pages`` itself to turn more pages."""
    return Pages(df, order).page(number, size)


def plan_rows(plans: DataFrame, today: Column) -> DataFrame:
    """plans: domain, progress, due, state, linked_active, live_id. Adds bucket, overdue, without_live_attribute and previous_version."""
    return plans.withColumns({
        "bucket": progress_bucket(F.col("progress")), "overdue": overdue(F.col("due"), F.col("state"), today),
        "without_live_attribute": F.col("live_id").isNull(), "previous_version": F.col("live_id").isNotNull() & ~F.col("linked_active"),
    })


def plan_kpis(rows: DataFrame, *group: str) -> DataFrame:
    """Totals by group (or all): the mean progress takes present values, rounded half up."""
    finished = F.coalesce(fold(F.col("state")) == "finalizado", F.lit(False))
    return rows.groupBy(*group).agg(
        F.count("*").alias("n_plans"), F.count_distinct("domain").alias("n_domains"), F.floor(F.avg("progress") + 0.5).alias("mean_progress"), F.count_if(finished).alias("n_finished"),
        F.count_if(F.col("overdue")).alias("n_overdue"), F.count_if(F.col("previous_version")).alias("n_previous_version"), F.count_if(F.col("without_live_attribute")).alias("n_without_live"),
    )


def publish(rows: DataFrame, domains: DataFrame, masked: list[str], placeholder: str = "(confidential)") -> DataFrame:
    """Rows of published domains with ``state_class``: inactive domains' rows go, confidential domains' details are masked. Measures that
    count details are to be taken before."""
    told = rows.join(domains.select("domain", "state_class"), "domain").filter("state_class <> 'Inactivo'")
    hidden = F.col("state_class") == "Confidencial"
    return told.withColumns({c: F.when(hidden, placeholder).otherwise(F.col(c)) for c in masked})


def dropped_rows(domains: DataFrame, **entities: DataFrame) -> DataFrame:
    """entity, n_inactive_domain, n_unknown_domain: what publication leaves out."""
    out = []
    for name, df in entities.items():
        told = df.select("domain").join(domains.select("domain", "state_class"), "domain", "left")
        out.append(told.agg(F.lit(name).alias("entity"), F.count_if(F.col("state_class") == "Inactivo").alias("n_inactive_domain"), F.count_if(F.col("state_class").isNull()).alias("n_unknown_domain")))
    return reduce(DataFrame.unionByName, out)


def joined_texts(df: DataFrame, keys: list[str], order: list[str], text: str, separator: str = "; ", blank: str = "—") -> DataFrame:
    """keys, texts, n: the texts of each key in order, blanks shown."""
    listed = F.array_sort(F.collect_list(F.struct(*order, F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(blank)).alias("__t"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["__t"]), separator).alias("texts"), F.count("*").alias("n"))


def nested_model(parents: DataFrame, children: DataFrame, keys: list[str], fields: list[str], name: str) -> DataFrame:
    """Parents with their children as an array of structs, ordered by the fields."""
    packed = children.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
    return parents.join(packed, keys, "left")


def ranked(df: DataFrame, group: str, order: list[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def explored(df: DataFrame, chosen: dict[str, list[str]], order: list[Column], number: int, size: int = 100) -> tuple[DataFrame, DataFrame]:
    """One page of what the facets choose, and a record of the filters with the number of rows and domains found."""
    found = faceted(df, chosen)
    record = "; ".join(f"{k}: {', '.join(v)}" for k, v in chosen.items())
    header = found.agg(F.count("*").alias("n_rows"), F.count_distinct("domain").alias("n_domains")).withColumn("filters", F.lit(record))
    return page(found, order, number, size), header


def groupings(df: DataFrame, columns: list[str]) -> DataFrame:
    """grouping, value, n, n_overdue: the charts of plans."""
    told = F.explode(F.array(*(F.struct(F.lit(c).alias("grouping"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns)))
    return df.select(told.alias("x"), "overdue").groupBy("x.grouping", "x.value").agg(F.count("*").alias("n"), F.count_if("overdue").alias("n_overdue"))


HIDDEN = "(confidential)"
#: Parts of a source's path, and the columns that tell of its attribute.
PATH = ("server", "database", "table", "field")
PLAIN = ("name", "description", "criticality", "kind", "shared", "primary_name", "primary_domain", "personal", "personal_class", "report", "project", "process", "structure", "approved", "version")


def source_texts(sources: DataFrame, prefix: str, fields: tuple[str, ...], order: list[Column]) -> DataFrame:
    """One row an attribute (domain_id, code): n_<prefix>, the first one's path, and each field's texts in one order, blanks shown."""
    listed = F.sort_array(F.collect_list(F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)), *(F.coalesce(F.nullif(F.trim(f), F.lit("")), F.lit("")).alias(f"f_{f}") for f in fields))))
    g = sources.groupBy("domain_id", "code").agg(listed.alias("__all"), F.count("*").alias(f"n_{prefix}"))
    first = F.element_at("__all", 1)
    path = F.array_join(F.filter(F.array(*(first[f"f_{f}"] for f in PATH)), lambda t: t != ""), " / ")
    shown = lambda f: F.transform(F.col(f"__all.f_{f}"), lambda t: F.when(t == "", "—").otherwise(t))
    texts = {f"{prefix}_{f}": F.array_join(shown(f), " | ") for f in fields}
    return g.select("domain_id", "code", f"n_{prefix}", path.alias(f"{prefix}_path"), *(c.alias(k) for k, c in texts.items()))


def wide_rows(attributes: DataFrame, domains: DataFrame, official: DataFrame, consumption: DataFrame, links: DataFrame, people: DataFrame, roles: tuple[int, ...] = REQUIRED_ROLES, unique_codes: bool = False) -> DataFrame:
    """One wide row an attribute of published domains: its domain, its own columns (PLAIN), link state, sources of both kinds with counts
    and joined texts, points, one column a role, and ``search``, the folded text of all that can be searched.

    attributes, official, consumption: domain_id, code and theirs; domains: domain_id, domain, domain_name, state_class; links: id (the
    attribute's code), state; people: domain (its domain_id), role_id, name. Details of confidential domains' sources are hidden; where an
    attribute has none, the text is empty there too, and counts and points are the true ones. unique_codes: few codes are in two domains, so
    rows meet by their code and need not be shuffled again if they lie by it; their domains are still compared.
    """
    by_path = [F.coalesce(F.col(f), F.lit("")) for f in PATH]
    fo = source_texts(official, "official", PATH, [~F.coalesce(F.col("primary"), F.lit(False)), *by_path])
    fc = source_texts(consumption, "consumption", ("class", *PATH), [F.coalesce(F.col("class"), F.lit("")), *by_path]).drop("consumption_path")
    role_names = [*(f"role_{r}" for r in roles), "other_roles"]
    joined = lambda cs: F.nullif(F.concat_ws(" ", *(F.nullif(c, F.lit("")) for c in cs)), F.lit(""))
    plain = lambda c: F.lower(F.translate(c, MARKED, PLAIN_LETTERS))
    # a domain's names are folded once, and join rows that are shuffled no more: they grow with the domain's people
    names = role_columns(people, roles).withColumnRenamed("domain", "domain_id").withColumn("__names", plain(joined(map(F.col, role_names))))
    published = domains.filter("state_class <> 'Inactivo'").select("domain_id", "domain", "domain_name", "state_class")
    rows = attributes.join(F.broadcast(published), "domain_id")
    for sources in (fo, fc):
        theirs = sources.withColumnsRenamed({"domain_id": "__domain", "code": "__code"})
        # equal domains in a form that is no key, as Spark shuffles by all keys or none
        same = (F.col("domain_id") <= F.col("__domain")) & (F.col("domain_id") >= F.col("__domain")) if unique_codes else F.col("domain_id") == F.col("__domain")
        rows = rows.join(theirs, (F.col("code") == F.col("__code")) & same, "left").drop("__domain", "__code")
    rows = rows.join(links.select(F.col("id").alias("code"), F.col("state").alias("link_state")), "code", "left").na.fill(0, ["n_official", "n_consumption"])
    # rows of a domain follow each other while they are narrow: Parquet's codecs find what they repeat. The filter lets all rows through; without
    # it the optimizer drops a sort below a join
    rows = rows.sortWithinPartitions("domain_id").filter(F.spark_partition_id() >= 0)
    rows = rows.join(F.broadcast(names), "domain_id", "left")
    secret = F.col("state_class") == "Confidencial"
    hide = lambda c, n: F.when(secret, F.when(F.col(n) > 0, HIDDEN).otherwise("")).otherwise(F.coalesce(c, F.lit("")))
    critical = F.coalesce(fold_spaces(F.col("criticality")) == "critico", F.lit(False))
    told = {
        "full_code": F.concat_ws("-", "domain", F.col("code").cast("string")), "link_state": F.coalesce("link_state", F.lit("")),
        "has_official": F.when(F.col("n_official") > 0, "Sí").otherwise("No"), "has_consumption": F.when(F.col("n_consumption") > 0, "Sí").otherwise("No"),
        "points": points(penalty_class(critical, F.coalesce(F.col("structure") == "Sí", F.lit(False)), F.col("n_official") > 0)),
        "official_path": hide(F.col("official_path"), "n_official"), **{f"official_{f}": hide(F.col(f"official_{f}"), "n_official") for f in PATH},
        **{f"consumption_{f}": hide(F.col(f"consumption_{f}"), "n_consumption") for f in ("class", *PATH)},
    }
    rows = rows.withColumns(told)
    before = plain(joined(map(F.col, ("full_code", "name", "description", "primary_name", "primary_domain", "kind", "personal_class"))))
    after = plain(joined(F.col(c) for c in rows.columns if c.startswith(("official_", "consumption_")) and c != "official_path"))
    rows = rows.withColumns({"__before": F.regexp_replace(before, r"^\s+", ""), "__after": F.regexp_replace(after, r"\s+$", "")})
    # spaces at the ends go: in the short parts where there are both, else in all of it
    whole = F.concat_ws(" ", F.nullif("__before", F.lit("")), "__names", F.nullif("__after", F.lit("")))
    rows = rows.withColumn("search", F.when((F.col("__before") != "") & (F.col("__after") != ""), whole).otherwise(strip(whole)))
    sources = ["has_official", "n_official", "official_path", *(f"official_{f}" for f in PATH), "has_consumption", "n_consumption", "consumption_class", *(f"consumption_{f}" for f in PATH)]
    return rows.select("domain", "domain_name", "state_class", "full_code", "code", *PLAIN, "link_state", *sources, "points", *role_names, "search")
