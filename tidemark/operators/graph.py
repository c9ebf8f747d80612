"""Relations between domains: link states, edges, nodes and degrees, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import percent
from ..sources.sheets import kept

#: Fixed order of problems in reports.
PROBLEM_ORDER = ("BROKEN", "INCONSISTENT", "NO_LINK", "NO_TYPE", "SAME_DOMAIN")
DRAWN = ("RESOLVED", "TARGET_INACTIVE")
DONE = (*DRAWN, "SAME_DOMAIN")


def link_states(attributes: DataFrame, domains: DataFrame, all_attributes: DataFrame) -> DataFrame:
    """Each declaring attribute with its state, the first rule that fits.

    attributes: id, domain_id, type_id, primary_id, primary_domain_id (active ones); all_attributes: id, domain_id, active.
    """
    target = all_attributes.select(F.col("id").alias("primary_id"), F.col("domain_id").alias("target_domain"), F.col("active").alias("target_active"))
    named = domains.select(F.col("domain_id").alias("primary_domain_id"), F.lit(True).alias("domain_known"))
    told = attributes.filter("type_id is not null or primary_id is not null").join(target, "primary_id", "left").join(named, "primary_domain_id", "left")
    state = (
        F.when(F.col("primary_id").isNull() | F.col("primary_domain_id").isNull(), "NO_LINK")
        .when(F.col("target_active").isNull() | F.col("domain_known").isNull(), "BROKEN")
        .when(F.col("target_domain") != F.col("primary_domain_id"), "INCONSISTENT")
        .when(F.col("primary_domain_id") == F.col("domain_id"), "SAME_DOMAIN")
        .when(F.col("type_id").isNull(), "NO_TYPE")
        .when(~F.col("target_active"), "TARGET_INACTIVE")
        .otherwise("RESOLVED")
    )
    return told.select("id", "domain_id", "type_id", "primary_id", "primary_domain_id", state.alias("state"))


def edges(links: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """origin, target, type, n, n_inactive of the drawn links."""
    named = links.join(types, "type_id", "left") if types is not None else links.withColumn("type", F.col("type_id").cast("string"))
    drawn = named.filter(F.col("state").isin(*DRAWN)).withColumn("type", F.coalesce("type", F.lit("No type")))
    return drawn.groupBy(F.col("domain_id").alias("origin"), F.col("primary_domain_id").alias("target"), "type").agg(F.count("*").alias("n"), F.count_if(F.col("state") == "TARGET_INACTIVE").alias("n_inactive"))


def nodes(domains: DataFrame, links: DataFrame) -> DataFrame:
    """All domains, those that only links know included; degrees count distinct neighbours, n_unresolved links that are not drawn."""
    seen = links.select("domain_id").union(links.filter("primary_domain_id is not null").select("primary_domain_id")).distinct()
    every = domains.select("domain_id", F.lit(True).alias("known")).unionByName(seen.join(domains, "domain_id", "left_anti").select("domain_id", F.lit(False).alias("known")))
    drawn = links.filter(F.col("state").isin(*DRAWN)).select("domain_id", "primary_domain_id").distinct()
    out = drawn.groupBy("domain_id").agg(F.count("*").alias("n_out"))
    into = drawn.groupBy(F.col("primary_domain_id").alias("domain_id")).agg(F.count("*").alias("n_in"))
    open_links = links.filter(~F.col("state").isin(*DRAWN)).groupBy("domain_id").agg(F.count("*").alias("n_unresolved"))
    return every.join(out, "domain_id", "left").join(into, "domain_id", "left").join(open_links, "domain_id", "left").na.fill(0)


def problem_rank(state: Column) -> Column:
    """Place of a problem in reports; null for drawn links."""
    rank = F.array_position(F.array(*map(F.lit, PROBLEM_ORDER)), state)
    return F.when(~state.isin(*DRAWN), F.when(rank > 0, rank).otherwise(len(PROBLEM_ORDER) + 1)).cast("int")


def problems(links: DataFrame) -> DataFrame:
    """Links that are not drawn, with the rank of their state."""
    return links.filter(~F.col("state").isin(*DRAWN)).withColumn("priority", problem_rank(F.col("state")))


def summary(domains: DataFrame, links: DataFrame) -> DataFrame:
    """One row: links, drawn links, pairs and domains related, counts by state."""
    drawn = F.col("state").isin(*DRAWN)
    pair = F.when(drawn, F.struct("domain_id", "primary_domain_id"))
    states = ("RESOLVED", "TARGET_INACTIVE", *PROBLEM_ORDER)
    counted = links.agg(F.count("*").alias("n_links"), F.count_if(drawn).alias("n_drawn"), F.count_distinct(pair).alias("n_pairs"), *(F.count_if(F.col("state") == s).alias(s.lower()) for s in states))
    ends = links.filter(drawn).select("domain_id").union(links.filter(drawn).select("primary_domain_id")).agg(F.count_distinct("domain_id")).scalar()
    return counted.select("*", domains.agg(F.count("*")).scalar().alias("n_domains"), ends.alias("n_related"))


def without_inactive(links: DataFrame, inactive: DataFrame) -> DataFrame:
    """Links of inactive domains go; links into them are pending."""
    kept = links.join(inactive.select("domain_id"), "domain_id", "left_anti")
    into = kept.join(inactive.select(F.col("domain_id").alias("primary_domain_id"), F.lit(True).alias("gone")), "primary_domain_id", "left")
    return into.withColumn("state", F.when(F.col("gone"), "DOMAIN_INACTIVE").otherwise(F.col("state"))).drop("gone")


def neighbourhood(edge_rows: DataFrame, focus: Column, min_n: int = 1) -> DataFrame:
    """neighbour, n_out, n_in, n of one domain, over edges of at least min_n links."""
    near = edge_rows.filter((F.col("n") >= min_n) & ((F.col("origin") == focus) | (F.col("target") == focus)))
    other = F.when(F.col("origin") == focus, F.col("target")).otherwise(F.col("origin"))
    return near.groupBy(other.alias("neighbour")).agg(F.sum(F.when(F.col("origin") == focus, F.col("n")).otherwise(0)).alias("n_out"), F.sum(F.when(F.col("origin") != focus, F.col("n")).otherwise(0)).alias("n_in"), F.sum("n").alias("n"))


def uses(links: DataFrame, names: DataFrame, texts: DataFrame) -> DataFrame:
    """domain_id, used_by, how: by id of the origin, and by the folded attribute name inside the named domain."""
    by_id = links.filter(F.col("state").isin(*DRAWN)).select(F.col("primary_domain_id").alias("domain_id"), F.col("domain_id").alias("used_by"), F.lit("id").alias("how"))
    by_name = texts.join(names, ["name", "domain_name"]).select("domain_id", F.col("origin").alias("used_by"), F.lit("name").alias("how"))
    return by_id.unionByName(by_name).distinct()


def states_by_origin(links: DataFrame, states: tuple[str, ...]) -> DataFrame:
    """domain_id and the number of its links in each state."""
    return links.groupBy("domain_id").agg(*(F.count_if(F.col("state") == s).alias(s.lower()) for s in states))


def counts_by(links: DataFrame, *columns: str) -> DataFrame:
    """field, value, n of each of the columns; null is an empty text."""
    told = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns)))
    return links.select(told.alias("x")).groupBy("x.field", "x.value").agg(F.count("*").alias("n"))


class Neighbourhoods:
    """Edges in both directions and declared links in folders by domain: what is told of one domain is read from its folders alone."""

    def __init__(self, edge_rows: DataFrame, links: DataFrame) -> None:
        out = edge_rows.select(F.col("origin").alias("domain_id"), F.col("target").alias("neighbour"), "type", F.col("n").alias("n_out"), F.lit(0).cast("long").alias("n_in"))
        into = edge_rows.select(F.col("target").alias("domain_id"), F.col("origin").alias("neighbour"), "type", F.lit(0).cast("long").alias("n_out"), F.col("n").alias("n_in"))
        both = out.unionByName(into).groupBy("domain_id", "neighbour", "type").agg(F.sum("n_out").alias("n_out"), F.sum("n_in").alias("n_in"))
        self.edges = kept(both.hint("rebalance", F.col("domain_id")), "domain_id")
        declared = links.select("id", "primary_id", "primary_domain_id", "state", problem_rank(F.col("state")).alias("priority"), "domain_id")
        self.declared = kept(declared.hint("rebalance", F.col("domain_id")), "domain_id")

    def neighbours(self, domain: int, min_n: int = 1) -> DataFrame:
        """neighbour, n_out, n_in, n over edges of at least min_n links, by weight."""
        near = self.edges.filter(F.col("domain_id") == domain)
        told = near.groupBy("neighbour").agg(*(F.sum(F.when(F.col(c) >= min_n, F.col(c)).otherwise(0)).alias(c) for c in ("n_out", "n_in")))
        return told.withColumn("n", F.col("n_out") + F.col("n_in")).filter("n > 0")

    def attributes(self, domain: int) -> DataFrame:
        """Links that the domain declares, problems among them: id, primary_id, primary_domain_id, state, priority (null: none)."""
        return self.declared.filter(F.col("domain_id") == domain).drop("domain_id")

    def measures(self, domain: int) -> DataFrame:
        """One row: declared, drawn and pending links, problems, neighbours on either side, the share of drawn links."""
        drawn = F.col("state").isin(*DRAWN)
        own = self.attributes(domain).agg(F.count("*").alias("n_declared"), F.count_if(drawn).alias("n_drawn"), F.count_if(F.col("priority").isNotNull()).alias("n_problems"))
        near = self.neighbours(domain).agg(F.count_if(F.col("n_out") > 0).alias("n_targets"), F.count_if(F.col("n_in") > 0).alias("n_sources"), F.coalesce(F.sum("n_in"), F.lit(0)).alias("n_used"))
        return own.select("*", *(near.select(c).scalar().alias(c) for c in ("n_targets", "n_sources", "n_used")), percent(F.col("n_drawn"), F.col("n_declared")).alias("drawn_share"))
