"""URL filters: pattern rules indexed by their rarest literal token; a URL's tokens fetch its candidate rules, only those run as patterns.

1. A rule becomes a regular expression and the literal tokens (runs of letters and digits, lower case) that every URL it fits must have as
   whole tokens: those whose neighbours in the rule are literal too, or its anchored ends.
2. The URLs of the table are counted by those tokens, and each rule is filed under its rarest one. A rule without a token is filed under
   the empty one, which every URL has.
3. URLs are exploded into tokens, joined with the index (narrow on both sides; Catalyst broadcasts it if its measured size allows), and
   only the pairs found run the rule's expression. Hits are folded by URL where they are found, so a URL that comes often is one row.
4. Rows are joined with the hits of their URL; rows without a URL need none and take no part in the join.

Two kinds of rules. Host rules (host, path): the host and all its subdomains, if the path starts with the rule's; the longest wins.
List rules, for URLs that no host rule fits, in the usual filter-list notation: ``||`` before a host or its subdomain, ``|`` at an end,
``*`` any text, ``^`` a separator or the end, ``@@`` allows; they look at host, path and query, whatever their letters' case; an allowing
one wins over blocking ones; without any the URL is allowed.

Null URLs and those without ``://``: empty host and path, no host rule, allowed. Long URLs are taken whole. Repeated rows and ids come as
often as they are there. An empty table gives no rows, and other columns play no part.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[a-z0-9]+"


class HostRule(NamedTuple):
    action: str
    host: str
    path: str


HOST_RULES = (HostRule("allow", "com", "/"), HostRule("block", "example.com", "/en/"), HostRule("allow", "www.example.com", "/en/"), HostRule("block", "net", "/es/"), HostRule("block", "net", "/fr/"))
#: Unwanted hosts and kinds of pages.
LIST_RULES = (
    "||cheap-pills.", "||adult-x.", "||casino-win.", "||free-bets.", "||ads-track.", "||spam-farm.", "/wp-login.php^", "^sessionid=", "/calendar/*/print^", "||org^*/tag/*?page=",
    "@@||spam-farm.example.org/en/about^",
)


def safe_tokens(body: str, start: bool, end: bool) -> list[str]:
    """Tokens that a fitting URL has as whole ones: nothing beside them may be left open."""
    found = []
    for m in re.finditer(TOKEN, body.lower()):
        left, right = body[m.start() - 1 : m.start()], body[m.end() : m.end() + 1]
        if (start if not left else left != "*") and (end if not right else right != "*"):
            found.append(m[0])
    return found


def host_rule(rule: HostRule) -> tuple[str, int, str, str, list[str]]:
    """label, tier, action, expression (over host and what follows), tokens."""
    body = rule.host + rule.path
    return body, 0, rule.action, rf"^(?:[^/?#]*\.)?{re.escape(body)}", safe_tokens(body, True, False)


def list_rule(pattern: str) -> tuple[str, int, str, str, list[str]]:
    action, body = ("allow", pattern[2:]) if pattern.startswith("@@") else ("block", pattern)
    domain = body.startswith("||")
    start, body = (domain or body.startswith("|")), body.lstrip("|")
    end, body = body.endswith("|"), body.rstrip("|")
    literal = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|$)"}
    head = r"^(?:[^/?#]*\.)?" if domain else "^" if start else ""
    return pattern, 1, action, f"(?is){head}{''.join(literal.get(c) or re.escape(c) for c in body)}{'$' if end else ''}", safe_tokens(body, start, end)


def parts(df: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """page_id, url, host, path, address (host and all that follows)."""
    url = F.col(f"`{url_col}`").cast("string")
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), "^[^/?#]*", 0)
    df = df.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), F.coalesce(rest, F.lit("")).alias("rest"), host.alias("told"))
    tail = F.substring("rest", F.length("told") + 1, F.length("rest"))
    low = F.translate("told", UPPER, LOWER)
    return df.select("page_id", "url", low.alias("host"), F.regexp_extract(tail, "^[^?#]*", 0).alias("path"), F.concat(low, tail).alias("address"))


def tokens(address: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(address, UPPER, LOWER), F.lit(TOKEN), F.lit(0)))


def index(pages: DataFrame, rules: list[tuple[str, int, str, str, list[str]]]) -> DataFrame:
    """key, label, tier, action, expression: each rule under the one of its tokens that the fewest URLs of the table have."""
    spark = pages.sparkSession
    # as a table, whose size Catalyst knows: rows on the driver have none
    told = common.written(spark.createDataFrame([(k, *r) for k, r in enumerate(rules)], "rule int, label string, tier int, action string, expression string, tokens array<string>"))
    each = told.select("rule", F.explode("tokens").alias("key"))
    counts = pages.select(F.explode(tokens(F.col("address"))).alias("key")).join(each.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
    rarest = each.join(counts, "key", "left").groupBy("rule").agg(F.min_by("key", F.struct(F.coalesce("n", F.lit(0)), "key")).alias("key"))
    return told.join(rarest, "rule", "left").select(F.coalesce("key", F.lit("")).alias("key"), "label", "tier", "action", "expression")


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", host_rules: tuple[HostRule, ...] = HOST_RULES, list_rules: tuple[str, ...] = LIST_RULES) -> DataFrame:
    """page_id, host, path, rule (the host rule that fits), verdict, list_rule (the list rule that decided, if one did)."""
    pages = parts(df, id_col, url_col)
    some = pages.filter("address <> ''")
    filed = common.written(index(some, [*map(host_rule, host_rules), *map(list_rule, list_rules)]))
    fetched = some.select("url", "address", F.explode(F.concat(tokens(F.col("address")), F.array(F.lit("")))).alias("key")).join(filed, "key")
    fits = fetched.filter(F.rlike("address", F.col("expression")))
    of = lambda tier, *order: F.max(F.when(F.col("tier") == tier, F.struct(*order, "label", "action")))
    hits = fits.groupBy("url").agg(of(0, F.length("label").alias("first")).alias("by_host"), of(1, (F.col("action") == "allow").alias("first")).alias("by_list"))
    none = [F.lit(None).cast(hits.schema[c].dataType).alias(c) for c in ("by_host", "by_list")]
    judged = some.join(hits, "url", "left").unionByName(pages.filter("address = ''").select("*", *none))
    rule = F.col("by_host.label")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce("by_host.action", "by_list.action", F.lit("allow")).alias("verdict"), F.when(rule.isNull(), F.col("by_list.label")).alias("list_rule"))


ORACLE = r"""
WITH p AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*((?s:.*))', 1) AS tail FROM pages
), h(host, path, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
    SELECT p.*, (SELECT max_by({'label': h.host || h.path, 'action': action}, length(h.host || h.path)) FROM h WHERE (p.host = h.host OR ends_with(p.host, '.' || h.host)) AND starts_with(p.path, h.path)) AS hit FROM p
), l AS (
    SELECT *, CASE WHEN regexp_matches(host || tail, '(?i)^([^/?#]*\.)?spam-farm\.example\.org/en/about([^A-Za-z0-9_.%-]|$)') THEN '@@||spam-farm.example.org/en/about^'
                   ELSE (SELECT max(label) FROM (VALUES
                       ('||cheap-pills.', regexp_matches(host, '^(.*\.)?cheap-pills\.')), ('||adult-x.', regexp_matches(host, '^(.*\.)?adult-x\.')), ('||casino-win.', regexp_matches(host, '^(.*\.)?casino-win\.')),
                       ('||free-bets.', regexp_matches(host, '^(.*\.)?free-bets\.')), ('||ads-track.', regexp_matches(host, '^(.*\.)?ads-track\.')), ('||spam-farm.', regexp_matches(host, '^(.*\.)?spam-farm\.')),
                       ('/wp-login.php^', regexp_matches(tail, '(?i)/wp-login\.php([^a-z0-9_.%-]|$)')), ('^sessionid=', regexp_matches(tail, '(?i)[^a-z0-9_.%-]sessionid=')),
                       ('/calendar/*/print^', regexp_matches(tail, '(?is)/calendar/.*/print([^a-z0-9_.%-]|$)')), ('||org^*/tag/*?page=', regexp_matches(host || tail, '(?is)^([^/?#]*\.)?org[^a-z0-9_.%-].*/tag/.*\?page='))
                   ) v(label, fits) WHERE fits) END AS list_rule FROM m
)
SELECT page_id, host, path, hit.label AS rule, coalesce(hit.action, CASE WHEN list_rule IS NULL OR starts_with(list_rule, '@@') THEN 'allow' ELSE 'block' END) AS verdict, CASE WHEN hit IS NULL THEN list_rule END AS list_rule FROM l
"""
