import re

from tidemark.llm import urls

SCHEMA = "page_id long, url string, html string, host string, key string, label string, rule int, n long"
URLS = [
    None, "", "no scheme.com/en/", "http://", "://com/", "x://COM/en", "http://com", "http://com?x", "http://a.b.example.com/en/1?q", "http://example.com/EN/1", "http://notexample.com/en/1", "http://WWW.Example.com/en/",
    "http://www.example.com/en", "http://net/es/", "http://x.net/fr/1#t", "http://x.net/frx/", "http://cheap-pills.example.org/", "http://blog.Cheap-Pills.example.org/", "http://notcheap-pills.example.org/",
    "http://a.org/wp-login.php", "http://a.org/wp-login.phpx", "http://a.org/a?b&SessionID=1", "http://a.org/calendar/2020/x/print/", "http://sub.org/tag/x?page=3", "http://a.com/p://b.net/es/", "http://spam-farm.example.org/en/about/me",
    "http://spam-farm.example.org/en/aboutme", "http://é.com/ü\n/x?\n#y", "http://a.com:80/", "http://a.com/" + "long/" * 5000, "http://example.com", "http://x.net/es", "http://ex\u0130mple.org/calendar/\u212a/PRINT",
]


def plain(url, host_rules=urls.HOST_RULES, list_rules=urls.LIST_RULES):
    """Every rule on every URL."""
    host, path, tail = "", "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        tail = rest[len(host) :]
        host, path = host.translate(str.maketrans(urls.UPPER, urls.LOWER)), re.match(r"[^?#]*", tail)[0]
    fits = [r for r in host_rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.action, None
    hits = []
    for text in list_rules if host + tail else ():
        body = text.removeprefix("@@")
        inner = body.strip("|")
        expression = ("^([^/?#]*[.])?" if body.startswith("||") else "^" if body.startswith("|") else "") + "".join({"*": ".*", "^": "([^a-zA-Z0-9_.%-]|$)"}.get(c, re.escape(c)) for c in inner) + ("$" if body.endswith("|") else "")
        if re.search(expression, host + tail, re.I | re.S | re.A):
            hits.append((text.startswith("@@"), text))
    return host, path, None, "allow" if not hits or max(hits)[0] else "block", max(hits)[1] if hits else None


def frame(spark, texts):
    return spark.createDataFrame([(None if k == 3 else k % 30, u, "<p>", "h", "k", "l", 1, 2) for k, u in enumerate(texts)], SCHEMA)


def rows(df):
    return sorted(map(str, ((r.page_id, r.host, r.path, r.rule, r.verdict, r.list_rule) for r in df.collect())))


def test_same_as_all_rules_on_all_urls(spark):
    texts = URLS + ["http://x.net/es/1"] * 50 + [None] * 20
    assert rows(urls.judge(frame(spark, texts))) == sorted(str((None if k == 3 else k % 30, *plain(u))) for k, u in enumerate(texts))
    more = ("|a.com", "print|", "*", "@@^en^", "||x.*/es/", "é.com", "/en/*", "|http")
    assert rows(urls.judge(frame(spark, texts), host_rules=urls.HOST_RULES[3:], list_rules=more)) == sorted(str((None if k == 3 else k % 30, *plain(u, urls.HOST_RULES[3:], more))) for k, u in enumerate(texts))
    assert urls.judge(frame(spark, URLS).limit(0)).collect() == []
    assert {r.verdict for r in urls.judge(frame(spark, URLS), host_rules=(), list_rules=()).collect()} == {"allow"}


def test_rules_lie_under_their_rarest_token(spark):
    assert urls.list_rule("||cheap-pills.")[4] == ["cheap", "pills"]
    assert urls.list_rule("cheap-pills-x")[4] == ["pills"] and urls.list_rule("pills")[4] == [] and urls.list_rule("|pills|")[4] == ["pills"] and urls.list_rule("/a*b/")[4] == []
    assert urls.host_rule(urls.HostRule("block", "a.com", "/en"))[4] == ["a", "com"]
    pages = urls.parts(frame(spark, [f"http://{h}.com/x/{k}" for h in ("a", "b") for k in range(5)] + ["http://b.com/"]), "page_id", "url")
    filed = {r.label: r.key for r in urls.index(pages, [urls.host_rule(urls.HostRule("block", h, "/")) for h in ("a.com", "b.com", "com")] + [urls.list_rule("||com^x^"), urls.list_rule("pills")]).collect()}
    assert filed == {"a.com/": "a", "b.com/": "b", "com/": "com", "||com^x^": "x", "pills": ""}


def test_expressions_run_on_fetched_pairs_only(spark):
    pages = frame(spark, [f"http://host{k}.com/en/{k}" for k in range(200)])
    many = tuple(f"||host{k}.com^" for k in range(200))
    got = urls.judge(pages, host_rules=(), list_rules=many)
    assert {r.list_rule for r in got.collect()} == set(many)
    some = urls.parts(pages, "page_id", "url")
    filed = urls.index(some, [urls.list_rule(p) for p in many])
    assert filed.select("key").distinct().count() == 200
