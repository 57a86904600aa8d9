from siltstone.llm.queries import RULES, ship_package
from siltstone.llm.url_filter import Rule, build_trie, filter_urls, longest_match

URLS = [
    None,
    "",
    "no scheme here",
    "http://",
    "HTTP://Example.ORG/es/1",
    "http://example.org/es",
    "https://a.b.example.org/en/148.html?x=/es/",
    "https://notexample.org/en/1",
    "https://example.org",
    "https://www.org/#top",
    "http://x.com/fr/1?u=http://a.org/de/",
    "http://com/de/",
    "ftp://x.com/fr",
    "http://example.org:80/en/1",
    "http://example..org/en/1",
    "x://é.Org/" + "p" * 200_000,
]


def plain(rules, url, default="allow"):
    if not url or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [r for r in rules if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"), default=None)
    return host, path, best and best.text, best.verdict if best else default


def test_trie_and_join_match_plain_rules(spark):
    ship_package(spark)
    rules = [*RULES, Rule("org", "/", "block"), Rule("b.example.org", "/", "allow"), Rule("example.org", "/en/148.html", "allow")]
    df = spark.createDataFrame([(i, u, "kept", "old") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, html string, rule string")
    for limit in (1 << 20, 0):
        rows = filter_urls(df, rules, max_trie_bytes=limit).collect()
        assert len(rows) == 2 * len(URLS)
        for row in rows:
            assert (row.host, row.path, row.rule, row.verdict) == plain(rules, row.url), row.url
            assert row.html == "kept"


def test_no_rules_and_no_rows(spark):
    ship_package(spark)
    df = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    for limit in (1 << 20, -1):
        assert [(r.rule, r.verdict) for r in filter_urls(df, [], default="block", max_trie_bytes=limit).collect()] == [(None, "block")]
        assert filter_urls(df.limit(0), RULES, max_trie_bytes=limit).collect() == []


def test_longest_match_prefers_hosts_then_paths():
    trie = build_trie([Rule("a.org", "/", "allow"), Rule("org", "/long/path", "block"), Rule("a.org", "/l", "block")])
    assert longest_match(trie, "x.a.org", "/long/path") == ("a.org/l", "block")
    assert longest_match(trie, "x.a.org", "/other") == ("a.org/", "allow")
    assert longest_match(trie, "b.org", "/long/path/more") == ("org/long/path", "block")
    assert longest_match(trie, "b.org", "") is None
