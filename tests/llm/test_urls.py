from millwatch.llm import urls

SF = "/root/testdata/sf0.001"


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        for i, c in enumerate(rest):
            if c in "/?#":
                break
        else:
            i = len(rest)
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:i])
        path = rest[i:]
        for stop in "?#":
            path = path.split(stop, 1)[0]
    fits = [
        (len(h + p), v == "block", h + p, v)
        for v, h, p in urls.RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    words = set("".join(c if c.isalnum() else " " for c in host).split())
    return host, path, None, "block" if words & set(urls.BLOCKED_WORDS) else "allow"


URLS = [
    None, "", "no scheme.org/", "http://", "://org/", "http://org", "http://org/", "http://ORG/x", "http://a.org/",
    "http://xorg/", "http://example.org/es/", "http://example.org/es", "http://example.org/ES/", "http://example.org/en/1",
    "http://www.Example.ORG/en/17?x=/es/", "http://notexample.org/en/1", "http://example.org:80/es/", "http://a.com/fr/de/",
    "http://b.com/de/", "http://b.com?/de/", "http://b.com#/de/", "http://casino.net/", "http://my.casino-x.net", "a://b://org/",
    "http://x.com/" + "y" * 20000, "http://É.org/é", "http://user@org/", "http://org.net/",
    "ftp://spam.example.org/es/1\nline", "http://a\n.org/",
]


def test_against_brute_force(spark):
    rows = [(i // 2, u, "h", "v") for i, u in enumerate(URLS + URLS)] + [(None, "http://org/", "h", "v")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    got = sorted((tuple(r) for r in urls.judge(pages).collect()), key=repr)
    assert got == sorted(((i, *brute(u)) for i, u, *_ in rows), key=repr)
    assert urls.judge(pages.limit(0)).count() == 0
    plain = urls.judge(pages, rules=[("allow", "none.example", "/")], blocked_words=())
    assert {r.verdict for r in plain.collect()} == {"allow"}


def test_rules_without_whole_token_and_odd_characters(spark):
    rules = [("block", "c", ""), ("allow", "a.c", "/x"), ("block", "w.c", "/\\E(")]
    pages = spark.createDataFrame(
        [(1, "http://c"), (2, "http://a.c/xy"), (3, "http://w.c/\\E(z"), (4, "http://cc/")], "page_id bigint, url string"
    )
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, rules).collect()}
    assert got == {1: ("c", "block"), 2: ("a.c/x", "allow"), 3: ("w.c/\\E(", "block"), 4: (None, "allow")}


def test_rarest_token(spark):
    tokens = spark.createDataFrame([("org",)] * 5 + [("example",)] * 3, "token string")
    rows = urls.index_rules(urls.rule_table(spark, urls.RULES), tokens).collect()
    assert {r.rule: r.token for r in rows} == {
        "org/": "org", "example.org/es/": "es", "example.org/en/1": "en", "com/fr/": "com", "com/de/": "com",
    }
