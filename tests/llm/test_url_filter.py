from marketbars.llm.url_filter import judge_urls

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]


def rules_of(spark, rows=RULES):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else (0, 0, False, None, default)
    return host, path, best[3], best[4]


URLS = ["http://a.net/", "http://example.net/en/x", "http://www.EXAMPLE.net/en", "https://x.org/fr/y?z",
        "http://a.net", "http://a.net?x=/", "http://a.net#/en/", "http://example.com/de/a/b#c",
        "http://notexample.com/de/", "http://sub.example.com/de/", "nothing", None, "", "://", "http:///p",
        "http://net/", "x://y://net/", "http://a.net:80/", "http://é.Net/ß/", "http://a..net//",
        "http://long.net/" + "s/" * 3000, "http://" + "a." * 500 + "org/fr/"]


def test_every_url_against_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h", "r", "v") for i, u in enumerate(URLS + URLS)],
                                  "page_id long, url string, html string, rule string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in judge_urls(pages, rules_of(spark)).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(URLS + URLS)}


def test_rules_inside_a_segment_ties_and_nulls(spark):
    rules = [("a.com", "/x", "block"), ("a.com", "/xy/z", "allow"), ("com", "/xy/z12", "block"),
             ("b.a.com", "/x", "allow"), (None, "/", "block"), ("c.com", None, "block"),
             ("d.com", "/p", "allow"), ("d.com", "/p", "block")]
    urls = ["http://a.com/x", "http://a.com/xy/zz", "http://a.com/xy/z123", "http://b.a.com/x1",
            "http://c.com", "http://d.com/p", "http://e.com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, rules_of(spark, rules)).collect()}
    assert got == {0: ("a.com/x", "block"), 1: ("a.com/xy/z", "allow"), 2: ("a.com/xy/z", "allow"),
                   3: ("b.a.com/x", "allow"), 4: ("c.com", "block"), 5: ("d.com/p", "block"),
                   6: (None, "allow")}


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in judge_urls(pages, rules_of(spark, [])).collect()] \
        == [(1, "a.net", "/", None, "allow")]
    assert judge_urls(pages.limit(0), rules_of(spark)).collect() == []
