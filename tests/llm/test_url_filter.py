import random

from pyspark.sql import functions as F

from astrolode.llm import queries, url_filter

SITES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
WORDS = ("casino", "poker", "betting")


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h + p, v) for h, p, v in SITES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits, key=lambda f: len(f[0]))
    tokens = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in host).split()
    return host, path, None, "block" if any(w in tokens for w in WORDS) else "allow"


def test_against_brute_force(spark):
    rnd = random.Random(1)
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.Net/x", "x://xnet/",
            "a://b://net/", "http://sub.example.net/en/", "http://example.net/en", "http://example.net/EN/",
            "http://badexample.com/de/x", "http://example.com/de/", "http://m.poker.com", "http://x-poker.y/",
            "http://pokers.y/", "http://ÉCOLE.ORG/fr/é", "http://org/fr/?q=/net/", "http://a.org?x=/fr/",
            "http://b.net:80/", "http://user@c.net/d", "http://d.net#/", "http://e.net\n/", "h://.net/", "h://net./"]
    names = ["net", "example", "com", "org", "www", "casino", "fr", "de", "en", "x"]
    for _ in range(600):
        host = rnd.choice(".-") .join(rnd.choices(names, k=rnd.randint(1, 4)))
        tail = "".join(rnd.choice(["/", "?", "#", "en", "de", "fr", "/fr/", "/de/", "/en/"]) for _ in range(3))
        urls.append(f"http://{host}{tail}")
    rows = [(i // 2, u, "h", "host?") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted(map(tuple, url_filter.judge(pages, queries.SITE_RULES + queries.WORD_RULES).collect()), key=str)
    assert got == sorted(((i, *brute(u)) for i, u, *_ in rows), key=str)


def test_empty_table_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filter.judge(pages.limit(0), queries.SITE_RULES).collect() == []
    assert [r["verdict"] for r in url_filter.judge(pages, []).collect()] == ["allow"]


def test_rules_lie_under_their_rarest_token(spark):
    urls = ["a.com/en/"] * 9 + ["rare.com/x"]
    subjects = spark.createDataFrame([(u,) for u in urls], "subject string")
    rule = url_filter.site_rule("block", "rare.com/en/")
    counts = url_filter.token_counts(subjects, rule.tokens)
    assert counts == {"rare": 1, "com": 10, "en": 9}
    assert url_filter.file_rules([rule], counts) == {"rare": [rule]}
    # The end of an open path is not a whole token, so it cannot be the one a rule is filed under.
    assert url_filter.site_rule("block", "x.y/en").tokens == ("x", "y")


def test_only_candidates_run_their_expressions():
    rules = [url_filter.site_rule("block", f"host{i}.com/") for i in range(500)]
    judge = url_filter.Judge(url_filter.file_rules(rules, {"com": 10**6}), "allow")
    assert judge("www.host7.com", "/x") == ("host7.com/", "block")
    assert len(judge._filed) == 500 and all(len(held) == 1 for held in judge._filed.values())


def test_same_longest_rule_prefers_block(spark):
    rules = [url_filter.site_rule(v, "a.b/") for v in ("allow", "block")]
    page = spark.createDataFrame([(1, "h://a.b/")], "page_id long, url string")
    assert url_filter.judge(page, rules).select(F.first("verdict")).first()[0] == "block"
