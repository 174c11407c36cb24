import itertools

from tickloom.llm import url_filter
from tickloom.llm.url_filter import RULES, judge_urls, rule_table


def brute(url, rules, default="allow"):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), a, h + p) for h, p, a in rules if h is not None and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, default, None))
    return host, path, best[3], best[2]


def check(spark, urls, rules, **options):
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[-1])]
    out = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rule_table(spark, rules), **options)
    got = sorted([tuple(r) for r in out.collect()], key=str)
    assert got == sorted([(i, u, *brute(u, rules)) for i, u in rows], key=str)


URLS = [None, "", "no scheme.com/en/", "http://", "http://COM/", "http://com", "https://WWW.Example.COM/en/x?y#z", "ftp://a.example.com/en/", "http://notexample.com/en/", "http://example.com/en",
        "http://x.net/es/1", "http://net/fr/", "http://x.net?/fr/", "http://x.net#/fr/", "http://x.org/a", "http://a.b.c.d.com/../x", "http://x.net/fr/http://y.net/es/", "http://É.net/fr/\n", "http://.com/", "http://" + "a." * 500 + "com/" + "p" * 5000]


def test_rules(spark):
    check(spark, URLS, RULES)


def test_many_rules_without_broadcast(spark):
    rules = [(h, p, a) for (h, p), a in zip(itertools.product(["com", "example.com", "net", "a.net", "c.d.com"], ["", "/", "/e", "/en/", "/f"]), itertools.cycle(["allow", "block", "block"]))]
    check(spark, URLS, [*rules, ("net", "/", "block"), (None, "/", "block")], broadcast_rules=3)


def test_long_rules_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 20)
    check(spark, URLS, RULES)


def test_clashes_and_empty(spark):
    df = spark.createDataFrame([("http://x.net/es/", 1, "mine", 2)], "url string, rule int, prefix string, host_len int")
    out = judge_urls(df, rule_table(spark, RULES))
    assert out.columns == ["url", "prefix", "host_len", "host", "path", "rule", "verdict"]
    assert tuple(out.first()) == ("http://x.net/es/", "mine", 2, "x.net", "/es/", "net/es/", "block")
    assert judge_urls(df.limit(0), rule_table(spark, RULES)).count() == 0
    assert judge_urls(df, rule_table(spark, RULES).limit(0)).first().verdict == "allow"
