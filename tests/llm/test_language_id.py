import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import language_id as g

SF = "/root/testdata/sf0.01"


def parts(url):
    host = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = rest[: min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))].lower().rsplit("@", 1)[-1]
        head, colon, port = host.rpartition(":")
        host = head if colon and (port.isdigit() or not port) else host.removesuffix(".")
    return host, ".".join(host.split(".")[-2:]), host.split(".")[-1]


def plain(rows, model):
    """rows: (url, html). The whole fusion with dictionaries, page by page."""
    langs = model.languages
    ev = []
    for url, html in rows:
        page = (html or "").encode()
        n, t = model.score(g.page_text(page))
        e = np.exp(t - t.max())
        ev.append((n, t, e / e.sum(), g.declared_language(page), parts(url)))
    total = sum(p for _, _, p, _, _ in ev)
    kind = lambda d: "none" if d is None else d if d in langs else "other"
    said, level = {}, [{}, {}, {}]
    for _, _, p, d, keys in ev:
        said[kind(d)] = said.get(kind(d), 0) + p
        if keys[0]:
            for table, key in zip(level, keys):
                c, m = table.get(key, (0, 0))
                table[key] = c + p, m + 1
    kinds, s = [*langs, "other", "none"], g.STRENGTH
    out = []
    for n, t, p, d, keys in ev:
        prior = (total - p + s / len(langs)) / (len(rows) - 1 + s)
        if keys[0]:
            for depth in (2, 1, 0):
                c, m = level[depth][keys[depth]]
                right = np.array([g.COUNTRY_STRENGTH * (depth == 2 and g.COUNTRIES.get(keys[2]) == x) for x in langs])
                bonus = g.COUNTRY_STRENGTH * (depth == 2 and g.COUNTRIES.get(keys[2]) in langs)
                prior = (c - p + s * prior + right) / (m - 1 + s + bonus)
        start = lambda x, k: g.DECLARED_RIGHT if k == x else g.DECLARED_WRONG
        decl = np.array([(said[kind(d)][k] + start(x, kind(d)) - p[k]) / (total[k] + sum(start(x, y) for y in kinds) - p[k]) for k, x in enumerate(langs)])
        score = t + np.log(np.maximum(prior, 1e-12)) + np.log(decl)
        e = np.exp(score - score.max())
        out.append((langs[int(score.argmax())], float(e.max() / e.sum()), langs[int(t.argmax())] if n else None, d, n))
    return out


ROWS = [("http://a.example.de/x", '<html lang="de"><p>der die und das</p>'), ("http://a.example.de/y", None), ("http://b.example.de", ""), ("http://c.de", "<b>le les une"), (None, '<html lang="en">the and of'), ("nothing", "the"),
        ("http://u@a.example.de:80/", '<html lang="xx-YY">und'), ("http://A.EXAMPLE.DE./", "&uuml;ber und"), ("http://fr/", '<meta http-equiv="Content-Language" content="fr-FR"> et les')] + [("http://hot.net/", f'<html lang=en> the of and {i}') for i in range(40)] + [("http://hot.net/", "und der die")] * 2


@pytest.fixture(scope="module")
def model(spark):
    return g.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def test_markup():
    page = b'<!DOCTYPE html><html class="x" lang="fr-CA"><head><script>var t="</p> mot";</script><style>p{}</style></head><!-- <b>no</b> --><body>d&eacute;j&agrave;<br>vu</body>'
    assert g.declared_language(page) == "fr" and g.page_text(page).decode().split() == ["déjà", "vu"]
    assert g.declared_language(b'<meta property="og:locale" content="es_MX">') == "es" and g.declared_language(b"<p lang='de'>") is None
    assert g.page_text(b"<script>a<style>b</script>c<style>d<!--e").split() == [b"c", b"d<!--e"] and g.page_text(b"a<!-- <script> -->b<SCRIPT x>c</Script >d").split() == [b"a", b"b", b"d"]
    assert len(g.page_text(b"<" * 300_000 + b"<!--<script " * 100_000)) > 0 and g.declared_language(b"<html " * 200_000) is None
    assert g.declared_language(b'<html hreflang="de">') is None and g.page_text(b"a < b > c <") == b"a   c <"


@pytest.mark.parametrize("page", [b"<meta " + b"content-language " * 60_000, b"<meta content-language content" + b" " * 1_000_000, b"<meta content-language content=" + b" " * 1_000_000 + b">", b"<html lang=" + b" " * 1_000_000, b"<html " + b"lang " * 200_000, b"<meta og:locale " * 70_000, b"&#" + b"9" * 1_000_000 + b";", b"<script" * 150_000 + b"</script" + b" " * 200_000])
def test_hostile_pages_take_time_in_proportion(page):
    began = time.perf_counter()
    assert g.declared_language(page) is None
    g.trigrams(g.page_text(page))
    assert time.perf_counter() - began < 5


def test_references_beyond_any_character():
    assert g.page_text(b"a&#0000066;&#" + b"1" * 5000 + b";c&#99999999;d&#x41;").decode() == "aB\ufffdc\ufffddA"


def test_any_number_of_languages(spark):
    """100 labels, some with one row: each is learned and found."""
    names = [f"l{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(100)]
    rows = [(i * 10 + k, f"{n}zq {n}xw q{n}" * 5, n) for i, n in enumerate(names) for k in range(1 + i % 3)]
    model = g.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=3)
    assert list(model.languages) == names
    pages = spark.createDataFrame([(i, "http://x.org/", f"{n}zq {n}xw q{n}") for i, n in enumerate(names)], "page_id long, url string, html string")
    got = {r.page_id: r.text_lang for r in g.identify(pages, model).select("page_id", "text_lang").collect()}
    assert [got[i] for i in range(100)] == names


def test_trigrams_count_like_plain_python():
    grams = g.trigrams("Ab, é1b".encode())
    raw = " ab é b ".encode()
    assert grams.tolist() == [((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2654435761 >> 8) & g.BUCKETS - 1 for i in range(len(raw) - 2)]
    assert len(g.trigrams(b"")) == len(g.trigrams(b"12 ,")) == 0


def test_against_plain_python(spark, model):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(ROWS)], "page_id long, url string, html string")
    old = g.HOT
    try:
        for hot in (old, 0.2):  # with and without keys beyond the share
            g.HOT = hot
            got = {r.page_id: r for r in g.identify(df, model).collect()}
            for i, (lang, confidence, text, declared, n) in enumerate(plain(ROWS, model)):
                r = got[i]
                assert (r.lang, r.text_lang, r.declared, r.n_trigrams) == (lang, text, declared, n) and math.isclose(r.confidence, confidence, rel_tol=1e-9)
    finally:
        g.HOT = old
    assert got[1].lang == "de"  # by its address alone


def test_query_against_plain_python(spark):
    docs, pages = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "pages"))
    rows = pages.collect()
    want = plain([(r.url, r.html) for r in rows], g.learn(docs))
    got = {r.page_id: r for r in g.op4_language_id(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows) and all(got[r.page_id].lang == w[0] and math.isclose(got[r.page_id].confidence, w[1], rel_tol=1e-9) for r, w in zip(rows, want))


def test_accuracy_without_declarations(spark, model):
    """The pages' own declarations are right here; taken away, or turned to another language in one page of ten, the rest of the evidence finds them."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("truth", F.regexp_extract("html", '<html lang="([a-z]+)"', 1))
    bare = pages.withColumn("html", F.regexp_replace("html", '<html lang="[a-z]+"', "<html"))
    wrong = pages.withColumn("html", F.when(F.col("page_id") % 10 == 0, F.regexp_replace("html", '<html lang="[a-z]+"', '<html lang="es"')).otherwise(F.col("html")))
    for df in (bare, wrong):
        got = g.identify(df, model)
        assert got.where("lang = truth").count() >= 0.98 * got.count()


def test_hard_rows(spark, model):
    rows = [(1, "http://x.de/", "und " * 500_000, "p", 1.5), (1, "http://x.de/", None, "q", 2.5), (None, None, None, None, None), (1, "http://x.de/", None, "q", 2.5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, _host string, confidence double")
    out = g.identify(df, model)
    assert out.columns == ["page_id", "url", "_host", "lang", "confidence", "text_lang", "declared", "n_trigrams"] and out.count() == 4 and out.where("lang = 'de' OR url IS NULL").count() == 4
    assert g.identify(df.limit(0), model).count() == 0
    none = g.learn(spark.createDataFrame([(1, None, "de"), (2, "x", None)], "doc_id long, text string, lang string"))
    assert none.languages == () and [r.lang for r in g.identify(df, none).collect()] == [None] * 4
