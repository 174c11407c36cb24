"""Language identification of web pages by Bayesian fusion of four kinds of evidence.

Text: naive Bayes over hashed byte trigrams, learned from labelled documents. Markup: the language that a page declares, whose
reliability is a table of counts learned from the pages themselves. Address: the suffix, domain and host, each a prior smoothed
by the level above it. Counts are sums of text posteriors per key, made by grouped aggregation over all pages; a page's own
share is taken out of every count before it is judged by them.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, in_batches, written
from .url_filter import split_url

#: Labelled documents of each language that the text model is learned from, about: a bound on labelled rows. All labels of a
#: language with no more are used, and no language is left out.
LABEL_ROWS = 5_000
#: Hashed trigrams, and the count that each has to begin with.
BUCKETS, ALPHA = 1 << 15, 0.5
#: A text counts as at most so many independent trigrams, as neighbours share letters.
TRIGRAMS = 200
#: Pages that each level's prior is worth when it smooths the level below; pages that a known country's language is worth.
STRENGTH, COUNTRY_STRENGTH = 5.0, 2.0
#: Pages to begin with for a declaration that is right, and for one that isn't.
DECLARED_RIGHT, DECLARED_WRONG = 8.0, 1.0
#: A key with over this share of all rows is looked up by broadcast; there are at most 1 / HOT such keys.
HOT = 1e-3
#: Main languages of country suffixes (fixed values).
COUNTRIES = {
    "de": "de", "at": "de", "li": "de", "fr": "fr", "mc": "fr", "es": "es", "mx": "es", "ar": "es", "cl": "es", "co": "es", "pe": "es", "uy": "es", "ve": "es", "uk": "en", "us": "en", "au": "en", "nz": "en", "ie": "en",
    "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "tw": "zh", "kr": "ko", "se": "sv", "dk": "da", "no": "no", "fi": "fi", "cz": "cs", "gr": "el", "tr": "tr", "hu": "hu",
}

_TAG = re.compile(rb"<[^<>]*>")
_HIDDEN = re.compile(rb"(?i)<!--|<script\b|<style\b")
_ENDS = {b"<!--": re.compile(rb"-->"), b"<script": re.compile(rb"(?i)</script\s*>"), b"<style": re.compile(rb"(?i)</style\s*>")}
#: Tags that declare a language, what has to stand in them, and the attribute behind it. Tags and attributes are looked for
#: one after the other, and blanks aren't given back, so a page is read in time proportional to its length.
_DECLARED = [
    (re.compile(rb"(?i)<html\b[^<>]*+"), None, re.compile(rb"(?i)\s(?:xml:)?lang\s*+=\s*+(?:[\"']\s*+)?([a-z]{2,8})\b")),
    (re.compile(rb"(?i)<meta\b[^<>]*+"), b"content-language", re.compile(rb"(?i)content\s*+=\s*+(?:[\"']\s*+)?([a-z]{2,8})\b")),
    (re.compile(rb"(?i)<meta\b[^<>]*+"), b"og:locale", re.compile(rb"(?i)content\s*+=\s*+(?:[\"']\s*+)?([a-z]{2,8})(?:\b|_)")),
]
#: Numeric character references: leading zeros, and more digits than any character has.
_ZEROS, _HUGE = re.compile(rb"&#0+(?=[0-9])"), re.compile(rb"&#[0-9]{8,};?")
_FOLD = bytes(b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def page_text(page: bytes) -> bytes:
    """A page without markup, scripts, styles and comments; character references resolved. What isn't closed is text. Each
    kind of end is looked for once more at most after it is missed, so the time is in proportion to the page."""
    parts, at, missing = [], 0, set()
    for m in _HIDDEN.finditer(page):
        kind = m[0].lower()
        if m.start() < at or kind in missing:
            continue
        if end := _ENDS[kind].search(page, m.end()):
            parts.append(page[at : m.start()])
            at = end.end()
        else:
            missing.add(kind)
    text = _TAG.sub(b" ", b" ".join([*parts, page[at:]]))
    if b"&#" in text:
        text = _HUGE.sub("\ufffd".encode(), _ZEROS.sub(b"&#", text))
    return entities.unescape(text.decode("utf-8", "replace")).encode("utf-8", "replace") if b"&" in text else text


def declared_language(page: bytes) -> str | None:
    """The primary tag that the page declares for itself, lower case; of several places the first in order of _DECLARED."""
    for tags, name, attribute in _DECLARED:
        for tag in tags.finditer(page):
            at = tag[0].lower().find(name) + len(name) if name else 0
            if (not name or at >= len(name)) and (m := attribute.search(tag[0], at)):
                return m[1].decode().lower()
    return None


def trigrams(text: bytes) -> np.ndarray:
    """Hashed trigrams of the text's letters, lower case, words parted by one blank."""
    letters = text.decode("utf-8", "replace").lower().encode().translate(_FOLD).split()
    if not letters:
        return np.zeros(0, np.int64)
    b = np.frombuffer(b" " + b" ".join(letters) + b" ", np.uint8).astype(np.uint64)
    code = b[:-2] << np.uint64(16) | b[1:-1] << np.uint64(8) | b[2:]
    return (code * np.uint64(2654435761) >> np.uint64(8) & np.uint64(BUCKETS - 1)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """Languages in order, and the log probability of each trigram in each (BUCKETS x languages)."""

    languages: tuple[str, ...]
    table: np.ndarray

    def score(self, text: bytes) -> tuple[int, np.ndarray]:
        """Number of trigrams, and their log likelihood in each language, at most that of TRIGRAMS average ones."""
        grams = trigrams(text)
        if not len(grams):
            return 0, np.zeros(len(self.languages))
        return len(grams), self.table[grams].sum(axis=0, dtype=np.float64) * min(1.0, TRIGRAMS / len(grams))


def model_of(counts: dict[str, np.ndarray]) -> TextModel:
    languages = tuple(sorted(counts))
    n = np.stack([counts[x] for x in languages], axis=1) if languages else np.zeros((BUCKETS, 0))
    return TextModel(languages, np.log((n + ALPHA) / (n.sum(axis=0) + ALPHA * BUCKETS)))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = LABEL_ROWS) -> TextModel:
    """A text model of all labels (lower case): of each, about `rows` documents, those with the smallest hashes of the id, or
    all if there are no more. Rows with null id, text or label aren't used. Trigrams are counted per language in a grouped
    aggregation; the driver gets the sums, at most BUCKETS numbers for each language of the table."""
    lang = F.lower(lang_col)
    labelled = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & (F.coalesce(F.col(lang_col), F.lit("")) != ""))
    # A row a label, as many as the table names languages.
    sizes = labelled.groupBy(lang.alias("lang")).agg(F.count(F.lit(1)).alias("size"))
    share = F.pmod(F.xxhash64(id_col), F.lit(1 << 40)) / F.lit(float(1 << 40))
    texts = labelled.select(lang.alias("lang"), F.col(text_col).cast("binary").alias("text"), share.alias("share")).join(F.broadcast(sizes), "lang").where(F.col("share") * F.col("size") < rows)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"])

    sums = texts.select("lang", "text").transform(in_batches, counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = sums.toPandas()  # at most BUCKETS rows of numbers for each language
    counts = {lang: np.bincount(own["bucket"], own["n"], BUCKETS) for lang, own in table.groupby("lang")}
    return model_of(counts)


def with_text_evidence(pages: DataFrame, model: TextModel, html_col: str, names: list[str]) -> DataFrame:
    """pages without html_col; names: trigrams, declared language, then the log likelihood of each language."""
    keep = [c for c in pages.columns if c != html_col]
    (raw,) = fresh(pages, "raw")
    schema = pages.select(*keep).schema.add(names[0], "long").add(names[1], "string")
    for name in names[2:]:
        schema = schema.add(name, "double")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, declared, rows = [], [], []
            for x in batch.column(len(keep)):
                page = x.as_py() or b""
                size, row = shared.value.score(page_text(page))
                n.append(size)
                declared.append(declared_language(page))
                rows.append(row)
            table = np.array(rows, float).reshape(len(rows), len(names) - 2)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64()), pa.array(declared, pa.string()), *(pa.array(table[:, k]) for k in range(table.shape[1]))], names=schema.names)

    return pages.select(*keep, F.col(html_col).cast("binary").alias(raw)).transform(in_batches, scored, schema)


def _look_up(df: DataFrame, table: DataFrame, key: str, rows: str, total: float) -> DataFrame:
    """df with table's columns by key (left join). Keys with over HOT of all `total` rows, by table's column `rows`, go by
    broadcast, as there can't be more than 1 / HOT of them; the others are joined by shuffle."""
    hot = F.broadcast(table.where(F.col(rows) > HOT * total))
    often = df.join(hot, key)
    seldom = df.join(hot.select(key), key, "left_anti").join(table.where(F.col(rows) <= HOT * total), key, "left")
    return often.unionByName(seldom)


def identify(pages: DataFrame, model: TextModel, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages without html_col, with lang, confidence (posterior of lang), text_lang (by text alone; null without text),
    declared (null if none) and n_trigrams.

    A null or empty page is judged by its address alone; without an address, by what languages all pages have. Ties go to the
    language first in alphabetical order. A model without languages gives null everywhere. Repeated rows are pages like any
    other and count each; rows keep their other columns, those named like results are replaced; an empty table gives an empty
    table. Texts are read whole.
    """
    results = ["lang", "confidence", "text_lang", "declared", "n_trigrams"]
    keep = [c for c in pages.columns if c not in results and c != html_col]
    langs = model.languages
    own = fresh(pages, "n", "declared", *(f"t{k}" for k in range(len(langs))))
    names = fresh(pages, "host", "path", "domain", "suffix")
    host, path, domain, suffix = names
    n, said, ts = own[0], own[1], own[2:]
    if not langs:
        scored = with_text_evidence(pages.select(*keep, html_col), model, html_col, own)
        return scored.select(*keep, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang"), F.col(said).alias("declared"), F.col(n).alias("n_trigrams"))
    ps = fresh(pages, *(f"p{k}" for k in range(len(langs))))
    scored = split_url(with_text_evidence(pages.select(*keep, html_col), model, html_col, own), url_col, host, path).drop(path)
    scored = scored.withColumn(host, F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":[0-9]*$|\.$", ""))
    top = F.greatest(*ts, F.lit(float("-inf")))
    weight = [F.exp(F.col(t) - top) for t in ts]
    total = sum(weight[1:], weight[0])
    scored = scored.withColumns({p: w / total for p, w in zip(ps, weight)})
    # Small rows without pages' texts: written once, read by each of the aggregations and by the judgement.
    scored = written(scored, "language-evidence")
    sums = lambda level: [F.sum(p).alias(f"{level}{k}") for k, p in enumerate(ps)]
    everything = scored.agg(F.count(F.lit(1)).alias("n"), *sums("c")).first()
    all_n, all_c = everything.n, [everything[f"c{k}"] or 0.0 for k in range(len(langs))]

    kind = F.when(F.col(said).isNull(), "none").when(F.col(said).isin(*langs), F.col(said)).otherwise("other")
    table = {r.kind: [r[f"c{k}"] for k in range(len(langs))] for r in scored.groupBy(kind.alias("kind")).agg(*sums("c")).collect()}  # languages + 2 rows
    kinds = [*langs, "other", "none"]

    # Grouped aggregation up the levels: pages to hosts, hosts to domains, domains to suffixes.
    hosts = scored.where(F.col(host) != "").groupBy(F.col(host).alias(host)).agg(F.count(F.lit(1)).cast("double").alias("hn"), *sums("h"))
    hosts = written(hosts.withColumn(domain, F.substring_index(host, ".", -2)), "language-hosts")
    up = lambda df, key, a, b: df.groupBy(key).agg(F.sum(f"{a}n").alias(f"{b}n"), F.count(F.lit(1)).alias(f"{b}rows"), *[F.sum(f"{a}{k}").alias(f"{b}{k}") for k in range(len(langs))])
    domains = up(hosts, domain, "h", "d").withColumn(suffix, F.substring_index(domain, ".", -1))
    suffixes = up(domains, suffix, "d", "s")
    n_hosts = hosts.count()
    domains = _look_up(domains, suffixes, suffix, "srows", max(1, n_hosts))
    hosts = _look_up(hosts, domains, domain, "drows", max(1, n_hosts))
    met = _look_up(scored, hosts.drop(domain), host, "hn", max(1, all_n))

    def smoothed(k: int, lang: str) -> Column:
        """The page's prior of a language, from all pages down to its host, its own share left out at each level."""
        p = F.col(ps[k])
        everywhere = (F.lit(all_c[k]) - p + STRENGTH / len(langs)) / (F.lit(float(all_n)) - 1 + STRENGTH)
        country = [c for c, x in COUNTRIES.items() if x == lang]
        known = F.col(suffix).isin(*[c for c, x in COUNTRIES.items() if x in langs]) if any(x in langs for x in COUNTRIES.values()) else F.lit(False)
        bonus = F.when(known, F.lit(COUNTRY_STRENGTH)).otherwise(0.0)
        right = F.when(F.col(suffix).isin(*country), F.lit(COUNTRY_STRENGTH)).otherwise(0.0) if country else F.lit(0.0)
        at_suffix = (F.col(f"s{k}") - p + STRENGTH * everywhere + right) / (F.col("sn") - 1 + STRENGTH + bonus)
        at_domain = (F.col(f"d{k}") - p + STRENGTH * at_suffix) / (F.col("dn") - 1 + STRENGTH)
        at_host = (F.col(f"h{k}") - p + STRENGTH * at_domain) / (F.col("hn") - 1 + STRENGTH)
        return F.when(F.col("hn").isNull(), everywhere).otherwise(at_host)

    def declaration(k: int, lang: str) -> Column:
        """Log probability that a page in this language declares what the page does, its own share left out."""
        p, start = F.col(ps[k]), lambda d: DECLARED_RIGHT if d == lang else DECLARED_WRONG
        whole = F.lit(all_c[k] + sum(map(start, kinds))) - p
        seen = F.lit(None).cast("double")
        for d in kinds:
            seen = F.when(kind == d, F.lit(table.get(d, [0.0] * len(langs))[k] + start(d))).otherwise(seen)
        return F.log((seen - p) / whole)

    tiny = 1e-12  # sums of doubles may miss a page's own share by a rounding error
    scores = fresh(pages, *(f"s{k}" for k in range(len(langs))))
    scores = [f"_score{s}" for s in scores]
    judged = met.withColumns({s: F.col(t) + F.log(F.greatest(smoothed(k, x), F.lit(tiny))) + declaration(k, x) for k, (s, t, x) in enumerate(zip(scores, ts, langs))})

    def best(columns: list[str]) -> Column:
        """The language of the largest column; of equal ones the first."""
        return F.element_at(F.array(*map(F.lit, langs)), F.array_position(F.array(*columns), F.array_max(F.array(*columns))).cast("int"))

    high = F.greatest(*scores, F.lit(float("-inf")))
    mass = [F.exp(F.col(s) - high) for s in scores]
    return judged.select(*keep, best(scores).alias("lang"), (1 / sum(mass[1:], mass[0])).alias("confidence"), F.when(F.col(n) > 0, best(ts)).alias("text_lang"), F.col(said).alias("declared"), F.col(n).alias("n_trigrams"))


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    model = learn(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), model).drop("url")
