"""URL allow and block lists by hashed host-suffix and path-prefix expressions.

Each distinct URL is expanded into host suffixes x path prefixes, of the lengths that rules have; an equi-join on the first
32 bits of SHA-256 finds candidates, the full digest confirms them, and the longest confirmed rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, fresh

#: Rules up to this count and these bytes are broadcast; beyond, both sides are dealt by hash prefix and salt.
BROADCAST_RULES, BROADCAST_BYTES = 50_000, 8 << 20
#: Copies of each rule, among which the rows of a hot expression (a top-level domain, say) are dealt.
SALTS = 16

#: Fixed values: (host, path, action).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, action string")


def split_url(df: DataFrame, url_col: str, host: str, path: str) -> DataFrame:
    """Adds host (after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased) and path (then up to "?", "#" or the
    end); both empty for a null URL or one without "://"."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return df.withColumns({host: ascii_lower(raw), path: F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)})


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """df with columns host, path, rule (host and path of the deciding rule, null if none fits) and verdict.

    A rule fits its host and all subdomains if the URL's path starts with the rule's. The longest (host and path together)
    wins; ties go to the longer host, then to block. A repeated rule with both actions blocks. Rules with a null host or
    path never fit. A null or malformed URL has empty host and path and takes the default. Repeated rows each get their
    verdict; other columns pass through, those named like results are replaced; empty tables give empty tables.
    """
    url, host, path, expr, salt, best = fresh(df, "url", "host", "path", "expr", "salt", "best")
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).select(
        F.concat("host", "path").alias("rule"), F.length("host").alias("host_len"), F.length("path").alias("path_len"), "action"
    ).groupBy("rule").agg(F.max("host_len").alias("host_len"), F.max("path_len").alias("path_len"), F.max("action").alias("action"))
    # Lengths of rules' hosts and paths: at most 255 and a few thousand values, however many rules there are.
    lengths = rules.agg(F.array_sort(F.collect_set("host_len")).alias("h"), F.array_sort(F.collect_set("path_len")).alias("p"), F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("rule")).alias("bytes")).first()
    digest = F.sha2("rule", 256)
    rules = rules.withColumns({"full": digest, "prefix": F.substring(digest, 1, 8)})

    urls = split_url(df.select(F.coalesce(F.col(url_col), F.lit("")).alias(url)).distinct(), url, host, path)
    n = F.length(host)
    # A suffix of m characters starts a label if it is the whole host or a dot stands before it.
    fit = lambda m: (m == n) | ((m < n) & (F.substring(F.col(host), n - m, F.lit(1)) == "."))
    suffixes = F.transform(F.filter(F.array(*map(F.lit, lengths["h"])).cast("array<int>"), fit), lambda m: F.substring(F.col(host), n - m + 1, m))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths["p"])).cast("array<int>"), lambda m: m <= F.length(path)), lambda m: F.substring(F.col(path), F.lit(1), m))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    asked = urls.where(n > 0).select(url, F.explode(expressions).alias(expr)).withColumn(expr, F.sha2(expr, 256))
    prefix = F.substring(expr, 1, 8)
    if lengths["n"] <= broadcast_rules and (lengths["bytes"] or 0) <= BROADCAST_BYTES:
        hits = asked.join(F.broadcast(rules), prefix == rules.prefix)
    else:
        dealt = rules.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        asked = asked.withColumn(salt, F.pmod(F.xxhash64(url), F.lit(SALTS)).cast("int"))
        hits = asked.join(dealt, (prefix == dealt.prefix) & (asked[salt] == dealt[salt]))
    order = F.struct(F.length("rule"), F.col("host_len"), F.col("action"), F.col("rule"))
    decided = hits.where(F.col(expr) == F.col("full")).groupBy(url).agg(F.max_by(F.struct("rule", "action"), order).alias(best))
    judged = df.join(decided, F.coalesce(df[url_col], F.lit("")) == decided[url], "left")
    judged = split_url(judged, url_col, host, path)
    keep = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    return judged.select(*keep, F.col(host).alias("host"), F.col(path).alias("path"), F.col(f"{best}.rule").alias("rule"), F.coalesce(f"{best}.action", F.lit(default)).alias("verdict"))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, rule_table(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r(rule, rhost, rpath, action) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
m AS (SELECT p.*, r.rule, r.action, row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC) AS rn
      FROM p LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE rn = 1
"""
