"""Line deduplication in DataFrame functions alone: explode, hash, count documents per hash, drop, reassemble by position.

Two passes over the texts. The first sends one row per distinct long line and document to a count per hash, after partial
aggregation, so a line that a third of all documents hold reaches its reducer as one row per task. The second joins the
surviving hashes (a few of all) back to the exploded lines; those hashes are copied SALTS times, so that the lines of a hot
one are dealt among as many tasks. Dropped positions are collected per document, whose length bounds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, fresh

#: Copies of each repeated hash, among which its lines are dealt.
SALTS = 32


def line_key(line: Column) -> Column:
    """A line's identity: blanks stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _hashes(key: Column) -> Column:
    """128 bits in two longs, so that no collision is to be expected among 10^15 lines."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit("line"), key).alias("b"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """docs with repeated lines taken out of text_col, and columns n_lines (before) and n_dropped.

    A key of at least min_chars code points found in at least min_docs documents loses all its lines, except those in the
    document with the largest id that holds it; there every occurrence stays. Other lines stay, joined by "\\n".

    Defined cases: a null text is one empty line and stays null unless lines are dropped (none can be); an empty table gives
    an empty table; rows of one id count as one document and, sharing the largest id, all keep the line; a row with a null id has no place in the order: its lines neither count nor go; other columns pass through,
    those named n_lines or n_dropped are replaced.
    """
    text, lines, digest, h, n, last, drops, pos, line, salt = fresh(docs, "text", "lines", "digest", "h", "n", "last", "drops", "pos", "line", "salt")
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    long = lambda x: F.length(F.btrim(x, F.lit(BLANKS))) >= min_chars
    known = docs.where(F.col(id_col).isNotNull() & (F.length(text_col) >= min_chars))

    # Where no id repeats, rows are documents, and counting them keeps to one shuffle with partial sums.
    ids = docs.select(F.col(id_col).alias(text)).where(F.col(text).isNotNull())
    repeats = not ids.groupBy(text).count().where("count > 1").isEmpty()
    hashes = F.array_distinct(F.transform(F.filter(split, long), lambda x: _hashes(line_key(x))))
    repeated = (
        known.select(F.col(id_col).alias(last), F.explode(hashes).alias(h))
        .groupBy(F.col(f"{h}.a").alias("a"), F.col(f"{h}.b").alias("b"))
        .agg((F.countDistinct(last) if repeats else F.count(F.lit(1))).alias(n), F.max(last).alias(last))
        .where(F.col(n) >= min_docs)
        .select("a", "b", last, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt))
    )
    text_digest = F.struct(F.xxhash64(text_col).alias("a"), F.xxhash64(F.lit("text"), F.col(text_col)).alias("b"))
    places = (
        known.select(F.col(id_col).alias(text), text_digest.alias(digest), F.posexplode(split).alias(pos, line))
        .where(long(F.col(line)))
        .select(text, digest, pos, _hashes(line_key(F.col(line))).alias(h))
        .select(text, digest, pos, F.col(f"{h}.a").alias("a"), F.col(f"{h}.b").alias("b"), F.pmod(F.xxhash64(text, pos), F.lit(SALTS)).cast("int").alias(salt))
    )
    gone = (
        places.join(repeated, ["a", "b", salt])
        .where(F.col(text) < F.col(last))
        .groupBy(F.col(text), F.col(digest))
        .agg(F.collect_set(pos).alias(drops))
    )
    # The split lines travel through the join in the text's place: a lambda that split anew would do so for each line.
    left = docs.withColumns({lines: F.split(text_col, "\n", -1), digest: text_digest}).drop(text_col)
    left = left.withColumnRenamed(digest, line)
    joined = left.join(gone, (left[id_col] == gone[text]) & (left[line] == gone[digest]), "left")
    places_kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(drops))
    kept = F.when(F.col(drops).isNull(), F.array_join(lines, "\n")).otherwise(F.array_join(F.transform(places_kept, lambda i: F.get(F.col(lines), i)), "\n"))
    results = {"n_lines": F.when(F.col(lines).isNull(), 1).otherwise(F.size(lines)).cast("long"), "n_dropped": F.when(F.col(drops).isNull(), 0).otherwise(F.size(drops)).cast("long")}
    passed = [kept.alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c not in results]
    return joined.select(*passed, *[v.alias(k) for k, v in results.items()])


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_repeated_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP6_SQL = """
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id < r.last AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
