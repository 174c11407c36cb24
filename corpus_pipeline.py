"""From raw documents to packed training sequences: five stages, each a Parquet table for the next.

Quality: documents that the classifier rejects go. Lines: repeated long lines stay in one document. Near copies: of each
group, the document with the smallest id stays. Benchmarks: words inside benchmark windows are cut out of the text. Packing:
what is left becomes pieces of token sequences. Columns of documents that are named like an operator's results keep their
values.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontaminate, line_dedup, packing, quality, simhash
from tickloom.llm.common import fits, fresh, kept_only, numbered, tables, written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


#: Rows that go up to which their numbers are broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 500_000


def _aside(docs: DataFrame, *results: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns named like an operator's results renamed, and how to name them back."""
    clashing = [c for c in docs.columns if c.lower() in results]
    names = dict(zip(clashing, fresh(docs, *clashing)))
    return docs.withColumnsRenamed(names), {new: old for old, new in names.items()}


def _text_changed(before: DataFrame, after: DataFrame, back: dict[str, str], text: str = "text") -> DataFrame:
    """after's columns as before has them; n_chars follows the text."""
    if "n_chars" in before.columns:
        after = after.withColumn("n_chars", F.length(text).cast(before.schema["n_chars"].dataType))
    own = {old: new for new, old in back.items()}
    return after.select(*[F.col(own.get(c, c)).alias(c) for c in before.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows of docs outside the held-out fold, predicts as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    own, back = _aside(docs, "score", "predicted")
    good = quality.score(own, quality.train(docs, labels)).where("predicted = 1")
    return good.select(*own.columns).withColumnsRenamed(back)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the long lines that a document of larger id repeats."""
    own, back = _aside(docs, "n_lines", "n_dropped")
    return _text_changed(docs, line_dedup.drop_repeated_lines(own), back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more): that with the smallest
    id (of repeated rows one; of null ids alone one)."""
    row, first, group = fresh(docs, "row", "first", "group")
    told, before = numbered(docs, row), tables()
    grouped = simhash.group_near_copies(told.select("doc_id", row, "text"), width=5, similarity=True, row_col=row)
    grouped = written(grouped.select("doc_id", row, F.col("component_id").alias(group)), "grouped")
    kept_only(grouped, before)
    # Ids may repeat or be null, rows can't: the group's id picks candidates, the smallest row number decides among them.
    lead = grouped.where(F.col("doc_id").eqNullSafe(F.col(group))).groupBy("doc_id").agg(F.min(row).alias(first))
    gone = written(grouped.select(row).join(lead.select(F.col(first).alias(row)).hint("merge"), row, "left_anti"), "gone")
    return told.join(F.broadcast(gone) if fits(gone, BROADCAST_ROWS) else gone.hint("merge"), row, "left_anti").select(*docs.columns)


def cut_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words inside benchmark windows."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own, back = _aside(docs, "n_words", "n_hit", "item_ids", "spans")
    return _text_changed(docs, decontaminate.find_spans(own, items, cut=True), back)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs.select("doc_id", "text"), TOKENIZER)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", cut_benchmarks),
    ("packing", pack_sequences),
]
#: Shingle hashes, a fitted model and token ids aren't SQL; tests/llm/test_pipeline.py holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet in the shared folder and read again. What a stage has
    read goes when its result is written, and so do its operators' own tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = tables()
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        kept_only(docs, before)
    return docs
