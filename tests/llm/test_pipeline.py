import corpus_pipeline as c
from pyspark.sql import functions as F

from tickloom.llm import quality
from tickloom.llm.common import tables

from .test_decontaminate import brute as brute_hits
from .test_line_dedup import brute as brute_lines
from .test_packing import holds
from .test_similar import want as brute_groups

SF = "/root/testdata/sf0.001"


def test_pipeline_against_plain_python(spark, tmp_path):
    names = [n for n, _ in c.STAGES]
    assert names == ["quality", "line_dedup", "near_copies", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for n, stage in c.STAGES:
        stage(spark, tables[-1], SF).write.parquet(f"{tmp_path}/{n}")
        tables.append(spark.read.parquet(f"{tmp_path}/{n}"))
        assert n == "packing" or tables[-1].dtypes == docs.dtypes
    rows = [{r.doc_id: r for r in t.collect()} for t in tables[:-1]]
    labels = spark.read.parquet(f"{SF}/labels.parquet")

    model = quality.train(docs, labels)
    good = {r.doc_id for r in rows[0].values() if model.score(quality.np.array([quality.statistics(r.text.encode())]))[0] >= 0.3}
    assert set(rows[1]) == good and 0 < len(good) < len(rows[0])
    assert all(rows[0][i] == r for i, r in rows[1].items())

    lines = {i: t for i, t, _, _ in brute_lines([(r.doc_id, r.text) for r in rows[1].values()])}
    assert {i: r.text for i, r in rows[2].items()} == lines

    groups = brute_groups([(r.doc_id, r.text) for r in rows[2].values()])
    assert set(rows[3]) == {g for _, g in groups} and all(rows[2][i] == r for i, r in rows[3].items())

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    changed = 0
    for i, r in rows[3].items():
        n, hit, _, _ = brute_hits(r.text, items, 10) if any(t[:40].lower() in r.text.lower() for _, t in items) or i % 9 == 0 else (0, None, [], set())
        if hit is not None:
            after = rows[4][i].text
            assert (after == r.text) == (hit == 0) and brute_hits(after, [], 10)[0] == n - hit
            changed += hit > 0
    assert changed and all(r.n_chars == len(r.text) for r in rows[4].values())
    holds([tuple(r) for r in tables[-1].collect()], [(r.doc_id, r.text) for r in rows[4].values()])


def test_columns_named_like_results_keep_their_values(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    own = ["score", "predicted", "n_lines", "n_dropped", "n_words", "n_hit", "item_ids", "Spans", "component_id", "fingerprint", "_row", "_raw", "row"]
    at = docs.select("*", *[F.concat(F.lit(f"{n}:"), F.col("doc_id").cast("string")).alias(n) for n in own])
    columns = at.columns
    for name, stage in c.STAGES[:-1]:
        stage(spark, at, SF).write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        assert at.columns == columns
        assert at.where(" OR ".join(f"{n} != concat('{n}:', doc_id)" for n in own)).isEmpty() and not at.isEmpty()


def test_run(spark):
    before = tables()
    assert c.run(spark, SF).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert len(tables() - before) == 1  # the last stage's table


def test_hard_rows(spark, tmp_path):
    rows = [(1, None, 9, "x"), (1, "", 0, None), (None, "same words here", 1, "y"), (None, "same words here", 1, "y"), (5, "same words here", 1, "y"), (7, "w " * 50_000, 2, "z"), (7, "w " * 50_000, 2, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long, print string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "same words here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = docs
    for name, stage in c.STAGES:
        at = stage(spark, at, str(tmp_path))
        if name == "near_copies":
            assert sorted([(r.doc_id, r.text) for r in at.collect()], key=str) in ([(1, ""), (5, "same words here"), (7, "w " * 50_000)], [(1, None), (5, "same words here"), (7, "w " * 50_000)])
        assert name == "packing" or at.columns == docs.columns
    assert at.agg(F.sum("length")).first()[0] == 1 + 1 + 50_001
    for name, stage in c.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
