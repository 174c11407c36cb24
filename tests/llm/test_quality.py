import zlib

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_statistics():
    s = dict(zip(q.STATISTICS, q.statistics(b"AB!! ab ab | c\nab ab 12")))
    assert s["words"] == np.log1p(8) and s["upper"] == 2 / 11 and s["repeats"] == 2 / 8 and s["single_words"] == 2 / 8
    assert s["distinct_words"] == 5 / 8 and s["lines"] == 1 / 8 and s["digits"] == 2 / 23 and s["shouts"] == 2 / 23 and s["marked_words"] == 2 / 8
    assert q.statistics(b"") == q.statistics(b" \n") == [0.0] * len(q.STATISTICS)


def test_lasso_against_coordinate_search():
    r = np.random.default_rng(1)
    a = r.integers(0, 2, (400, 6)).astype(float)
    y = (r.random(400) < 1 / (1 + np.exp(1 - 3 * a[:, 0] + 2 * a[:, 1]))).astype(float)
    loss = lambda w, b, p: np.mean(np.log1p(np.exp(a @ w + b)) - y * (a @ w + b)) + p * np.abs(w).sum()
    w, b = q.lasso_logistic(a, y, 0.02, 3000)
    best = loss(w, b, 0.02)
    for k in range(7):
        for d in (1e-3, -1e-3):
            v, c = w.copy(), b
            if k < 6:
                v[k] += d
            else:
                c += d
            assert loss(v, c, 0.02) >= best - 1e-9
    assert w[0] > 0 > w[1] and (np.abs(w[2:]) < 0.3).all() and (w == 0).any()
    assert not q.lasso_logistic(a, y, 10.0)[0].any()


def test_rules_find_a_conjunction():
    r = np.random.default_rng(2)
    x = r.random((3000, 4))
    y = ((x[:, 0] > 0.6) & (x[:, 2] <= 0.5)).astype(int)
    model = q.fit(x, y)
    fresh = r.random((2000, 4))
    want = (fresh[:, 0] > 0.6) & (fresh[:, 2] <= 0.5)
    assert ((model.score(fresh) >= 0.5) == want).mean() > 0.97
    assert q.fit(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert q.fit(x, np.ones(3000, int)).score(x[:1])[0] > 0.99


def test_compiled_rules_equal_model(spark):
    r = np.random.default_rng(3)
    x = r.random((500, len(q.STATISTICS)))
    model = q.fit(x, (x[:, 1] + x[:, 5] > 1).astype(int))
    df = spark.createDataFrame([tuple(map(float, v)) for v in x], ", ".join(f"c{k} double" for k in range(x.shape[1])))
    got = [v.s for v in df.select(model.column([F.col(c) for c in df.columns]).alias("s")).collect()]
    assert np.allclose(got, model.score(x), rtol=0, atol=1e-12)


def test_held_out_quality(spark):
    got = q.op9_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(got) > 50 and (got.predicted == got.quality).mean() >= 0.97
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() > 0.98


def test_fold_and_whole_table(spark):
    got = {r.doc_id: r for r in q.op9_quality(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())


def test_labels_of_the_fold_are_unseen(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert q.train(docs, labels) == q.train(docs, turned)


def test_hard_rows(spark):
    rows = [(1, None, "p", 1.0), (1, "", "q", None), (None, "A B!! " * 100_000, None, 2.0), (2, "plain text", "r", 3.0), (2, "plain text", "r", 3.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _s1 string, score double")
    labels = spark.createDataFrame([(2, 1), (2, 0), (None, 0), (1, None), (77, 7)], "doc_id long, quality int")
    out = q.score(df, q.train(df, labels)).collect()
    assert len(out) == 5 and out[0].asDict().keys() == {"doc_id", "text", "_s1", "score", "predicted"} and all(0 <= r.score <= 1 for r in out)
    empty = df.limit(0)
    assert q.score(empty, q.train(empty, labels.limit(0))).count() == 0
