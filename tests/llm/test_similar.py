import random

import corpus_pipeline as c
import pytest
from pyspark.sql import functions as F

from tickloom.llm import common, simhash
from tickloom.llm import similar as s
from tickloom.llm.common import written


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def want(rows):
    """All pairs: the smallest id of each document's component."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    low = {r: min((i for (i, _), x in zip(rows, root) if x == r and i is not None), default=None) for r in root}
    return sorted([(i, low[x]) for (i, _), x in zip(rows, root)], key=str)


def texts(seed, n):
    """Groups of copies with a few words changed, at all similarities about 0.8, and texts that share a passage."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(5000)}"
    passage, out = [word() for _ in range(40)], []
    for _ in range(n):
        base = [word() for _ in range(r.choice((3, 30, 80, 200)))]
        out += [" ".join(base), " ".join(passage + base)]
        for _ in range(r.choice((0, 1, 4, 12))):
            copy = list(base)
            for _ in range(r.randint(0, 1 + len(base) // 40)):
                copy[r.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("small,frequent,block", [(32, 3, s.BLOCK), (2, 3, s.BLOCK), (2, 10**9, s.BLOCK), (4, 3, 3), (2, 3, 7), (2, 10**9, 7)])
def test_groups_against_all_pairs(spark, monkeypatch, small, frequent, block):
    """With small blocks, frequent shingles are dealt among tasks, with and without the sample's word for it."""
    monkeypatch.setattr(s, "SMALL", small)
    monkeypatch.setattr(s, "BLOCK", block)
    monkeypatch.setattr(s, "AHEAD", 1 if small == 2 else s.AHEAD)
    monkeypatch.setattr(s, "FREQUENT", frequent)
    rows = [*enumerate(texts(3, 40)), (-1, None), (-2, " "), (None, "one two"), (900, "ONE\ttwo"), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("row", F.monotonically_increasing_id())
    got = simhash.group_near_copies(c.written(docs, "docs"), width=5, similarity=True, row_col="row")
    assert got.columns == ["doc_id", "row", "fingerprint", "component_id"]
    assert {r.fingerprint for r in got.where("doc_id = -1").collect()} == {"0" * 16}
    assert sorted([(r.doc_id, r.component_id) for r in got.collect()], key=str) == want(rows)


def test_rows_without_a_number_and_clashing_columns(spark):
    rows = [(1, "a b c d e f", 7), (2, "A b  c d e f", 8), (None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row long").withColumn("component_id", F.lit("x"))
    got = simhash.group_near_copies(docs, width=5, similarity=True)
    assert got.columns == ["doc_id", "row", "fingerprint", "component_id"]
    assert sorted([(r.doc_id, r.row, r.component_id) for r in got.collect()], key=str) == [(1, 7, 1), (2, 8, 1), (None, 9, None)]
    assert simhash.group_near_copies(docs.limit(0), width=5, similarity=True).count() == 0


def test_stage_drops_a_near_copy_beyond_three_bits(spark):
    """Similarity 0.84 over five words, fingerprints of three words far more than 3 bits apart."""
    words = [f"w{i}" for i in range(60)]
    copy = [*words[:30], "other", *words[31:]]
    docs = spark.createDataFrame([(2, " ".join(words)), (1, " ".join(copy)), (3, " ".join([*words[:10], "x", *words[11:40], "y", *words[41:]]))], "doc_id long, text string")
    assert [r.doc_id for r in c.drop_near_copies(spark, docs, "").orderBy("doc_id").collect()] == [1, 3]


def test_rounds_of_pairs(spark, monkeypatch):
    """Pairs told both ways round and twice, compared in rounds of few bytes: unlike texts don't link, like ones do once."""
    words = [f"w{i}" for i in range(60)]
    near, far = [*words[:30], "other", *words[31:]], [*words[:10], "x", *words[11:40], "y", *words[41:]]
    rows = [(i, " ".join(x)) for i, x in enumerate((words, near, far))]
    told = c.written(spark.createDataFrame(rows, "row long, text string"), "told")
    lead = spark.createDataFrame([(10 + i, i, len(s.shingles(t.encode())[1]), s.parities(s.shingles(t.encode())[1]).tolist()) for i, t in rows], "key long, row long, n long, parities array<long>")
    monkeypatch.setattr(s, "SKETCH", 64)  # so coarse that it sieves few
    pairs = spark.createDataFrame([(10, 11), (11, 10), (12, 10), (10, 12), (10, 12), (11, 12)], "a long, b long")
    for most in (1 << 20, 300):
        assert [tuple(r) for r in s._similar(pairs, lead, told, "row", "text", 5, most).collect()] == [(10, 11)]


def test_large_tables_go_in_rounds_and_shuffle_no_text(spark, monkeypatch):
    """With limits as small against these texts as the real ones are against gigabytes, the groups are the same, texts to compare
    are found by broadcast, and the table isn't copied."""
    rows = list(enumerate(texts(7, 8)))
    docs = c.written(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "docs")
    for name, value in (("BROADCAST_ROWS", 4), ("ROUND_BYTES", 1 << 15), ("SMALL", 2)):
        monkeypatch.setattr(s, name, value)
    plans = []

    def told(df, name, **options):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name, **options)

    for module in (s, common):
        monkeypatch.setattr(module, "written", told)
    got = simhash.group_near_copies(common.numbered(docs, "row"), width=5, similarity=True, row_col="row")
    assert sorted([(x.doc_id, x.component_id) for x in got.collect()], key=str) == want(rows)
    compared = [plan for name, plan in plans if name == "similar"]
    assert not any("SortMergeJoin" in plan for plan in compared)
    assert len(compared) >= 3 and "rows" not in dict(plans) and "sets" not in dict(plans)


def test_written_leaves_no_shuffle_files(spark):
    shuffles = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    was = shuffles()
    kept = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(kept.collect()) == 7 and shuffles() > was
    was = shuffles()
    assert written(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count(), "counts").count() == 7
    assert shuffles() <= was + 1  # that of count()


def test_numbers_of_rows(spark):
    docs = written(spark.range(100).repartition(4), "docs")
    told = common.numbered(docs, "n")
    assert told.columns == ["id", "n"] and told.select("n").distinct().count() == 100
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, told.repartition(3).collect()))
    assert common.numbered(docs.where("id < 7"), "n").select("n").distinct().count() == 7
    assert common.numbered(docs.limit(0), "n").isEmpty()


@pytest.mark.parametrize("n", [6, 24])
def test_texts_are_read_once_however_many(spark, monkeypatch, n):
    """A call compares all its pairs in one reading of the texts, also if they are far more than a broadcast may name."""
    docs = c.written(spark.createDataFrame(list(enumerate(texts(5, n))), "doc_id long, text string").repartition(3), "docs")
    for name, value in (("BROADCAST_ROWS", 4), ("BROADCAST_SHINGLES", 4), ("ROUND_BYTES", 1 << 10), ("SMALL", 2)):
        monkeypatch.setattr(s, name, value)
    calls, readings, similar = [], [], s._similar
    monkeypatch.setattr(s, "_similar", lambda *a: calls.append(a) or similar(*a))
    monkeypatch.setattr(s, "written", lambda df, name, **o: readings.append(name) or written(df, name, **o))
    simhash.group_near_copies(common.numbered(docs, "row"), width=5, similarity=True, row_col="row")
    assert len(calls) == readings.count("similar") == 3


def test_units_of_large_groups(spark, monkeypatch):
    """Groups of more texts, or longer ones, than a unit takes are dealt by pairs of blocks; each text goes where its pairs go."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[: 5 * i], f"x{i}", *words[5 * i + 1 :]])) for i in range(12)] + [(90, " ".join(f"v{i}" for i in range(60)))]
    told = c.written(spark.createDataFrame(rows, "row long, text string"), "told")
    sets = {i: s.shingles(t.encode())[1] for i, t in rows}
    lead = spark.createDataFrame([(100 + i, i, len(x), s.parities(x).tolist()) for i, x in sets.items()], "key long, row long, n long, parities array<long>")
    pairs = [(100 + i, 100 + j) for i in sets for j in sets if i < j]
    common_n = lambda a, b: len(set(sets[a - 100].tolist()) & set(sets[b - 100].tolist()))
    right = [(a, b) for a, b in pairs if 5 * common_n(a, b) >= 4 * (len(sets[a - 100]) + len(sets[b - 100]) - common_n(a, b))]
    assert right and len(right) < len(pairs)
    for texts_of, shingles_of, most, rows_few in ((64, 1 << 20, 1 << 20, 100), (3, 1 << 20, 1 << 20, 100), (64, 120, 2000, 2)):
        for name, value in (("UNIT_TEXTS", texts_of), ("UNIT_SHINGLES", shingles_of), ("BROADCAST_ROWS", rows_few)):
            monkeypatch.setattr(s, name, value)
        got = s._similar(spark.createDataFrame(pairs, "a long, b long"), lead, told, "row", "text", 5, most)
        assert sorted(map(tuple, got.collect())) == right


def test_rows_found_by_marks(spark, monkeypatch):
    numbers = [-(1 << 40), -32769, -5, 0, 7, 8, 32767, 32768, (3 << 33) + 9]
    told = spark.createDataFrame([(x + d, str(x)) for x in numbers[:5] + numbers[6:] for d in (0, 1 << 20)], "row long, text string")
    rows = c.written(spark.createDataFrame([(x,) for x in numbers], "row long"), "wanted")
    for few, marks in ((True, 4096), (False, 4096), (False, 1)):
        monkeypatch.setattr(s, "MARKS", marks)
        assert sorted(r.row for r in s._found(told, rows, "row", few).collect()) == sorted({x for x in numbers if x != 8})
