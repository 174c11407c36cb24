from collections import defaultdict

from tickloom.llm.line_dedup import drop_repeated_lines

BLANK = " \t\n\x0b\f\r"
LONG = "This line is long enough to be counted, é%d"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows):
    ids, n, last = defaultdict(set), defaultdict(int), {}
    for i, t in rows:
        if i is not None:
            for k in {key(x) for x in (t or "").split("\n")}:
                if len(k) >= 40:
                    ids[k].add(i)
                    n[k] = len(ids[k])
                    last[k] = max(last.get(k, i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or n[key(x)] < 5 or i >= last[key(x)]]
        out.append((i, "\n".join(kept) if kept != lines else t, len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_repeated_lines(df).collect()], key=str)


def test_against_brute_force(spark):
    rows = []
    for i in range(60):
        lines = [LONG % (i * j % 7) for j in range(i % 6)] + ["short"] + [("\t" + (LONG % 3).upper().replace("É", "é") + " \x0b") if i % 4 else ""]
        rows.append((i, "\n".join(lines)))
    rows += [(None, LONG % 1), (100, None), (101, ""), (102, "\n"), (59, LONG % 2), (59, LONG % 2), (103, "\n".join([LONG % 1] * 3)), (99, "\n".join([LONG % 1, "x", LONG % 1]))]
    assert run(spark, rows) == brute(rows)


def test_ids_that_repeat(spark):
    rows = [(7, LONG % 1)] * 3 + [(8, LONG % 1)] * 3 + [(i, LONG % 2) for i in (1, 1, 2, 3, 4, 5)]
    out = run(spark, rows)
    assert out == brute(rows) and sum(x[3] for x in out) == 5


def test_long_text(spark):
    rows = [(i, "\n".join([LONG % 1, "own %d" % i] * 20000)) for i in range(6)]
    assert run(spark, rows) == brute(rows)


def test_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "x", 3)], "doc_id long, text string, a string, n_lines int")
    out = drop_repeated_lines(df)
    assert out.columns == ["doc_id", "text", "a", "n_lines", "n_dropped"] and [tuple(r) for r in out.collect()] == [(1, "a", "x", 1, 0)]
    assert drop_repeated_lines(df.limit(0)).count() == 0


def test_no_python_in_plan(spark):
    plan = drop_repeated_lines(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
