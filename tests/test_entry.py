import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tickloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()



@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    key = lambda rows: sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
    clean = lambda r: tuple(None if v is None or v != v else int(v) if isinstance(v, float) and v.is_integer() else int(v) if hasattr(v, "as_tuple") else v for v in r)
    assert key([clean(r) for r in df.select(*columns).collect()]) == key([clean(r) for r in cur.fetchall()])


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.SQL) == set(catalog.QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_language_model_part(tmp_path):
    """The rest imports and lists its queries when tickloom/llm, tests/llm and corpus_pipeline.py are gone."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "tickloom"), tmp_path / "tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'bbo_board' in q and 'pipeline' not in q and not [n for n in q if n.startswith('op')]; e.oracle_sql(); print('fine')"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert done.stdout.strip().endswith("fine"), done.stderr
