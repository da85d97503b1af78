import os
import subprocess
import sys
import textwrap

import duckdb
import pytest

import __spark_entry__

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    from jobs import queries as jobs
    from sieveline.plans import catalog

    wrong = []
    for name, sql in (catalog.oracle_sql() | jobs.oracle_sql()).items():
        got, want = (catalog.queries() | jobs.queries())[name](spark, DATA), con.execute(sql)
        columns = [d[0] for d in want.description]
        if sorted(columns) != sorted(got.columns):
            wrong.append((name, "columns", sorted(columns), sorted(got.columns)))
            continue
        plain = lambda rows: sorted((tuple(_plain(v) for v in r) for r in rows), key=str)
        a, b = plain(tuple(r) for r in got.select(*columns).collect()), plain(want.fetchall())
        if a != b:
            wrong.append((name, "rows", [x for x in a if x not in b][:2], [x for x in b if x not in a][:2]))
    assert not wrong


def _plain(v):
    if isinstance(v, dict):
        return tuple(sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) if v is not None else None


def test_entry_runs(spark):
    if os.path.isdir(DATA):
        assert __spark_entry__.entry(spark).columns == ["query_id", "relevance"]


def test_every_sql_has_its_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_works_without_the_llm_subpackage(tmp_path):
    code = textwrap.dedent("""
        import sys
        import __spark_entry__ as e
        assert not any(m.startswith('sieveline.llm') for m in sys.modules), sys.modules
        assert {'relevance_topk', 'job1_article_intake', 'job2_weekly_collection'} <= set(e.queries()) and 'pipeline' not in e.queries(), sorted(e.queries())
        assert set(e.oracle_sql()) <= set(e.queries())
    """)
    for name in os.listdir(ROOT):
        if name.endswith(".py") and name != "corpus_pipeline.py":
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.symlink(f"{ROOT}/jobs", tmp_path / "jobs")
    (tmp_path / "sieveline").mkdir()
    for name in os.listdir(f"{ROOT}/sieveline"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/sieveline/{name}", tmp_path / "sieveline" / name)
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
