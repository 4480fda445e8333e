"""Every query against its SQL in DuckDB, and the entry module with and without the llm folders."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from tidemill.plans import queries

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.10g}"
    if isinstance(v, list):
        return str([plain(x) for x in v])
    return str(v)


def same(spark, duck, run, sql):
    df = run(spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query(spark, duck, name):
    same(spark, duck, queries.QUERIES[name], queries.ORACLES[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_llm(tmp_path):
    """The rest imports and works once the llm folders and the pipeline are deleted."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(n.startswith('op1') for n in q) and len(q) > 60; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env=os.environ | {"PYTHONPATH": str(tmp_path / "repo")}, timeout=120)
