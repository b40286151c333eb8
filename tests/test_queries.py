"""Registered queries beside their SQL, on the smallest tables, and after the optional subpackage is gone."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from quern.plans import catalog

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def shown(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    cell = lambda v: "" if v is None or v != v else repr(round(float(v), 6)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    got, want = __spark_entry__.queries()[name](spark, DATA).toPandas(), db.execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert shown(got) == shown(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_queries_without_sql_run(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py"))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert len(q) > 30 and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"], cwd=tmp_path / "r", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
