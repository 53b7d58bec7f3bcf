"""Every registered key with an oracle statement against DuckDB on sf0.001."""

import os
import sys

import pytest

if os.path.isdir("/opt/oracle"):
    sys.path.append("/opt/oracle")
duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as E  # noqa: E402
from bayesmill.plans import registry  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings labels".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 5)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_key_matches_oracle(spark, con, key):
    df = registry.queries()[key](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(registry.oracle_sql()[key])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_every_key_registered():
    assert len(registry.queries()) == 70 and len(registry.oracle_sql()) == 66
    assert set(registry.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "label"]
    assert df.count() >= 0


def test_default_stop_words_are_sparks_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    from bayesmill.functions.stopwords import raw_stop_words

    assert list(raw_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_entry_imports_without_spark_jars(tmp_path):
    """Importing the entry and building every statement opens no file of the Spark installation."""
    import builtins
    import subprocess

    code = """
import builtins, io, zipfile, glob
real = builtins.open
def guarded(f, *a, **k):
    assert "pyspark/jars" not in str(f), f
    return real(f, *a, **k)
builtins.open = io.open = guarded
glob.glob = lambda *a, **k: []
import __spark_entry__ as E
assert len(E.oracle_sql()) >= 54 and len(E.queries()) >= 57
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
    assert builtins.open
