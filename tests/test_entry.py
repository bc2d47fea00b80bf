"""Driver contract: entry() runs, every query has a callable, and the queries
agree with their DuckDB oracles on sf0.001 (the driver checks sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF0001
from crawlstats.plans import queries as registry

def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["token", "n"] and df.count() == 50


def test_import_opens_no_jar(tmp_path):
    """The entry imports where Spark's jar folder is not beside pyspark."""
    import pathlib
    import subprocess
    import sys

    code = (
        "import pathlib, zipfile\n"
        "def gone(*a, **k): raise FileNotFoundError('no jars here')\n"
        "pathlib.Path.glob = gone; zipfile.ZipFile.__init__ = gone\n"
        "import __spark_entry__ as e; assert len(e.queries()) >= 32 and len(e.oracle_sql()) >= 32"
    )
    root = str(pathlib.Path(__file__).resolve().parents[1])
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_registry_shapes():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(registry.queries()) >= 48
    assert set(registry.oracle_sql()) == set(registry.queries())
    assert all(callable(f) for f in qs.values())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = E.queries()[name](spark, SF0001)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    exp_rows = rel.fetchall()
    idx = [rel.columns.index(c) for c in cols]
    exp = sorted(tuple(str(row[i]) for i in idx) for row in exp_rows)
    assert got == exp


def test_scratch_can_be_released(spark):
    import os

    from crawlstats import config

    kept = config._MADE.pop(spark.sparkContext.applicationId, [])  # folders of other tests
    try:
        E.queries()["state_store"](spark, SF0001).collect()
        made = list(config._MADE[spark.sparkContext.applicationId])
        assert made and all(os.path.isdir(p) for p in made)
        config.release(spark)
        assert not any(os.path.exists(p) for p in made)
    finally:
        config._MADE[spark.sparkContext.applicationId] = kept
