"""Every registered query against its oracle: on the smallest tables, models on larger ones."""

import subprocess
import sys

import duckdb
import pytest
from __spark_entry__ import entry, oracle_sql, queries
from check import rows_of

from workload.adapters import TABLES
from workload.registry import ORACLES, QUERIES

# models need more patients than the smallest tables have to converge
FOLDERS = {name: "/root/testdata/sf0.01" if name.startswith("glm_") else "/root/testdata/sf0.001" for name in QUERIES}


@pytest.fixture(scope="module")
def connections():
    out = {}
    for folder in set(FOLDERS.values()):
        out[folder] = duckdb.connect()
        for table in TABLES:
            out[folder].execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return out


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connections, name):
    folder = FOLDERS[name]
    frame = QUERIES[name](spark, folder)
    got = [tuple(r) for r in frame.collect()]
    result = connections[folder].execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, got) == rows_of(names, result.fetchall())


def test_entry_holds_all_queries():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_workers_need_no_package(tmp_path):
    """From another folder and without the repository on the workers' path."""
    root = __file__.rsplit("/", 2)[0]
    script = f"""
import os, sys
os.environ.pop("PYTHONPATH", None)
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from cohortspark.session import local_session
spark = local_session("2", **{{"spark.sql.warehouse.dir": {str(tmp_path / "warehouse")!r}}})
print("ROWS", e.queries()["anova_p"](spark, "/root/testdata/sf0.001").count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True)
    assert "ROWS 2" in done.stdout, done.stderr[-2000:]
