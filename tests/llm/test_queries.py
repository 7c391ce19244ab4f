"""Registered queries of the subpackage against their oracle SQL, and their absence."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from latticework.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]
SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "conversations", "labels", "embeddings", "benchmark"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    want = con.sql(ORACLES[name])
    assert columns == sorted(want.columns)
    order = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in want.fetchall()), key=repr)
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == expected
    assert expected


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_the_rest_works_without_this_subpackage(tmp_path):
    for name in ("latticework", "__spark_entry__.py"):
        copy = shutil.copytree if (ROOT / name).is_dir() else shutil.copy
        copy(ROOT / name, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm")} if (ROOT / name).is_dir() else {}))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and 'pipeline' not in q; print(len(q))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert ran.returncode == 0, ran.stderr
