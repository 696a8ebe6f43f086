"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, compare  # noqa: E402

from lamina.catalogue import all_queries, all_sql  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, twin, name):
    ok, note = compare(spark, twin, str(FOLDER), name)
    assert ok, note
    assert "types" not in note, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
