"""Every registered query against its DuckDB twin on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

from conftest import SF
from xmarket import catalogue

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from oracle import plain  # noqa: E402


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*' if p.is_dir() else ''}')")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    want = db.execute(catalogue.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    got = catalogue.queries()[name](spark, SF).toPandas()
    assert len(got) and len(set(got.columns)) == len(got.columns)
    assert not got.isna().all(axis=None)


def test_entry_runs():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
