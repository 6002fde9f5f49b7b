"""Every query with a SQL twin gives the same rows as DuckDB."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check  # noqa: E402

from legwork.registry import load  # noqa: E402

SF = "/root/testdata/sf0.001"
ENTRIES = load()


@pytest.fixture(scope="module")
def con():
    return check.oracle(SF)


@pytest.mark.parametrize("name", [n for n, e in ENTRIES.items() if e.sql])
def test_same_as_sql(spark, con, name):
    _, _, verdict = check.compare(spark, con, name, ENTRIES[name], SF)
    assert verdict.startswith("ok"), verdict


def test_entry_module():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
