"""Every named query against its SQL in a second engine, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_sql  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from eventlake.plans import registry, sql, streams  # noqa: E402, F401 - streams adds its queries


@pytest.fixture(scope="module")
def duck(sf):
    return check_sql.duck(sf)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(sql.ORACLE)
    assert set(registry.QUERIES) <= set(entry_points.queries())


def test_entry_runs(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:4] == ["ref_date", "bank_id", "insurer_id", "consent_type"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    assert check_sql.compare(spark, duck, name, sf) is None
