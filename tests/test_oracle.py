"""Every registered query equals its DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from lading.plans import registry
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
SLOW = {"fact_partitioned", "fact_pruned_read"}  # thousands of daily folders; covered in test_layout


@pytest.fixture(scope="module")
def duck():
    from oracle.compare import duck_connection
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLE and n not in SLOW))
def test_query_matches_oracle(spark, duck, name):
    from oracle.compare import compare
    df = QUERIES[name](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    cur = duck.execute(ORACLE[name])
    msgs = compare(cols, rows, [d[0] for d in cur.description], cur.fetchall())
    assert not msgs, msgs


def test_every_query_has_an_oracle():
    # sketches are random; their rank error is tested in test_scale_forms
    assert set(registry.QUERIES) - set(ORACLE) == {"carrier_lead_time_sketch"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "otif_flag" in df.columns
