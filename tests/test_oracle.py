"""Every registered query against its DuckDB oracle (what the driver checks), at sf0.001."""

import pytest

import __spark_entry__ as entry_module
from warbler import plans
from compare import compare, duck
from helpers import SF_SMALL

ORACLE = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_library_has_an_oracle():
    from warbler.plans import ORACLE_SQL, QUERIES as OWN
    assert set(OWN) == set(ORACLE_SQL)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["username", "iranElectionsMentionNumber", "iraniansMentionNumber"]
    assert df.count() == 16
