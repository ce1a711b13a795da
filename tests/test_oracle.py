"""Every SQL-checkable query against its independent DuckDB formulation."""
import pytest

from keepwise.plans.catalog import ORACLE, QUERIES, load_all
from oracle_harness import compare, duck

load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 60


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLE[name]).df()
    problems = compare(got, want)
    assert not problems, problems
