"""Queries against their DuckDB SQL."""
import pytest

pytest.importorskip("keepwise.llm.queries")
from oracle_harness import compare, duck  # noqa: E402

from keepwise.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).execute(ORACLE[name]).df(), tol=1e-9) == []
