import pytest

from oracle import assert_same
from tidebook.plans import io_queries  # noqa: F401
from tidebook.plans.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, sf_dir, name):
    if name in ORACLE_SQL:
        assert_same(spark, sf_dir, QUERIES[name], ORACLE_SQL[name])
    else:
        assert QUERIES[name](spark, sf_dir).count() > 0
