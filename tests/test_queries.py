import pytest

from inkmill.plans.oracles import ORACLES
from inkmill.plans.queries import QUERIES
from tests.compare import SF, rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert rows_of(QUERIES[name](spark, SF)) == rows_of_sql(ORACLES[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
