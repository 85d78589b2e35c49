import pytest
from compare import assert_same

from oceanloom.plans.oracles import ORACLES
from oceanloom.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(name, spark, duck, sf_dir):
    assert_same(QUERIES[name](spark, sf_dir), duck, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).limit(1).count() == 1
