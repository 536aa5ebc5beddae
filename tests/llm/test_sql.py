import compare
import pytest

from notewright.llm.queries import QUERIES, SQL
from notewright.plans.registry import Query


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, small_sf, name, sf):
    folder = small_sf.replace("sf0.001", sf)
    assert compare.difference(spark, compare.connect(folder), Query(name, QUERIES[name], SQL[name]), folder) is None
