import pytest

from barlake.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_DIR
import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_reference_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = compare.connect(SF_DIR).execute(ORACLES[name]).df()
    assert compare.differences(found, expected) == ""
