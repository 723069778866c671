"""Every named query against its reference SQL, and the shape of its plan."""

import compare
import pytest
from conftest import SF_DIR
from test_plans import check_plan

import __spark_entry__ as driver
from barlake.plans.oracles import ORACLES
from barlake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 1000 and "target_next_day_up" in df.columns
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) - set(ORACLES) == {"train_rf"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_reference_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    check_plan(df)
    result = df.toPandas()
    expected = con.execute(ORACLES[name]).df()
    assert compare.differences(result, expected) == ""
