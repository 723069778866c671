"""What the physical plans of the named queries must and must not contain."""

import re

import pytest
from conftest import SF_DIR

from barlake.plans.queries import QUERIES
from barlake.operators import features
from barlake.sources import tables

# HotSpot does not compile longer methods, which would run interpreted.
LARGEST_METHOD = 8000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def check_plan(df):
    """No pairing of rows, no unpartitioned window, no Python in any task."""
    plan = plan_of(df)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:  # only below a global aggregate
            below = next(x for x in lines[i + 1 :] if "InputAdapter" not in x)
            assert "partial_" in below or "Aggregate" in below or "Project" in below, line
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"windowspecdefinition\((?!\w+#)", line), line


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(QUERIES["market_features"](spark, SF_DIR))
    read = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "l_tax" not in read and "l_partkey" not in read
    scored = plan_of(tables.scored_documents(spark, SF_DIR))
    assert "text" not in re.search(r"FileScan parquet \[([^\]]*n_chars[^\]]*)\]", scored).group(1)


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["scan_event_bars"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,purchase\)", plan)


def test_features_cost_one_exchange_after_the_bars(spark):
    plan = plan_of(features.market_features(tables.line_bars(spark, SF_DIR)))
    assert plan.count("Exchange hashpartitioning") == 2
    assert len(re.findall(r"\+- Sort ", plan)) == 1
    assert "SortAggregate" not in plan


@pytest.mark.parametrize(
    "name", ["market_features", "market_features_wide", "evaluate_model", "contract_violations",
             "raw_contract_lines", "feature_contract", "feature_correlation", "batch_scoring"]
)
def test_generated_methods_can_be_compiled(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = QUERIES[name](spark, SF_DIR)
        code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < LARGEST_METHOD
