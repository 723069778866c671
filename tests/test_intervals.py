"""Interval sweeps, checks while writing, correlations with holes and corner points against plain loops."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from conftest import bars_of, predictions_of, valid_bars, valid_features
from pyspark.sql import functions as F

from barlake.functions.scratch import scratch_path
from barlake.operators import contracts as C
from barlake.operators import correlation, intervals, metrics, reports
from barlake.schemas import DataContractError

T0 = dt.datetime(2024, 1, 1)


def minute(n):
    return None if n is None else T0 + dt.timedelta(minutes=n)


@pytest.mark.parametrize("seed, rows, spans, width", [(1, 300, 60, 40), (2, 400, 300, 3), (3, 50, 10, 900), (4, 200, 0, 1)])
def test_intervals_equal_plain_loops(spark, seed, rows, spans, width):
    rng = random.Random(seed)
    # Few times and one hot key: many rows and edges stand at the same place.
    ticks = [(rng.choice(["A", "A", "A", "B", None]), minute(rng.choice([*range(0, 500, 2), None])), i) for i in range(rows)]
    found = []
    for i in range(spans):
        a = rng.randrange(500)
        found.append((rng.choice(["A", "B", "C"]), i, minute(a), minute(a + rng.randrange(-2, width))))
    found += [("A", 900, None, minute(9)), ("A", 901, minute(1), None)] if spans else []
    df = spark.createDataFrame(ticks, "symbol string, Date timestamp_ntz, n int")
    table = spark.createDataFrame(found, "symbol string, interval_id int, start timestamp_ntz, end timestamp_ntz")
    cover = {
        n: [i for s, i, a, b in found if s == symbol and t is not None and a is not None and b is not None and a <= t < b]
        for symbol, t, n in ticks
    }
    assert {r["n"]: r[intervals.OPEN] for r in intervals.open_intervals(df, table).collect()} == {n: len(c) for n, c in cover.items()}
    assert sorted(r["n"] for r in intervals.rows_outside(df, table).collect()) == sorted(n for n, c in cover.items() if not c)
    inside = sorted((r["n"], r["interval_id"]) for r in intervals.rows_inside(df, table).collect())
    assert inside == sorted((n, i) for n, c in cover.items() for i in c)


def test_one_long_interval_over_many_blocks(spark):
    df = spark.range(3000).select(F.lit("A").alias("symbol"), F.col("id").alias("Date"))
    table = spark.createDataFrame([("A", 1, 5, 2900), ("A", 2, 700, 701)], "symbol string, interval_id int, start long, end long")
    counts = {r["interval_id"]: r["count"] for r in intervals.rows_inside(df, table).groupBy("interval_id").count().collect()}
    assert counts == {1: 2895, 2: 1}


def test_tasks_grow_with_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(intervals, "PAIRS_A_TASK", 2000, raising=False)
    df = spark.range(6000).select(F.lit("A").alias("symbol"), F.col("id").alias("Date"))
    table = spark.range(20).select(F.lit("A").alias("symbol"), F.col("id").alias("interval_id"), F.lit(0).alias("start"), F.lit(6000).alias("end"))
    found = intervals.rows_inside(df, table)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 120_000 and len(sizes) > 10 and max(sizes) < 30_000


def exchanged(plan):
    """Rows that each exchange of an executed plan wrote."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return exchanged(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return exchanged(plan.plan())
    written = plan.metrics().get("shuffleRecordsWritten")
    rows = [written.get().value()] if plan.nodeName() == "Exchange" and written.isDefined() else []
    return rows + [n for i in range(plan.children().size()) for n in exchanged(plan.children().apply(i))]


def test_what_travels_follows_rows_and_intervals_not_pairs(spark, monkeypatch):
    monkeypatch.setattr(intervals, "PAIR_BLOCK", 2)
    df = spark.range(400).select(F.lit("A").alias("symbol"), F.col("id").alias("Date"))
    table = spark.range(100).select(F.lit("A").alias("symbol"), F.col("id").alias("interval_id"), F.lit(0).alias("start"), F.lit(400).alias("end"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where neither side is small
    try:
        found = intervals.rows_inside(df, table)
        pairs = [(r["Date"], r["interval_id"]) for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(pairs) == [(t, i) for t in range(400) for i in range(100)]
    travelled = exchanged(found._jdf.queryExecution().executedPlan())
    assert travelled and max(travelled) <= 4 * (400 + 100) + 100
    # One interval after the other, so that files of the result stay small.
    assert sum(a[1] != b[1] for a, b in zip(pairs, pairs[1:])) <= max(travelled)


def test_columns_come_back_as_they_were(spark):
    rows = [(i % 7, 1.5 * i, i % 3, None if i % 5 == 0 else str(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "Date int, x double, symbol int, `a.b` string")
    table = spark.createDataFrame([(0, "p", 1, 4), (2, "q", 3, 9), (None, "r", 0, 9)], "symbol long, interval_id string, start int, end int")
    cover = [(*r, i) for r in rows for s, i, a, b in [(0, "p", 1, 4), (2, "q", 3, 9)] if r[2] == s and a <= r[0] < b]
    found = intervals.rows_inside(df, table)
    assert [(f.name, f.dataType) for f in found.schema][:4] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, cover))
    counted = intervals.open_intervals(df, table)
    assert [(f.name, f.dataType) for f in counted.schema][:4] == [(f.name, f.dataType) for f in df.schema]
    assert sorted(map(str, map(tuple, counted.drop(intervals.OPEN).collect()))) == sorted(map(str, rows))
    assert counted.agg(F.sum(intervals.OPEN)).first()[0] == len(cover)


@pytest.mark.parametrize("changes", [{}, {(2, "Close"): -1.0}, {(1, "Volume"): None, (3, "High"): 1.0}, {(0, "Open"): float("nan")}])
def test_raw_rules_while_writing_equal_the_separate_job(spark, changes):
    bars, out = valid_bars(spark, changes), scratch_path(spark, "w")
    got = C.evaluate_while_writing(bars, C.raw_contract(), lambda rows: rows.write.parquet(out))
    want = C.evaluate(bars, C.raw_contract())
    assert sorted(got.collect()) == sorted(want.collect())
    assert spark.read.parquet(out).columns == bars.columns and spark.read.parquet(out).count() == 5


def test_keys_and_order_while_writing_and_reports_before_the_raise(spark):
    rows = valid_features(spark).withColumn(C.ROW_POSITION, F.dayofmonth("Date"))
    gap = rows.withColumn("Date", F.when(F.col(C.ROW_POSITION) == 4, None).when(F.col(C.ROW_POSITION) == 5, F.lit("2026-01-01").cast("date")).otherwise(F.col("Date")))
    for df in (rows, rows.unionByName(rows.limit(2)), gap, rows.drop("rsi_14"), rows.limit(0), rows.drop(C.ROW_POSITION)):
        out = scratch_path(spark, "w")
        got = C.evaluate_while_writing(df, C.feature_contract(), lambda r: r.write.parquet(out))
        assert sorted(got.collect(), key=str) == sorted(C.evaluate(df, C.feature_contract()).collect(), key=str)
    order = [r for r in C.evaluate(gap, C.feature_contract()).collect() if r["expectation_type"] == C.INCREASING]
    assert order[0]["unexpected"] == 1
    saved = scratch_path(spark, "report")
    C.report(got, "features", "t").write.parquet(saved)
    with pytest.raises(DataContractError):
        C.enforce(spark.read.parquet(saved))
    assert spark.read.parquet(saved).count() == 1


def test_overlay_is_written_then_judged(spark):
    bars = bars_of(spark, [100, 101, 99, 102, 103, 101], start="2026-01-01")
    good = predictions_of(spark, [1, 0, 1, 1, 0, 0], [1, 0, 1, 0, 1, 0], [0.7, 0.3, 0.6, 0.4, 0.8, 0.2])
    out = scratch_path(spark, "overlay")
    reports.write_overlay(bars, good, lambda rows: rows.write.parquet(out))
    assert spark.read.parquet(out).exceptAll(reports.checked_overlay(bars, good)).count() == 0
    broken = {
        "no close": (bars, good.withColumn("Date", F.when(F.col("predicted_target") == 1, F.lit("2030-01-01").cast("date")).otherwise(F.col("Date"))).where("probability_up < 0.75 AND (Date < '2030-01-01' OR probability_up > 0.65)")),
        "Prediction data": (bars, good.unionByName(good.limit(1))),
        "Market data": (bars.unionByName(bars.limit(1)), good),
        "0 or 1": (bars, good.withColumn("predicted_target", F.lit(2))),
    }
    for message, (left, right) in broken.items():
        out = scratch_path(spark, "overlay")
        with pytest.raises(DataContractError, match=message):
            reports.write_overlay(left, right, lambda rows: rows.write.parquet(out))
        assert spark.read.parquet(out).count() >= right.count()


def test_pairwise_correlations_of_many_columns_with_holes(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(size=(200, 30)), columns=[f"c {i}" for i in range(30)])
    frame = frame.mask(rng.random(frame.shape) < 0.3)
    frame["flat"], frame["never"] = 1.0, np.nan
    df = spark.createDataFrame(frame)
    df = df.select(*[F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) for c in df.columns])
    found = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in correlation.pairwise_correlations(df, list(frame.columns)).collect()}
    want = frame.corr(min_periods=2)
    assert len(found) == 32 * 32
    for (a, b), value in found.items():
        expected = want.loc[a, b]
        assert (value is None) if np.isnan(expected) else abs(value - expected) < 1e-9
    plan = correlation.pairwise_correlations(df, list(frame.columns))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("parts", [2, 7])
def test_corner_points_equal_a_plain_loop(spark, parts):
    rng = random.Random(parts)
    rows = [("m", i, rng.choice([0, 1]), round(rng.random(), 2)) for i in range(150)] + [("one", 0, 1, 0.5)]
    df = spark.createDataFrame(rows, "model string, id int, actual_target int, probability_up double")
    want = set()
    for model in ("m", "one"):
        scores = sorted({p for m, _, _, p in rows if m == model}, reverse=True)
        steps = [tuple(sum(1 for m, _, y, p in rows if m == model and p == s and y == c) for c in (0, 1)) for s in scores]
        want |= {(model, s) for k, s in enumerate(scores) if k in (0, len(scores) - 1) or steps[k] != steps[k + 1]}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = metrics.roc_curve(df, corners_only=True).where("threshold IS NOT NULL").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {(r["model"], r["threshold"]) for r in found} == want
