import datetime as dt
import itertools

import numpy as np
import pytest
from conftest import (
    bars_of,
    pandas_of,
    predictions_of,
    ramp_features,
    valid_features,
    weekdays,
)
from pyspark.sql import functions as F

from barlake.operators import contracts, correlation, drift, metrics, reports, splits
from barlake.schemas import FEATURES, METRICS, DataContractError

ACTUAL = [1, 0, 1, 1, 0, 0]
PREDICTED = [1, 0, 1, 0, 1, 0]
SCORES = [0.7, 0.3, 0.6, 0.4, 0.8, 0.2]


def scored(spark, actual=ACTUAL, predicted=PREDICTED, scores=SCORES):
    return predictions_of(spark, actual, predicted, scores).withColumn("model", F.lit("m"))


def test_hand_computed_metrics(spark):
    row = metrics.evaluate(scored(spark)).first()
    assert row["accuracy"] == pytest.approx(4 / 6) and row["roc_auc"] == pytest.approx(6 / 9)
    assert row["precision"] == row["recall"] == row["f1_score"] == pytest.approx(2 / 3)
    cells = {(r["actual"], r["predicted"]): r["rows"] for r in metrics.confusion_matrix(scored(spark)).collect()}
    assert cells == {(1, 1): 2, (0, 1): 1, (1, 0): 1, (0, 0): 2}


def test_ties_count_half_and_one_class_has_no_auc(spark):
    tied = scored(spark, [1, 0, 1, 0], [1, 1, 1, 1], [0.5] * 4)
    assert metrics.roc_auc(tied).first()["roc_auc"] == 0.5
    one = scored(spark, [1, 1], [0, 0], [0.1, 0.2])
    row = metrics.evaluate(one).first()
    assert row["roc_auc"] is None and row["precision"] == 0.0 and row["f1_score"] == 0.0
    both = metrics.classification_metrics(one).first()
    assert [row[m] for m in METRICS[:4]] == [both[m] for m in METRICS[:4]]


def test_roc_curve(spark):
    points = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(scored(spark)).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0) and len(points) == 7
    xs, ys = zip(*points)
    assert np.trapezoid(ys, xs) == pytest.approx(6 / 9)


def test_histograms(spark):
    out = metrics.probability_histogram(scored(spark, [1, 0, 1], [1, 1, 1], [1.0, 0.0, 0.52]))
    assert {(r["actual_target"], r["bin"], r["rows"]) for r in out.collect()} == {
        (1, 20, 1), (0, 1, 1), (1, 11, 1)
    }
    df = spark.createDataFrame([("a", float(v)) for v in range(101)], "symbol string, x double")
    counts = pandas_of(metrics.range_histogram(df, "x", ["symbol"]), "bin")["rows"]
    assert counts.tolist() == [2] * 49 + [3]
    flat = spark.createDataFrame([("a", 1.0)] * 3, "symbol string, x double")
    assert metrics.range_histogram(flat, "x", ["symbol"]).first()["rows"] == 3


def test_model_comparison(spark):
    rows = [("a", 0.55, 0.54, 0.92, 0.68, 0.50), ("b", 0.5, 0.5, 0.5, 0.5, 0.6)]
    table = spark.createDataFrame(rows, ["model", *METRICS])
    ranks = {r["model"]: r["rank"] for r in metrics.model_comparison(table).collect()}
    assert ranks == {"b": 1, "a": 2}
    by_f1 = metrics.model_comparison(table, "f1_score").collect()
    assert {r["model"]: r["rank"] for r in by_f1} == {"a": 1, "b": 2}
    with pytest.raises(DataContractError, match="f1_score"):
        metrics.model_comparison(table.drop("f1_score"))


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.drop("probability_up"), "probability_up"),
        (lambda df: df.limit(0), "empty"),
        (lambda df: df.withColumn("actual_target", F.lit(2)), "only 0 or 1"),
    ],
)
def test_prediction_validation(spark, change, message):
    with pytest.raises(DataContractError, match=message):
        contracts.validate_predictions(change(scored(spark)), "model")


def test_overlay(spark):
    bars = bars_of(spark, [100.0, 101.0, 99.0, 102.0, 103.0, 101.5], start="2026-01-01")
    out = pandas_of(reports.checked_overlay(bars, scored(spark)))
    assert out["Close"].tolist() == [100, 101, 99, 102, 103, 101.5]
    late = scored(spark).withColumn("Date", F.date_add("Date", 1500))
    with pytest.raises(DataContractError, match="no close.*2030"):
        reports.checked_overlay(bars, late)
    with pytest.raises(DataContractError, match="duplicate dates"):
        reports.checked_overlay(bars, scored(spark).unionByName(scored(spark)))
    with pytest.raises(DataContractError, match="only 0 or 1"):
        reports.checked_overlay(bars, scored(spark).withColumn("predicted_target", F.lit(7)))


def test_predictions_in_range(spark):
    text = scored(spark).withColumn("Date", F.col("Date").cast("string"))
    bad = text.limit(1).withColumn("Date", F.lit("unknown"))
    out = reports.predictions_in_range(text.unionByName(bad), "2026-01-02", "2026-01-06")
    assert sorted(r["Date"] for r in out.collect()) == weekdays("2026-01-02", 3)


def test_target_distribution_lists_absent_values(spark):
    ones = valid_features(spark).withColumn("target_next_day_up", F.lit(1))
    out = {r["target_next_day_up"]: (r["rows"], r["share"]) for r in reports.target_distribution(ones).collect()}
    assert out == {0: (0, 0.0), 1: (5, 1.0)}


def test_drift_split_is_seven_to_three(spark):
    out = pandas_of(splits.drift_split(ramp_features(spark, 10)))
    assert out["period"].tolist() == ["reference"] * 7 + ["current"] * 3


def test_published_split_sizes(spark):
    days = spark.range(6604).select(
        F.lit("T").alias("symbol"), F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("Date")
    )
    counts = {r["split"]: r["count"] for r in splits.chrono_split(days).groupBy("split").count().collect()}
    assert counts == {"train": 4622, "validation": 990, "test": 992}


def test_split_checks(spark):
    table = ramp_features(spark, 10)
    with pytest.raises(DataContractError, match="sum to 0.9"):
        splits.chrono_split(table, 0.5, 0.2, 0.2)
    with pytest.raises(DataContractError, match="between 0 and 1"):
        splits.chrono_split(table, 1.0, 0.0, 0.0)
    with pytest.raises(DataContractError, match="between 0 and 1"):
        splits.drift_split(table, 1.0)
    parts = ("train", "validation", "test")
    splits.require_parts(splits.chrono_split(table), "split", parts)
    with pytest.raises(DataContractError, match="needs rows"):
        splits.require_parts(splits.chrono_split(table.limit(2)), "split", parts)
    with pytest.raises(DataContractError, match="needs rows"):
        splits.require_parts(splits.chrono_split(table.limit(0)), "split", parts)


def brute_wasserstein(a, b):
    grid = np.sort(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), grid[:-1], side="right") / len(a)
    g = np.searchsorted(np.sort(b), grid[:-1], side="right") / len(b)
    return float(np.sum(np.abs(f - g) * np.diff(grid))), float(np.max(np.abs(f - g)))


def test_drift_scores_equal_brute_force(spark):
    period = splits.drift_split(ramp_features(spark, 100))
    frame = pandas_of(period)
    old, new = frame[frame["period"] == "reference"], frame[frame["period"] == "current"]
    scores = {r["feature"]: r for r in drift.wasserstein(period).collect()}
    gaps = {r["feature"]: r for r in drift.ks_statistic(period).collect()}
    assert len(scores) == 8
    for name in FEATURES:
        distance, gap = brute_wasserstein(old[name].values, new[name].values)
        expected = distance / max(old[name].std(ddof=0), 0.001)
        assert scores[name]["drift_score"] == pytest.approx(expected)
        assert scores[name]["drift_detected"] == (expected > 0.1)
        assert gaps[name]["statistic"] == pytest.approx(gap)
    assert gaps["sma_10"]["p_value"] < 1e-9
    row = drift.drift_summary(period, drift.wasserstein(period)).first()
    assert (row["reference_rows"], row["current_rows"]) == (70, 30)
    assert row["features"] == sorted(FEATURES) and row["dataset_drift"]
    assert row["drifted_columns_count"] == sum(r["drift_detected"] for r in scores.values())
    assert row["column_drift"]["sma_10"]["method"] == drift.WASSERSTEIN


def test_p_value_methods_drift_below_the_threshold(spark):
    period = splits.drift_split(ramp_features(spark, 100))
    out = {r["feature"]: r for r in drift.ks_drift(period).collect()}
    assert out["sma_10"]["drift_detected"] and out["sma_10"]["drift_score"] < 0.05
    assert not out["volume_change"]["drift_detected"]


def two_samples(spark, old, new):
    rows = [("reference", x) for x in old] + [("current", x) for x in new]
    return spark.createDataFrame(rows, "period string, x double")


def share_of_orders_at_least(n, m, reach):
    """Of all orders of n + m pooled rows, the share whose largest gap is ``reach`` / (n m) or more."""
    far = 0
    orders = list(itertools.combinations(range(n + m), n))
    for first in orders:
        gap, i = 0, 0
        for k in range(n + m):
            i += k in first
            gap = max(gap, abs(i * m - (k + 1 - i) * n))
        far += gap >= reach
    return far / len(orders)


@pytest.mark.parametrize("n, m", [(1, 1), (2, 7), (7, 2), (5, 5), (8, 4)])
def test_small_samples_have_an_exact_p_value(spark, n, m):
    rng = np.random.default_rng(n * 10 + m)
    old, new = rng.normal(size=n).round(1), rng.normal(1, size=m).round(1)
    row = drift.ks_statistic(two_samples(spark, old.tolist(), new.tolist()), ["x"]).first()
    expected = share_of_orders_at_least(n, m, round(row["statistic"] * n * m))
    assert row["p_value"] == pytest.approx(expected, abs=1e-12)


def test_exact_and_asymptotic_p_values_meet(spark):
    rng = np.random.default_rng(4)
    old, new = rng.normal(size=400).tolist(), rng.normal(0.15, size=300).tolist()
    df = two_samples(spark, old, new)
    exact = drift.ks_statistic(df, ["x"]).first()
    series = drift.ks_statistic(df, ["x"], exact_cells=0).first()
    assert exact["statistic"] == series["statistic"]
    assert exact["p_value"] == pytest.approx(series["p_value"], abs=0.02)
    assert exact["p_value"] != series["p_value"]
    same = drift.ks_statistic(two_samples(spark, old, old), ["x"]).first()
    assert (same["statistic"], same["p_value"]) == (0.0, 1.0)


def test_a_period_without_values_has_no_p_value(spark):
    row = drift.ks_statistic(two_samples(spark, [1.0, 2.0], [None]), ["x"]).first()
    assert row["statistic"] is None and row["p_value"] is None


def test_drift_needs_numeric_columns(spark):
    period = splits.drift_split(ramp_features(spark, 10))
    with pytest.raises(DataContractError, match="numeric: \\['rsi_14'\\]"):
        drift.wasserstein(period.withColumn("rsi_14", F.lit("x")))
    with pytest.raises(DataContractError, match="rsi_14"):
        drift.wasserstein(period.drop("rsi_14"))


def test_constant_column_has_no_correlation(spark):
    rows = [(float(i), 1.0, float(-i) if i != 3 else None) for i in range(6)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out = {(r[0], r[1]): r[2] for r in correlation.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(out) == 9 and out[("a", "b")] is None and out[("b", "b")] is None
    assert out[("a", "c")] == out[("c", "a")] == pytest.approx(-1) and out[("a", "a")] == pytest.approx(1)


def test_cross_correlation_equals_pandas(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=60), rng.normal(size=60)
    rows = [("T", d, float(a), float(b)) for d, a, b in zip(weekdays("2024-01-01", 60), x, y)]
    df = spark.createDataFrame(rows, "symbol string, Date date, x double, y double")
    out = {r["lag"]: r["correlation"] for r in correlation.cross_correlation(df, "x", "y").collect()}
    frame = pandas_of(df)
    assert sorted(out) == list(range(-20, 21))
    for k, value in out.items():
        assert value == pytest.approx(frame["x"].shift(k).corr(frame["y"]))


def test_complete_columns_need_fewer_moments(spark):
    rng = np.random.default_rng(5)
    rows = [(float(a), float(a * 2 + b), 3.0) for a, b in rng.normal(0, 1, (200, 2))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    plain, short = (
        {(r[0], r[1]): r[2] for r in correlation.correlation_matrix(df, ["a", "b", "c"], flag).collect()}
        for flag in (False, True)
    )
    assert plain.keys() == short.keys() and short[("a", "c")] is None and short[("c", "c")] is None
    assert all(plain[k] is None or abs(plain[k] - short[k]) < 1e-12 for k in plain)


def test_first_and_edge_rows(spark):
    rows = spark.createDataFrame(
        [("b", 2), ("a", 2), ("a", None), ("b", 1), ("a", 3)], "symbol string, Date int"
    )
    first = [(r["Date"], r["symbol"]) for r in reports.first_rows(rows, 3).collect()]
    assert first == [(None, "a"), (1, "b"), (2, "a")]
    edges = reports.edge_rows(rows, 2).collect()
    assert [(r["Date"], r["symbol"]) for r in edges if r["edge"] == "head"] == [(None, "a"), (1, "b")]
    assert [(r["Date"], r["symbol"]) for r in edges if r["edge"] == "tail"] == [(3, "a"), (2, "b")]
    assert reports.edge_rows(rows.limit(1), 2).count() == 2
    assert reports.edge_rows(rows.limit(0)).count() == 0
