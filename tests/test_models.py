import numpy as np
import pytest
from conftest import pandas_of, weekdays
from pyspark.sql import Observation
from pyspark.sql import functions as F

from barlake.operators import explain, metrics, models
from barlake.schemas import FEATURE_SCHEMA, FEATURES, TARGET, DataContractError
from barlake.streaming.scoring import checkpoint_location, start_scoring

REQUEST = (0.001, 0.001, 6000.0, 5980.0, 1.0033, 55.0, 0.012, 0.05)
SCHEMA = ", ".join(["symbol string", "Date date"] + [f"{f} double" for f in FEATURES])


def training_rows(n=120, learnable=False):
    rows = []
    for i, d in enumerate(weekdays("2024-01-01", n)):
        y = i % 2
        shift = (y - 0.5) * 0.1 if learnable else 0.0
        rows.append(
            (
                "T", d, (i % 11 - 5) / 100 + shift, (i % 13 - 6) / 100, 100 + 0.1 * i, 99 + 0.1 * i,
                (i % 7 - 3) / 100, float(30 + i % 40), 0.01 + (i % 9) / 1000, (i % 5 - 2) / 100, y,
            )
        )
    return rows


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(training_rows(), FEATURE_SCHEMA)


@pytest.fixture(scope="module")
def fitted(train):
    return models.train_logistic(train)


def test_standardize(spark, train):
    out = pandas_of(models.standardize(train, train))
    for f in FEATURES:
        assert abs(out[f].mean()) < 1e-9 and out[f].std(ddof=0) == pytest.approx(1)
    flat = train.withColumn("rsi_14", F.lit(50.0))
    assert (pandas_of(models.standardize(flat, flat))["rsi_14"] == 0).all()


def test_logistic_regression_solves_its_objective(train, fitted):
    """The gradient of the summed log loss plus half the squared weights vanishes."""
    frame = pandas_of(train)
    x = frame[FEATURES].to_numpy()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    p = 1 / (1 + np.exp(-(z @ np.array(fitted.coefficients) + fitted.intercept)))
    gradient = z.T @ (p - frame[TARGET].to_numpy()) + np.array(fitted.coefficients)
    assert np.abs(gradient).max() < 1e-3
    assert abs((p - frame[TARGET].to_numpy()).sum()) < 1e-3
    assert fitted.features == tuple(FEATURES)


def test_solvers_agree(train, fitted):
    other = models.train_logistic(train, solver="lbfgs")
    np.testing.assert_allclose(other.coefficients, fitted.coefficients, atol=1e-5)
    assert other.intercept == pytest.approx(fitted.intercept, abs=1e-5)


@pytest.mark.parametrize("c", [1e-3, 1.0, 1e4])
def test_newton_solves_separable_rows_for_every_penalty(spark, c):
    """Where classes part completely, full steps overshoot; the slope must vanish all the same."""
    rows = [(x, x * x / 50.0, int(x > 0)) for x in [float(i) for i in range(-40, 41) if i]]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    model = models.train_logistic(df, ["a", "b"], "y", c=c)
    x = np.array([[r[0], r[1]] for r in rows])
    z = (x - np.array(model.means)) / np.array(model.scales)
    p = 1 / (1 + np.exp(-(z @ np.array(model.coefficients) + model.intercept)))
    error = p - np.array([r[2] for r in rows])
    assert np.abs(z.T @ error + np.array(model.coefficients) / c).max() < 1e-6
    assert abs(error.sum()) < 1e-6


def test_constant_feature_gets_no_weight(train):
    flat = train.withColumn("rsi_14", F.lit(50.0))
    assert models.train_logistic(flat).coefficients[FEATURES.index("rsi_14")] == pytest.approx(0, abs=1e-12)


def test_logistic_predictions(spark, train, fitted):
    out = models.predict_linear(train, fitted)
    assert out.columns == ["symbol", "Date", "actual_target", "predicted_target", "probability_up"]
    frame = pandas_of(out)
    assert len(frame) == 120 and frame["probability_up"].between(0, 1).all()
    assert (frame["predicted_target"] == (frame["probability_up"] > 0.5)).all()
    row = metrics.evaluate(out.withColumn("model", F.lit("lr"))).first()
    assert 0 <= row["roc_auc"] <= 1


def test_learnable_signal(spark):
    df = spark.createDataFrame(training_rows(200, learnable=True), FEATURE_SCHEMA)
    model = models.train_logistic(df)
    assert model.coefficients[0] == max(model.coefficients) > 0
    row = metrics.evaluate(models.predict_linear(df, model).withColumn("model", F.lit("lr"))).first()
    assert row["accuracy"] > 0.9


def test_forest(spark):
    df = spark.createDataFrame(training_rows(200, learnable=True), FEATURE_SCHEMA)
    forest = models.train_forest(df, n_estimators=20)
    infinite = df.withColumn("volume_change", F.lit(float("inf")))
    out = models.predict_forest(infinite, forest)
    assert out.count() == 200 and out.where("probability_up BETWEEN 0 AND 1").count() == 200
    row = metrics.evaluate(models.predict_forest(df, forest).withColumn("model", F.lit("rf"))).first()
    assert row["accuracy"] > 0.85
    assert forest.stages[-1].getNumTrees == 20


def test_forest_predicts_after_observed_metrics(spark, train):
    seen = Observation()
    assert train.observe(seen, F.count(F.lit(1)).alias("n")).count() == 120 and seen.get["n"] == 120
    forest = models.train_forest(train, n_estimators=5)
    assert models.predict_forest(train, forest).count() == 120
    assert models.predict_forest(train, forest).where("probability_up >= 0").count() == 120


def test_training_errors(train):
    with pytest.raises(DataContractError, match="Unsupported model type"):
        models.train_logistic(train, model_type="other")
    with pytest.raises(DataContractError, match="Unsupported model type"):
        models.train_forest(train, model_type="other")
    with pytest.raises(DataContractError, match="rsi_14"):
        models.train_logistic(train.drop("rsi_14"))
    with pytest.raises(DataContractError, match="Unsupported solver"):
        models.train_logistic(train, solver="other")
    with pytest.raises(DataContractError, match="both classes"):
        models.train_logistic(train.where(F.col(TARGET) == 1))
    with pytest.raises(DataContractError, match="both classes"):
        models.train_logistic(train.limit(0))
    for bad in (None, float("nan"), float("inf")):
        gap = F.when(F.col("rsi_14") == 30, F.lit(bad)).otherwise(F.col("rsi_14"))
        with pytest.raises(DataContractError, match="missing or infinite values: 3"):
            models.train_logistic(train.withColumn("rsi_14", gap))
    with pytest.raises(DataContractError, match="other than 0 and 1"):
        models.train_logistic(train.withColumn(TARGET, F.col(TARGET) + 1))


def test_infinite_features_count_as_zero(train, fitted):
    infinite = train.withColumn("volume_change", F.lit(float("-inf")))
    zero = train.withColumn("volume_change", F.lit(0.0))
    a = pandas_of(models.predict_linear(infinite, fitted))["probability_up"]
    b = pandas_of(models.predict_linear(zero, fitted))["probability_up"]
    np.testing.assert_allclose(a, b)


def request(spark, **changes):
    values = dict(zip(FEATURES, REQUEST)) | changes
    row = ("T", weekdays("2026-01-01", 1)[0], *[values[f] for f in FEATURES])
    return spark.createDataFrame([row], SCHEMA)


def test_scoring(spark, fitted):
    row = models.score(request(spark), fitted).first()
    assert row["prediction_label"] == ("up" if row["prediction"] == 1 else "down")
    assert row["probability_up"] + row["probability_down"] == pytest.approx(1)
    assert row["reject_reason"] is None and row["model_name"] == "logistic_regression"
    shuffled = request(spark).select("symbol", "Date", *reversed(FEATURES))
    assert models.score(shuffled, fitted).first()["probability_up"] == row["probability_up"]


@pytest.mark.parametrize(
    "value, reason",
    [
        (None, "rsi_14 is missing"),
        (float("nan"), "rsi_14 is not finite"),
        (float("inf"), "rsi_14 is not finite"),
    ],
)
def test_unscorable_requests_are_kept_with_a_reason(spark, fitted, value, reason):
    row = models.score(request(spark, rsi_14=value), fitted).first()
    assert row["reject_reason"] == reason
    assert row["prediction"] is None and row["probability_up"] is None


def test_request_columns_are_exact(spark, fitted):
    with pytest.raises(DataContractError, match="missing required columns: \\['sma_10'\\]"):
        models.score(request(spark).drop("sma_10"), fitted)
    with pytest.raises(DataContractError, match="unexpected columns: \\['x'\\]"):
        models.score(request(spark).withColumn("x", F.lit(1)), fitted)
    with pytest.raises(DataContractError, match="feature order"):
        models.check_feature_order(FEATURES[::-1])


def test_model_survives_json(fitted):
    assert models.LinearModel.from_json(fitted.to_json()) == fitted


def test_explanation(spark, train, fitted):
    values = explain.shap_values(train, fitted)
    frame = pandas_of(values)
    x = pandas_of(train)[FEATURES].to_numpy()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    np.testing.assert_allclose(frame[FEATURES], z * np.array(fitted.coefficients), atol=1e-9)
    importance = pandas_of(explain.shap_importance(values, FEATURES), "rank")
    assert importance["rank"].tolist() == list(range(1, 9))
    assert importance["mean_abs_shap_value"].is_monotonic_decreasing
    assert set(importance["feature"]) == set(FEATURES)
    row = explain.shap_summary(values, FEATURES, "m", "1").first()
    assert row["n_observations"] == 120 and len(row["top_features"]) == 5
    assert row["top_features"][0]["feature"] == importance["feature"][0]


def test_equal_importance_is_ordered_by_name(spark):
    df = spark.createDataFrame([(1.0, -1.0), (-1.0, 1.0)], "b double, a double")
    out = pandas_of(explain.shap_importance(df, ["b", "a"]), "rank")
    assert out["feature"].tolist() == ["a", "b"]


def test_streaming_scores_equal_batch_scores(spark, fitted, tmp_path):
    batch = spark.createDataFrame([r[:-1] for r in training_rows(30)], SCHEMA)
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    batch.write.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    query = start_scoring(stream, fitted, sink, name="scores")
    query.awaitTermination(120)
    assert query.exception() is None
    expected = pandas_of(models.score(batch, fitted))
    got = pandas_of(spark.read.parquet(sink))
    np.testing.assert_allclose(got["probability_up"], expected["probability_up"])
    assert checkpoint_location(batch, "x").endswith("/x")


def test_rows_with_a_missing_feature_have_no_prediction(spark, fitted):
    rows = [list(training_rows(1)[0]) for _ in range(4)]
    at = 2 + FEATURES.index("rsi_14")
    for row, value in zip(rows, (float("nan"), None, float("inf"), 50.0)):
        row[at] = value
    df = spark.createDataFrame([r[:-1] for r in rows], SCHEMA).withColumn(TARGET, F.lit(1))
    got = [r["predicted_target"] for r in models.predict_linear(df, fitted, keep=["rsi_14"]).collect()]
    assert got[:2] == [None, None] and None not in got[2:]


def test_another_feature_order_is_refused(spark, fitted, train):
    models.predict_linear(train, fitted, expected=FEATURES)
    with pytest.raises(DataContractError, match="order"):
        models.predict_linear(train, fitted, expected=FEATURES[::-1])
