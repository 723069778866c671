"""Two classifiers on Spark ML and scoring as plain column expressions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from barlake.functions.scalars import INF, col, infinite_to_zero
from barlake.schemas import FEATURES, TARGET, DataContractError
from barlake.sources.market import require_columns

# Training settings.
LOGISTIC = {"model_type": "logistic_regression", "max_iter": 1000, "c": 1.0}
FOREST = {
    "model_type": "random_forest",
    "n_estimators": 300,
    "max_depth": 8,
    "min_samples_leaf": 5,
    "max_features": "sqrt",
    "random_state": 42,
}
UP_THRESHOLD = 0.5
TOLERANCE = 1e-10  # largest change of a weight in the last step


def moments(df: DataFrame, columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """One row: mean and population deviation of every column, as structs."""
    return df.agg(
        F.struct(*[F.avg(col(c)).alias(c) for c in columns]).alias("mean"),
        F.struct(*[F.stddev_pop(col(c)).alias(c) for c in columns]).alias("std"),
    )


def standardize(
    df: DataFrame, fitted_on: DataFrame, columns: Sequence[str] = tuple(FEATURES)
) -> DataFrame:
    """``columns`` of ``df`` in deviations from the means of ``fitted_on``.

    The moments are a scalar subquery, so nothing is collected. A constant
    column is only centred.
    """
    fitted = moments(fitted_on, columns).select(F.struct("mean", "std")).scalar()
    return (
        df.withColumn("_fit", fitted)
        .withColumns(
            {
                c: (col(c) - F.col(f"_fit.mean.{c}")) / _scale(F.col(f"_fit.std.{c}"))
                for c in columns
            }
        )
        .drop("_fit")
    )


def _scale(std: Column) -> Column:
    return F.when(std > 0, std).otherwise(F.lit(1.0))


@dataclass(frozen=True)
class LinearModel:
    """A logistic model on standardised features, in trained feature order.

    Small enough to travel as literals: scoring is one JVM expression.
    ``means`` and ``scales`` may be left empty for standardised input.
    """

    coefficients: tuple[float, ...]
    intercept: float
    means: tuple[float, ...] = ()
    scales: tuple[float, ...] = ()
    features: tuple[str, ...] = tuple(FEATURES)
    name: str = "logistic_regression"

    def z(self, feature: str) -> Column:
        """The standardised feature."""
        i = self.features.index(feature)
        if not self.means:
            return col(feature)
        return (col(feature) - self.means[i]) / self.scales[i]

    def probability(self) -> Column:
        total = F.lit(self.intercept)
        for feature, weight in zip(self.features, self.coefficients):
            total = total + F.lit(weight) * self.z(feature)
        return 1 / (1 + F.exp(-total))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "LinearModel":
        values = json.loads(text)
        return LinearModel(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def check_feature_order(trained: Sequence[str], expected: Sequence[str] = tuple(FEATURES)) -> None:
    if list(trained) != list(expected):
        raise DataContractError(
            "The trained feature order does not match the scoring contract: "
            f"{list(trained)} != {list(expected)}"
        )


def _training_rows(train: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return train.select(*[col(f).cast("double").alias(f) for f in features], col(target).cast("double").alias("label"))


def _fitted_scale(rows: DataFrame, features: Sequence[str]) -> tuple[int, LinearModel]:
    """Number of rows and the model without weights; raises if the rows cannot be fitted."""
    unusable = F.lit(False)
    for c in (*features, "label"):
        unusable = unusable | F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == INF)
    fitted = rows.agg(
        F.count("*").alias("n"),
        F.count_if(unusable).alias("unusable"),
        F.count_if(~F.col("label").isin(0.0, 1.0)).alias("strange"),
        F.count_if(F.col("label") == 1).alias("ones"),
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[_scale(F.stddev_pop(f)).alias(f"s_{f}") for f in features],
    ).first()
    if fitted["unusable"]:
        raise DataContractError(f"Training rows with missing or infinite values: {fitted['unusable']}")
    if fitted["strange"]:
        raise DataContractError(f"Training rows with a target other than 0 and 1: {fitted['strange']}")
    if fitted["ones"] in (0, fitted["n"]):
        raise DataContractError("Training data needs rows of both classes")
    return fitted["n"], LinearModel(
        coefficients=(),
        intercept=0.0,
        means=tuple(fitted[f"m_{f}"] for f in features),
        scales=tuple(fitted[f"s_{f}"] for f in features),
        features=tuple(features),
    )


def _derivatives(scaled: DataFrame, weights: np.ndarray, features: Sequence[str]) -> tuple:
    """Summed log loss, its slope and its curvature at ``weights`` (intercept last): one pass."""
    z = [*[F.col(f) for f in features], F.lit(1.0)]
    margin = reduce(Column.__add__, [F.lit(float(w)) * x for w, x in zip(weights, z)])
    up = 1 / (1 + F.exp(-F.col("_t")))
    rows = scaled.withColumn("_t", margin).withColumns(
        {
            # log(1 + exp(t)) - y t without overflow
            "_loss": F.log1p(F.exp(-F.abs("_t"))) + F.greatest("_t", F.lit(0.0)) - F.col("label") * F.col("_t"),
            "_e": up - F.col("label"),
            "_v": up * (1 - up),
        }
    )
    pairs = [(i, j) for i in range(len(z)) for j in range(i + 1)]
    found = rows.agg(
        F.sum("_loss"),
        *[F.sum(F.col("_e") * x) for x in z],
        *[F.sum(F.col("_v") * z[i] * z[j]) for i, j in pairs],
    ).first()
    slope = np.array(found[1 : len(z) + 1])
    curve = np.zeros((len(z), len(z)))
    for (i, j), value in zip(pairs, found[len(z) + 1 :]):
        curve[i, j] = curve[j, i] = value
    return found[0], slope, curve


def _newton(scaled: DataFrame, features: Sequence[str], ridge: float, max_iter: int) -> np.ndarray:
    """The weights that minimise summed log loss + ridge / 2 * squared coefficients.

    A step that does not lower the loss is halved, so the steps end at the one
    minimum from anywhere; the intercept is free.
    """
    penalty = np.array([ridge] * len(features) + [0.0])
    weights = np.zeros(len(penalty))
    step, best = None, np.inf
    for _ in range(max_iter):
        loss, slope, curve = _derivatives(scaled, weights, features)
        loss += float(penalty @ weights**2) / 2
        if loss > best + 1e-12 * abs(best):
            step = step / 2
            weights = weights - step
        else:
            best = loss
            step = np.linalg.solve(curve + np.diag(penalty), -(slope + penalty * weights))
            weights = weights + step
        if np.abs(step).max() < TOLERANCE:
            break
    return weights


def _lbfgs(scaled: DataFrame, features: Sequence[str], ridge: float, max_iter: int, n: int) -> np.ndarray:
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(scaled)
    fit = LogisticRegression(
        maxIter=max_iter,
        regParam=ridge / n,
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-8,
    ).fit(vectors.select("features", "label"))
    return np.array([*fit.coefficients, fit.intercept])


def train_logistic(
    train: DataFrame,
    features: Sequence[str] = tuple(FEATURES),
    target: str = TARGET,
    model_type: str = LOGISTIC["model_type"],
    max_iter: int = LOGISTIC["max_iter"],
    c: float = LOGISTIC["c"],
    solver: str = "newton",
) -> LinearModel:
    """L2 logistic regression on standardised features: half the squared coefficients plus c times the loss.

    ``newton`` takes some seven passes, each one aggregation of
    (k + 1)(k + 4) / 2 + 1 sums for k features, combined in the tasks; only those
    sums reach the driver. It suits tens of features. ``lbfgs`` is Spark ML's
    solver, for more of them. Rows that cannot be used, targets other than 0 and
    1 and a single class raise.
    """
    if model_type != LOGISTIC["model_type"]:
        raise DataContractError(f"Unsupported model type: {model_type}")
    if solver not in ("newton", "lbfgs"):
        raise DataContractError(f"Unsupported solver: {solver}")
    require_columns(train, [*features, target], "Training data")
    rows = _training_rows(train, features, target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, model = _fitted_scale(rows, features)
        scaled = rows.select("label", *[model.z(f).alias(f) for f in features])
        if solver == "newton":
            weights = _newton(scaled, features, 1.0 / c, max_iter)
        else:
            weights = _lbfgs(scaled, features, 1.0 / c, max_iter, n)
    finally:
        rows.unpersist()
    return replace(
        model, coefficients=tuple(float(v) for v in weights[:-1]), intercept=float(weights[-1])
    )


def train_forest(
    train: DataFrame,
    features: Sequence[str] = tuple(FEATURES),
    target: str = TARGET,
    model_type: str = FOREST["model_type"],
    n_estimators: int = FOREST["n_estimators"],
    max_depth: int = FOREST["max_depth"],
    min_samples_leaf: int = FOREST["min_samples_leaf"],
    max_features: str = FOREST["max_features"],
    random_state: int = FOREST["random_state"],
) -> PipelineModel:
    """Random forest. Leaves of 5 rows or more imply splits of 10 or more."""
    if model_type != FOREST["model_type"]:
        raise DataContractError(f"Unsupported model type: {model_type}")
    require_columns(train, [*features, target], "Training data")
    rows = train.select(*features, col(target).cast("double").alias("label"))
    forest = RandomForestClassifier(
        numTrees=n_estimators,
        maxDepth=max_depth,
        minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy=max_features,
        seed=random_state,
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    # The copy has no training summary: that holds the session, which cannot be
    # sent to tasks once the session has observed a metric.
    return Pipeline(stages=[assembler, forest]).fit(rows).copy()


def _prediction_columns(df: DataFrame, keep: Sequence[str], target: str) -> DataFrame:
    return df.select(
        *keep,
        col(target).cast("int").alias("actual_target"),
        F.col("predicted_target"),
        F.col("probability_up"),
    )


def predict_linear(
    df: DataFrame,
    model: LinearModel,
    keep: Sequence[str] = ("symbol", "Date"),
    target: str = TARGET,
    expected: Sequence[str] | None = None,
) -> DataFrame:
    """Predictions table; infinite features count as 0, rows with a missing one have no prediction.

    ``expected`` is the feature order the caller scores by; another one raises.
    """
    if expected is not None:
        check_feature_order(model.features, expected)
    guarded = df.withColumns({f: infinite_to_zero(col(f)) for f in model.features})
    # A NULL feature makes the probability NULL, a NaN makes it NaN.
    up = F.nanvl(model.probability(), F.lit(None).cast("double"))
    scored = guarded.withColumn("probability_up", up).withColumn(
        "predicted_target", (F.col("probability_up") > UP_THRESHOLD).cast("int")
    )
    return _prediction_columns(scored, keep, target)


def predict_forest(
    df: DataFrame,
    model: PipelineModel,
    features: Sequence[str] = tuple(FEATURES),
    keep: Sequence[str] = ("symbol", "Date"),
    target: str = TARGET,
) -> DataFrame:
    guarded = df.withColumns({f: infinite_to_zero(col(f)) for f in features})
    scored = model.transform(guarded).withColumns(
        {
            "probability_up": vector_to_array("probability")[1],
            "predicted_target": F.col("prediction").cast("int"),
        }
    )
    return _prediction_columns(scored, keep, target)


def scoring_problem(features: Sequence[str] = tuple(FEATURES)) -> Column:
    """Why a row cannot be scored (first problem found), or NULL."""
    problem = F.lit(None).cast("string")
    for feature in reversed(features):
        x = col(feature).cast("double")
        problem = (
            F.when(x.isNull(), f"{feature} is missing")
            .when(F.isnan(x) | (F.abs(x) == INF), f"{feature} is not finite")
            .otherwise(problem)
        )
    return problem


def score(
    df: DataFrame,
    model: LinearModel,
    keys: Sequence[str] = ("symbol", "Date"),
    expected: Sequence[str] | None = None,
) -> DataFrame:
    """Score rows that hold exactly the trained features besides the keys.

    Rows with a missing or non-finite feature keep NULL scores and a ``reject_reason``.
    Works on batch and streaming frames alike.
    """
    if expected is not None:
        check_feature_order(model.features, expected)
    require_columns(df, [*keys, *model.features], "The scoring request")
    extra = [c for c in df.columns if c not in (*keys, *model.features)]
    if extra:
        raise DataContractError(f"The scoring request has unexpected columns: {extra}")
    reason = scoring_problem(model.features)
    up = F.when(F.col("reject_reason").isNull(), model.probability())
    return (
        df.withColumn("reject_reason", reason)
        .withColumn("probability_up", up)
        .select(
            *keys,
            (F.col("probability_up") > UP_THRESHOLD).cast("int").alias("prediction"),
            F.when(F.col("probability_up") > UP_THRESHOLD, "up")
            .when(F.col("probability_up").isNotNull(), "down")
            .alias("prediction_label"),
            (1 - F.col("probability_up")).alias("probability_down"),
            "probability_up",
            F.lit(model.name).alias("model_name"),
            "reject_reason",
        )
    )

