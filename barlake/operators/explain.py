"""Additive explanations of a linear model and their summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.scalars import col
from barlake.operators.models import LinearModel

TOP_FEATURES = 5


def shap_values(
    df: DataFrame, model: LinearModel, keep: Sequence[str] = ("symbol", "Date")
) -> DataFrame:
    """Per row and feature: weight times the distance of z from its mean.

    This is the exact Shapley value of a linear model with independent
    features and the explained rows as background.
    """
    z = df.select(*keep, *[model.z(f).alias(f) for f in model.features])
    centre = z.agg(F.struct(*[F.avg(col(f)).alias(f) for f in model.features])).scalar()
    return z.withColumn("_centre", centre).select(
        *keep,
        *[
            (F.lit(weight) * (col(f) - F.col(f"_centre.{f}"))).alias(f)
            for f, weight in zip(model.features, model.coefficients)
        ],
    )


def shap_importance(values: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute value per feature, ranked; ties are ordered by name.

    The rank window runs over one row per feature.
    """
    means = values.agg(*[F.avg(F.abs(col(f))).alias(f) for f in features])
    cells = F.array(
        *[F.struct(col(f).alias("mean_abs_shap_value"), F.lit(f).alias("feature")) for f in features]
    )
    order = F.array_sort(
        cells,
        lambda a, b: F.when(a["mean_abs_shap_value"] > b["mean_abs_shap_value"], -1)
        .when(a["mean_abs_shap_value"] < b["mean_abs_shap_value"], 1)
        .when(a["feature"] < b["feature"], -1)
        .otherwise(1),
    )
    return means.select(F.posexplode(order).alias("_place", "_cell")).select(
        F.col("_cell.feature").alias("feature"),
        F.col("_cell.mean_abs_shap_value").alias("mean_abs_shap_value"),
        (F.col("_place") + 1).alias("rank"),
    )


def shap_summary(values: DataFrame, features: Sequence[str], model: str, version: str) -> DataFrame:
    """One row: what was explained and the five most important features."""
    importance = shap_importance(values, features)
    top = importance.where(F.col("rank") <= TOP_FEATURES).agg(
        F.sort_array(F.collect_list(F.struct("rank", "feature", "mean_abs_shap_value")))
    )
    counted = values.agg(F.count("*").alias("n_observations")).withColumn("_top", top.scalar())
    return counted.select(
        F.lit(model).alias("model_name"),
        F.lit(version).alias("model_version"),
        F.lit("linear").alias("explainer_type"),
        F.lit("validation").alias("explained_dataset"),
        "n_observations",
        F.lit(len(features)).alias("n_features"),
        F.lit(1).alias("positive_class"),
        F.transform(
            "_top",
            lambda t: F.struct(
                t["feature"].alias("feature"),
                t["mean_abs_shap_value"].alias("mean_abs_shap_value"),
                t["rank"].alias("rank"),
            ),
        ).alias("top_features"),
        F.current_timestamp().alias("created_at"),
    )

