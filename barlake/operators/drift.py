"""Feature drift between a reference and a current period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.ranks import running_totals
from barlake.functions.scalars import col, ratio
from barlake.schemas import FEATURES, DataContractError
from barlake.sources.market import require_columns

# Method names, thresholds and the floor of the scale.
WASSERSTEIN, WASSERSTEIN_THRESHOLD = "Wasserstein distance (normed)", 0.1
KS, KS_THRESHOLD = "K-S p_value", 0.05
SCALE_FLOOR = 0.001
DATASET_SHARE = 0.5
KS_TERMS = 100
# Largest product of sample sizes whose p-value is counted path by path.
EXACT_CELLS = 1_000_000


def long_features(df: DataFrame, columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """(period, feature, value) rows of the numeric feature columns."""
    require_columns(df, ["period", *columns], "Drift data")
    text = [c for c in columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    if text:
        raise DataContractError(f"Drift feature columns must be numeric: {text}")
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select("period", F.inline(cells)).where(F.col("value").isNotNull())


def _two_sided(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both empirical distribution functions at every distinct value of a feature."""
    sides = {
        "ref": (F.col("period") == "reference").cast("bigint"),
        "cur": (F.col("period") == "current").cast("bigint"),
    }
    totals = running_totals(long_features(df, columns), ["feature"], "value", sides)

    def cdf(side: str) -> Column:
        upto = F.col(f"{side}_before") + F.col(side)
        return ratio(upto.cast("double"), F.col(f"{side}_total"))

    return totals.withColumn("_gap", F.abs(cdf("ref") - cdf("cur")))


def wasserstein(df: DataFrame, columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    """Distance between the periods per feature, in reference deviations.

    The integral of the gap between the distribution functions, over the
    population deviation of the reference (at least 0.001).
    """
    area = F.sum(F.col("_gap") * (F.col("next_value") - F.col("value")))
    distance = _two_sided(df, columns).groupBy("feature").agg(
        F.coalesce(area, F.lit(0.0)).alias("_distance")
    )
    scale = (
        df.where(F.col("period") == "reference")
        .agg(*[F.stddev_pop(col(c)).alias(c) for c in columns])
        .select(
            F.inline(
                F.array(*[F.struct(F.lit(c).alias("feature"), col(c).alias("_std")) for c in columns])
            )
        )
    )
    score = F.col("_distance") / F.greatest(F.col("_std"), F.lit(SCALE_FLOOR))
    return _verdict(
        distance.join(scale, "feature").select("feature", score.alias("drift_score")),
        WASSERSTEIN,
        WASSERSTEIN_THRESHOLD,
    )


def _exact_p(n: Column, m: Column, statistic: Column) -> Column:
    """Chance that two samples of ``n`` and ``m`` rows from one law lie at least ``statistic`` apart.

    Every order of the pooled rows is a path of n steps right and m up. ``share[i]``
    is the share of paths to (i, s - i) that touch |i / n - j / m| >= statistic,
    carried from diagonal to diagonal; products keep the test in whole numbers.
    """
    reach = F.round(statistic * n * m)

    def diagonal(share: Column, s: Column) -> Column:
        def cell(i: Column) -> Column:
            j = s - i
            reached = F.coalesce(F.get(share, i - 1), F.lit(0.0)) * i + F.get(share, i) * j
            return (
                F.when((j < 0) | (j > m), 0.0)
                .when(F.abs(i * m - j * n) >= reach, 1.0)
                .otherwise(reached / s)
            )

        return F.transform(F.sequence(F.lit(0), n), cell)

    start = F.transform(F.sequence(F.lit(0), n), lambda i: F.when(reach <= 0, 1.0).otherwise(0.0))
    return F.get(F.aggregate(F.sequence(F.lit(1), n + m), start, diagonal), n)


def ks_statistic(
    df: DataFrame, columns: Sequence[str] = tuple(FEATURES), exact_cells: int = EXACT_CELLS
) -> DataFrame:
    """Largest gap between the distribution functions and its p-value.

    The p-value counts paths where the product of the sample sizes is at most
    ``exact_cells`` and is the asymptotic series beyond. A feature without values
    in one of the periods has neither.
    """
    gaps = _two_sided(df, columns).groupBy("feature").agg(
        F.max("_gap").alias("statistic"),
        F.max("ref_total").cast("double").alias("_n"),
        F.max("cur_total").cast("double").alias("_m"),
    )
    t = F.sqrt(F.col("_n") * F.col("_m") / (F.col("_n") + F.col("_m"))) * F.col("statistic")
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * F.col("_t") * F.col("_t")),
    )
    few, many = [f("_n", "_m").cast("int") for f in (F.least, F.greatest)]
    exact = _exact_p(few, many, F.col("statistic"))
    # Below 0.2 the survival function is 1 to within 1e-12 and the series is slow.
    p = (
        F.when(F.col("statistic").isNull(), F.lit(None).cast("double"))
        .when(F.col("_n") * F.col("_m") <= exact_cells, exact)
        .when(F.col("_t") < 0.2, F.lit(1.0))
        .otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
    )
    return gaps.withColumn("_t", t).select("feature", "statistic", p.alias("p_value"))


def ks_drift(df: DataFrame, columns: Sequence[str] = tuple(FEATURES)) -> DataFrame:
    scores = ks_statistic(df, columns).select("feature", F.col("p_value").alias("drift_score"))
    return _verdict(scores, KS, KS_THRESHOLD)


def _verdict(scores: DataFrame, method: str, threshold: float) -> DataFrame:
    """p-value methods drift below the threshold, distances above it."""
    score = F.col("drift_score")
    drifted = score < threshold if "p_value" in method.lower() else score > threshold
    return scores.select(
        "feature",
        drifted.alias("drift_detected"),
        "drift_score",
        F.lit(method).alias("method"),
        F.lit(threshold).alias("threshold"),
    )


def drift_summary(df: DataFrame, scores: DataFrame) -> DataFrame:
    """The one-row report over the per-feature verdicts."""
    rows = df.agg(
        F.struct(
            F.count_if(F.col("period") == "reference").alias("reference"),
            F.count_if(F.col("period") == "current").alias("current"),
        )
    ).scalar()
    entry = F.struct("drift_detected", "drift_score", "method", "threshold")
    summary = scores.agg(
        F.count("*").alias("number_of_features"),
        F.count_if("drift_detected").alias("drifted_columns_count"),
        F.map_from_entries(F.collect_list(F.struct("feature", entry))).alias("column_drift"),
    ).withColumn("_rows", rows)
    share = F.col("drifted_columns_count") / F.col("number_of_features")
    return summary.select(
        F.col("_rows.reference").alias("reference_rows"),
        F.col("_rows.current").alias("current_rows"),
        F.array_sort(F.map_keys("column_drift")).alias("features"),
        "number_of_features",
        (share >= DATASET_SHARE).alias("dataset_drift"),
        "drifted_columns_count",
        share.alias("drifted_columns_share"),
        "column_drift",
    )
