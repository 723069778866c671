"""Evaluation of scored rows: counts, rates, ROC, histograms.

All functions group by ``by`` (the model name, say) and reduce the rows with
map-side combine first; ordered work runs on distinct scores only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.ranks import running_totals
from barlake.functions.scalars import col, ratio
from barlake.schemas import METRICS, DataContractError

ACTUAL, PREDICTED, SCORE = "actual_target", "predicted_target", "probability_up"
# Fixed value: histogram bins over [0, 1].
SCORE_BINS = 20
RANGE_BINS = 50


def _counts() -> list[Column]:
    """The four cells of the confusion matrix as aggregates named n<actual><predicted>."""
    return [
        F.count_if((F.col(ACTUAL) == a) & (F.col(PREDICTED) == p)).alias(f"n{a}{p}")
        for a in (0, 1)
        for p in (0, 1)
    ]


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """All four (actual, predicted) cells, zeros included."""
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"n{a}{p}").alias("rows")
            )
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    return scored.groupBy(*by).agg(*_counts()).select(*by, F.inline(cells))


def _rates() -> list[Column]:
    """The four rates from columns n<actual><predicted>; zero denominators give 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("n00", "n01", "n10", "n11"))

    def share(numerator: Column, denominator: Column) -> Column:
        return F.coalesce(ratio(numerator.cast("double"), denominator), F.lit(0.0))

    return [
        share(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    ]


def classification_metrics(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1."""
    return scored.groupBy(*by).agg(*_counts()).select(*by, *_rates())


def _class_totals(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Positive and negative rows per distinct score, with running totals."""
    classes = {
        "pos": (F.col(ACTUAL) == 1).cast("bigint"),
        "neg": (F.col(ACTUAL) == 0).cast("bigint"),
    }
    return running_totals(scored, by, SCORE, classes)


def _auc(pos: Column, neg: Column, neg_before: Column) -> tuple[list[Column], Column]:
    """Aggregates over distinct scores and the AUC they give."""
    won = F.sum(pos * (neg_before + neg / 2)).alias("_won")
    sizes = [F.sum(pos).alias("_pos"), F.sum(neg).alias("_neg")]
    area = ratio(F.col("_won"), F.col("_pos").cast("double") * F.col("_neg"))
    return [won, *sizes], area.alias("roc_auc")


def roc_auc(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties counting half.

    Pairs are never formed: each distinct score adds its positives times the
    negatives below it. NULL if a class is absent.
    """
    sums, area = _auc(F.col("pos"), F.col("neg"), F.col("neg_before"))
    return _class_totals(scored, by).groupBy(*by).agg(*sums).select(*by, area)


def roc_curve(scored: DataFrame, by: Sequence[str] = ("model",), corners_only: bool = False) -> DataFrame:
    """(fpr, tpr) at every distinct score, plus the (0, 0) start without threshold.

    ``corners_only`` leaves out points from which the curve goes on as it came: those that
    add as many rows of each class as the next lower score does. The points of the highest
    and the lowest score stay, and the area is the same.
    """
    totals = _class_totals(scored, by)
    if corners_only:
        ends = F.col("next_value").isNull() | F.col("pos_lower").isNull()
        turns = (F.col("pos") != F.col("pos_lower")) | (F.col("neg") != F.col("neg_lower"))
        totals = totals.where(ends | turns)

    def rate(kind: str) -> Column:
        at_or_above = F.col(f"{kind}_total") - F.col(f"{kind}_before")
        return ratio(at_or_above.cast("double"), F.col(f"{kind}_total"))

    points = totals.select(
        *by, F.col(SCORE).alias("threshold"), rate("neg").alias("fpr"), rate("pos").alias("tpr")
    )
    start = totals.select(*by).distinct().select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(start)


def probability_histogram(
    scored: DataFrame, by: Sequence[str] = ("model",), bins: int = SCORE_BINS
) -> DataFrame:
    """Rows per model, class and equal-width bin of [0, 1]; the last bin is closed."""
    bin_number = F.least(F.width_bucket(SCORE, F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))
    return scored.groupBy(*by, F.col(ACTUAL), bin_number.cast("int").alias("bin")).agg(
        F.count("*").alias("rows")
    )


def range_histogram(
    df: DataFrame, column: str, by: Sequence[str], bins: int = RANGE_BINS
) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value of a group."""
    x = col(column)
    span = df.groupBy(*by).agg(F.min(x).alias("_low"), F.max(x).alias("_high"))
    place = F.floor(
        F.coalesce(ratio((x - F.col("_low")) * bins, F.col("_high") - F.col("_low")), F.lit(0.0))
    )
    return (
        df.where(x.isNotNull())
        .join(span, list(by))
        .groupBy(*by, (F.least(place, F.lit(bins - 1)) + 1).cast("int").alias("bin"))
        .agg(F.count("*").alias("rows"))
    )


def evaluate(scored: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """The five metrics, one row per group, from one pass over the scored rows.

    Rows are counted per distinct score and confusion cell once; the rates and
    the AUC both come from those counts. Rows without a score do not count.
    """
    cells = {
        f"n{a}{p}": ((F.col(ACTUAL) == a) & (F.col(PREDICTED) == p)).cast("bigint")
        for a in (0, 1)
        for p in (0, 1)
    }
    sums, area = _auc(
        F.col("n10") + F.col("n11"),
        F.col("n00") + F.col("n01"),
        F.col("n00_before") + F.col("n01_before"),
    )
    return (
        running_totals(scored, by, SCORE, cells)
        .groupBy(*by)
        .agg(*[F.sum(c).alias(c) for c in cells], *sums)
        .select(*by, *_rates(), area)
    )


def model_comparison(metrics: DataFrame, choose_by: str = "roc_auc") -> DataFrame:
    """The metrics of every model with its rank by the chosen one.

    ``metrics`` has one row per model; ties share a rank.
    """
    if choose_by not in METRICS:
        raise DataContractError(f"Unknown metric {choose_by!r}")
    require_metrics(metrics)
    best_first = Window.orderBy(F.col(choose_by).desc_nulls_last())
    return metrics.select("model", *METRICS, F.rank().over(best_first).cast("int").alias("rank"))


def require_metrics(metrics: DataFrame) -> None:
    """Raise if one of the five metrics is absent."""
    missing = [m for m in METRICS if m not in metrics.columns]
    if missing:
        raise DataContractError(f"Metrics are missing required keys: {missing}")


def value_counts(df: DataFrame, column: str, domain: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Count and share of every value of a fixed domain, zeros included."""
    hits = [F.count_if(col(column) == v).alias(f"_{i}") for i, v in enumerate(domain)]
    total = reduce(Column.__add__, [F.col(f"_{i}") for i, _ in enumerate(domain)])
    rows = F.array(
        *[
            F.struct(
                F.lit(v).alias(column),
                F.col(f"_{i}").alias("rows"),
                ratio(F.col(f"_{i}").cast("double"), total).alias("share"),
            )
            for i, v in enumerate(domain)
        ]
    )
    return df.groupBy(*by).agg(*hits).select(*by, F.inline(rows))
