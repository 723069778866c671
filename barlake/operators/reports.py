"""The tables behind the charts of a run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from barlake.functions.scalars import col
from barlake.operators.metrics import value_counts
from barlake.operators.quality import coerce
from barlake.operators.splits import chrono_split
from barlake.schemas import TARGET, DataContractError
from barlake.sources.market import reject_duplicates, require_columns

KEYS = ["symbol", "Date"]


def close_series(bars: DataFrame) -> DataFrame:
    return bars.select(*KEYS, "Close")


def split_series(features: DataFrame) -> DataFrame:
    """Close with the name of the split each row falls in."""
    return chrono_split(features.select(*KEYS, "Close"))


def first_rows(df: DataFrame, n: int = 20, order: Sequence[str] = ("Date", "symbol")) -> DataFrame:
    """The first ``n`` rows in ``order``, which must be total for a fixed result; missing values come first.

    Every task keeps ``n`` rows; nothing is sorted as a whole.
    """
    return df.orderBy(*[col(c).asc_nulls_first() for c in order]).limit(n)


def edge_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ("Date", "symbol")) -> DataFrame:
    """The first and the last ``n`` rows in ``order``, marked by ``edge``: head or tail.

    A table of fewer than 2 ``n`` rows gives some of them twice; no rows give none.
    """
    tail = df.orderBy(*[col(c).desc_nulls_last() for c in order]).limit(n)
    return first_rows(df, n, order).withColumn("edge", F.lit("head")).unionByName(tail.withColumn("edge", F.lit("tail")))


def target_distribution(features: DataFrame) -> DataFrame:
    return value_counts(features, TARGET, [0, 1], by=["symbol"])


def label_distribution(labelled: DataFrame) -> DataFrame:
    return value_counts(labelled, "target", ["bearish", "neutral", "bullish"], by=["symbol"])


def overlay(bars: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions with the close of their bar; ``Close`` is NULL without a bar."""
    require_columns(predictions, [*KEYS, "predicted_target"], "Prediction data")
    return predictions.join(close_series(bars), KEYS, "left")


def checked_overlay(bars: DataFrame, predictions: DataFrame) -> DataFrame:
    """:func:`overlay` after checking that both sides match one to one."""
    reject_duplicates(predictions, KEYS, "Prediction data")
    reject_duplicates(bars, KEYS, "Market data")
    joined = overlay(bars, predictions)
    unmatched = joined.where(F.col("Close").isNull()).orderBy(*KEYS).limit(5).collect()
    if unmatched:
        dates = [str(row["Date"]) for row in unmatched]
        raise DataContractError(f"No bar, so no close, for the predictions of {dates}")
    invalid = joined.where(~F.col("predicted_target").isin(0, 1)).limit(1).collect()
    if invalid:
        raise DataContractError("predicted_target must contain only 0 or 1")
    return joined


def write_overlay(bars: DataFrame, predictions: DataFrame, write: Callable[[DataFrame], None]) -> None:
    """Let ``write`` write the overlay, then raise as :func:`checked_overlay` if it is not one to one.

    Repeated keys on either side, predictions without bar and wrong classes are counted while
    the rows are written. Only if something was counted do further jobs run, to name it.
    ``write`` must run exactly one action over all rows of what it is given.
    """
    require_columns(predictions, [*KEYS, "predicted_target"], "Prediction data")
    found_bars, found = Observation(), Observation()
    closes = close_series(bars).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_bars"), F.max("Close").alias("Close"))
    closes = closes.observe(found_bars, F.count_if(F.col("_bars") > 1).alias("repeated")).drop("_bars")
    joined = predictions.withColumn("_times", F.count(F.lit(1)).over(Window.partitionBy(*KEYS))).join(closes, KEYS, "left")
    broken = (F.col("_times") > 1) | F.col("Close").isNull() | ~F.col("predicted_target").isin(0, 1)
    write(joined.observe(found, F.count_if(broken).alias("broken")).drop("_times"))
    if found_bars.get["repeated"] or found.get["broken"]:
        checked_overlay(bars, predictions)


def predictions_in_range(predictions: DataFrame, start: str, end: str) -> DataFrame:
    """Predictions whose date can be parsed and lies in the closed range."""
    return coerce(predictions, {"Date": "date"}).where(
        F.col("Date").isNotNull() & F.col("Date").between(start, end)
    )


def price_and_sentiment(bars: DataFrame, sentiment: DataFrame, start, end) -> DataFrame:
    """Close and mean sentiment of the steps in a closed range that have both.

    Both sides are filtered before the join, so the range reaches both scans.
    """
    inside = F.col("Date").between(start, end)
    left = close_series(bars.where(inside))
    right = sentiment.where(inside).select(*KEYS, "sentiment_mean")
    return left.join(right, KEYS)


def return_and_sentiment(returns: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Log return and mean sentiment, steps with both present."""
    return (
        returns.select(*KEYS, F.col("log_return").alias("return"))
        .join(sentiment.select(*KEYS, "sentiment_mean"), KEYS)
        .dropna()
    )
