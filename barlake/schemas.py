"""Column names, schemas and fixed parameters shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

SYMBOL = "symbol"
DATE = "Date"
TARGET = "target_next_day_up"

# The raw market contract.
PRICE_COLUMNS = ["Open", "High", "Low", "Close", "Adj Close"]
REQUIRED_COLUMNS = ["Date", *PRICE_COLUMNS, "Volume"]

# The feature set used by the models, in trained order.
FEATURES = [
    "simple_return",
    "log_return",
    "sma_10",
    "sma_20",
    "sma_ratio_10",
    "rsi_14",
    "volatility_10",
    "volume_change",
]

# Evaluation metrics, in report order.
METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]

# Feature sets of the 5-step, 3-class dataset.
BASELINE_FEATURES = [
    "log_return",
    "sma_ratio_10",
    "sma_ratio_20",
    "mom_5",
    "mom_10",
    "rsi_14",
    "macd",
    "macd_signal",
    "macd_hist",
    "volatility_10",
    "volatility_20",
    "drawdown_10",
    "drawdown_20",
    "volume_ratio_10",
    "log_volume",
]
NEWS_FEATURES = [
    "sentiment_mean",
    "sentiment_std",
    "sentiment_q25",
    "sentiment_q75",
    "sentiment_momentum",
    "news_volume",
    "news_available",
]

MARKET_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Adj Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)
BAR_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), *MARKET_SCHEMA.fields])
FEATURE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("Date", T.DateType()),
        *[T.StructField(name, T.DoubleType()) for name in FEATURES],
        T.StructField(TARGET, T.IntegerType()),
    ]
)
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("actual_target", T.IntegerType()),
        T.StructField("predicted_target", T.IntegerType()),
        T.StructField("probability_up", T.DoubleType()),
    ]
)
NEWS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("Date", T.DateType()),
        T.StructField("sentiment_score", T.DoubleType()),
    ]
)
RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


class DataContractError(ValueError):
    """A table does not satisfy the contract of the operator that reads it."""
