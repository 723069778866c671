"""Named queries over the shared tables: (spark, sf_dir) -> DataFrame.

Each composes operators on canonical series and rounds doubles to 6 decimals
so that results compare across engines. None collects or caps rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.scalars import infinite_to_zero, rounded
from barlake.functions.scratch import scratch_path, written
from barlake.functions.series import Series, warm_up
from barlake.operators import (
    contracts,
    correlation,
    drift,
    events,
    explain,
    features,
    intervals,
    metrics,
    models,
    quality,
    reports,
    sentiment,
    splits,
)
from barlake.schemas import BASELINE_FEATURES, FEATURES, TARGET
from barlake.sources import market, sinks, tables
from barlake.streaming import bars as stream_bars
from barlake.streaming import features as stream_features
from barlake.streaming import gate, runs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ["symbol", "Date"]
# Ticks have no calendar bound per symbol: blocks of rows instead of one group.
# Small ones, so that also small tables have block edges.
TICKS = Series(time="Date", tie="event_id", block_rows=500)

# The parameters of the registered queries.
EVENT_HOURS = [f"2024-01-{day:02d} 12:00:00" for day in (5, 9, 14, 20, 26)]
CASE_START, CASE_END = "2024-01-08 00:00:00", "2024-01-19 23:00:00"
RANGE_START, RANGE_END = "1997-01-01", "1998-12-31"
UPSERT_FROM = "1998-01-01"
RETURN_FLAGS = ["A", "N", "R"]
DEEP_DRAWDOWN = -0.5
FOREST_BOUNDS = {"accuracy": 0.65, "roc_auc": 0.75}
REFERENCE_NATIONS = 12
FIXED_MODEL = models.LinearModel(
    coefficients=(0.35, -0.20, 0.15, -0.10, 0.25, -0.30, 0.05, 0.40),
    intercept=0.05,
    name="fixed_logistic",
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
    return fn


# --- shared inputs -----------------------------------------------------------


def _features(spark: SparkSession, d: str) -> DataFrame:
    return features.market_features(tables.line_bars(spark, d))


def _sentiment(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.daily_sentiment(tables.news(spark, d))


def _joined(spark: SparkSession, d: str) -> DataFrame:
    """Hourly bars and returns with lagged sentiment."""
    joined = sentiment.join_sentiment(tables.event_bars(spark, d), _sentiment(spark, d))
    return features.return_features(joined)


def _anomaly(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.sentiment_anomaly(_joined(spark, d))


def _events(spark: SparkSession) -> DataFrame:
    return events.event_list(spark, EVENT_HOURS, "ALL", "timestamp_ntz")


def _split(spark: SparkSession, d: str) -> DataFrame:
    """The model table with its split. It is read more than once: its windows are computed once and written."""
    return written(splits.chrono_split(_features(spark, d).select(*KEYS, *FEATURES, TARGET)), "split")


def _standardized(spark: SparkSession, d: str) -> DataFrame:
    """All splits in deviations from the training split."""
    split = _split(spark, d)
    return models.standardize(split, split.where(F.col("split") == "train"))


def _predictions(spark: SparkSession, d: str, part: str = "test") -> DataFrame:
    part_rows = _standardized(spark, d).where(F.col("split") == part)
    return models.predict_linear(part_rows, FIXED_MODEL)


# --- sources and sinks -------------------------------------------------------


@query
def scan_bars(spark, d):
    return tables.line_bars(spark, d)


@query
def scan_single_series(spark, d):
    return tables.single_series(spark, d)


@query
def scan_event_bars(spark, d):
    return tables.event_bars(spark, d)


@query
def normalize_wide(spark, d):
    """A wide extract (one column per price and symbol) back to long bars."""
    bars, symbols = tables.line_bars(spark, d), RETURN_FLAGS
    prices = [c for c in market.REQUIRED_COLUMNS if c != "Date"]
    wide = (
        bars.groupBy("Date")
        .pivot("symbol", symbols)
        .agg(*[F.first(F.col(f"`{p}`")).alias(p) for p in prices])
    )
    named = wide.select(
        F.col("Date").alias("Datetime"),
        *[F.col(f"`{s}_{p}`").alias(f"{s}|{p}") for s in symbols for p in prices],
    )
    return market.normalize_vendor_extract(named, check=False)


@query
def feature_upsert(spark, d):
    """The feature table after a second, corrected upload of the later rows."""
    table = _features(spark, d).select(*KEYS, *FEATURES, TARGET)
    stored = table.withColumn("version", F.lit(1))
    corrected = (
        table.where(F.col("Date") >= UPSERT_FROM)
        .withColumn("volume_change", F.col("volume_change") + 1)
        .withColumn("version", F.lit(2))
    )
    return sinks.merge_latest(stored, corrected, KEYS, "version")


@query
def feature_view(spark, d):
    return sinks.feature_view(_features(spark, d))


@query
def feature_upload_summary(spark, d):
    return sinks.upload_summary(_features(spark, d), "market_features", 1, "market_training", 1)


@query
def daily_sentiment_export(spark, d):
    return sentiment.sentiment_export(_sentiment(spark, d))


# --- projections, predicates, casts ------------------------------------------


@query
def clean_bars(spark, d):
    return quality.clean_bars(tables.line_bars(spark, d))


@query
def coerce_parse(spark, d):
    """Text dates and numbers, part of them unreadable, by symbol and parsed date."""
    lines = tables.table(spark, d, "lineitem")
    is_open = F.col("l_linestatus") == "O"
    text = lines.select(
        F.col("l_returnflag").alias("symbol"),
        F.when(is_open, F.col("l_shipdate").cast("date").cast("string"))
        .otherwise(F.lit("not shipped"))
        .alias("Date"),
        F.when(F.col("l_returnflag") == "R", F.lit("n/a"))
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("amount"),
    )
    parsed = quality.coerce(text, {"Date": "date", "amount": "double"})
    return parsed.groupBy(*KEYS).agg(
        F.count("*").alias("rows"),
        F.count("amount").alias("numbers"),
        F.sum("amount").alias("amount"),
    )


@query
def finite_guard(spark, d):
    """Quantity over discount with infinities for undiscounted lines, guarded."""
    lines = tables.table(spark, d, "lineitem")
    discount = F.col("l_discount")
    per_discount = F.when(discount > 0, F.col("l_quantity") / discount).otherwise(
        F.lit(float("inf"))
    )
    guarded = lines.select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("Date"),
        infinite_to_zero(per_discount).alias("guarded"),
    )
    return guarded.groupBy(*KEYS).agg(
        F.max("guarded").alias("largest"), F.count_if(F.col("guarded") == 0).alias("zeros")
    )


@query
def case_study_window(spark, d):
    return reports.price_and_sentiment(
        tables.event_bars(spark, d), _sentiment(spark, d), CASE_START, CASE_END
    )


@query
def rows_with_news_month(spark, d):
    return sentiment.rows_with_news(_joined(spark, d), 2024, 1)


@query
def features_in_range(spark, d):
    """Features of a date range: the bars before it are cut to the warm-up rows."""
    bars = warm_up(tables.line_bars(spark, d), RANGE_START, features.REACH_VOLATILITY)
    return features.market_features(bars).where(
        F.col("Date").between(F.lit(RANGE_START), F.lit(RANGE_END))
    )


# --- window features ---------------------------------------------------------


def _close_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*KEYS, "Close", *names)


@query
def f_returns(spark, d):
    out = features.return_features(tables.line_bars(spark, d))
    return _close_columns(out, "simple_return", "log_return")


@query
def f_sma(spark, d):
    out = features.sma_features(tables.line_bars(spark, d))
    return _close_columns(out, "sma_10", "sma_20", "sma_ratio_10", "sma_ratio_20")


@query
def f_ema(spark, d):
    out = features.ema_features(tables.line_bars(spark, d))
    return _close_columns(out, "ema_10", "ema_20", "ema_ratio_10", "ema_ratio_20")


@query
def f_macd(spark, d):
    out = features.macd_features(tables.line_bars(spark, d))
    return _close_columns(out, "macd", "macd_signal", "macd_hist")


@query
def f_rsi(spark, d):
    return _close_columns(features.rsi_features(tables.line_bars(spark, d)), "rsi_14")


@query
def f_momentum(spark, d):
    out = features.momentum_features(tables.line_bars(spark, d))
    return _close_columns(out, "mom_5", "mom_10", "ret_5", "ret_10")


@query
def f_volatility(spark, d):
    out = features.volatility_features(tables.line_bars(spark, d))
    return _close_columns(
        out, "volatility_10", "volatility_20", "volatility_20_sq", "high_low_range"
    )


@query
def f_drawdown(spark, d):
    out = features.drawdown_features(tables.line_bars(spark, d), deep=DEEP_DRAWDOWN)
    return _close_columns(
        out,
        "drawdown_10",
        "drawdown_20",
        "max_drawdown_20",
        "drawdown_change",
        "drawdown_abs",
        "drawdown_persistence",
    )


@query
def f_volume(spark, d):
    return features.volume_features(tables.line_bars(spark, d)).select(
        *KEYS, "Volume", "log_volume", "volume_change", "volume_ma_10", "volume_ratio_10"
    )


@query
def f_target(spark, d):
    return _close_columns(features.target(tables.line_bars(spark, d)), TARGET)


@query
def forward_return(spark, d):
    out = features.forward_returns(tables.line_bars(spark, d))
    return _close_columns(out, "future_return_5d", "future_simple_return_5d")


@query
def label_3class(spark, d):
    out = features.label_three_classes(features.forward_returns(tables.line_bars(spark, d)))
    return out.select(*KEYS, "future_return_5d", "target", "target_order")


@query
def market_features(spark, d):
    return _features(spark, d)


@query
def market_features_wide(spark, d):
    return features.market_features_wide(tables.line_bars(spark, d))


@query
def market_features_by_supplier(spark, d):
    """Many short series: one per supplier."""
    return features.market_features(tables.line_bars(spark, d, "l_suppkey"))


@query
def single_series_features(spark, d):
    """One series cut into blocks of 500 rows with copied neighbours."""
    bars = tables.single_series(spark, d)
    return features.market_features(bars, Series().blocked(500))


@query
def tick_sma(spark, d):
    """Moving averages over every single event of a few hot symbols."""
    out = features.sma_features(tables.event_ticks(spark, d), TICKS)
    return out.select(*KEYS, "event_id", "sma_10", "sma_20", "sma_ratio_20")


@query
def tick_rsi(spark, d):
    out = features.rsi_features(tables.event_ticks(spark, d), TICKS)
    return out.select(*KEYS, "event_id", "rsi_14")


@query
def tick_target(spark, d):
    out = features.target(tables.event_ticks(spark, d), TICKS)
    return out.select(*KEYS, "event_id", TARGET)


@query
def tick_split(spark, d):
    """Chronological split of unbounded series."""
    ticks = tables.event_ticks(spark, d).select(*KEYS, "event_id")
    return splits.chrono_split(ticks, series=TICKS)


# --- sentiment and joins -----------------------------------------------------


@query
def daily_sentiment(spark, d):
    return _sentiment(spark, d)


@query
def sentiment_in_range(spark, d):
    return sentiment.mean_in_range(tables.news(spark, d), CASE_START, CASE_END)


@query
def hybrid_dataset(spark, d):
    wide = features.market_features_wide(tables.event_bars(spark, d))
    return sentiment.hybrid_dataset(wide, _sentiment(spark, d))


@query
def baseline_dataset(spark, d):
    wide = features.market_features_wide(tables.line_bars(spark, d))
    return sentiment.labelled_dataset(wide, use_news=False)


@query
def dataset_metadata(spark, d):
    wide = features.market_features_wide(tables.event_bars(spark, d))
    return sentiment.dataset_metadata(sentiment.hybrid_dataset(wide, _sentiment(spark, d)))


@query
def sentiment_anomaly(spark, d):
    return _anomaly(spark, d).select(
        *KEYS,
        "sentiment_mean",
        "sentiment_smooth",
        "sentiment_baseline",
        "sentiment_anomaly",
        "anomaly_trend",
    )


@query
def sentiment_anomaly_partial(spark, d):
    partial = sentiment.sentiment_anomaly(_joined(spark, d), baseline=30, trend=30, partial=True)
    return partial.select(
        *KEYS, "sentiment_mean", "sentiment_baseline", "sentiment_anomaly", "anomaly_trend"
    )


def _pressure(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.sentiment_pressure(_anomaly(spark, d))


@query
def sentiment_pressure(spark, d):
    pairs = _pressure(spark, d).dropna(subset=["sentiment_pressure", "future_simple_return_5d"])
    return pairs.select(*KEYS, "sentiment_pressure", "future_simple_return_5d")


@query
def pressure_buckets(spark, d):
    return sentiment.pressure_buckets(_pressure(spark, d))


@query
def local_minima(spark, d):
    found = sentiment.local_minima(_anomaly(spark, d), "sentiment_anomaly")
    return found.select(*KEYS, "sentiment_anomaly")


@query
def extreme_days(spark, d):
    found = sentiment.extreme_rows(_anomaly(spark, d), "anomaly_trend")
    return found.select(*KEYS, "anomaly_trend", "threshold")


@query
def return_sentiment(spark, d):
    returns = features.return_features(tables.event_bars(spark, d))
    return reports.return_and_sentiment(returns, _sentiment(spark, d))


@query
def prediction_overlay(spark, d):
    return reports.overlay(tables.line_bars(spark, d), _predictions(spark, d))


# --- events ------------------------------------------------------------------


@query
def pre_event_window(spark, d):
    rows = _sentiment(spark, d).select(*KEYS, "sentiment_mean")
    return events.pre_event_rows(rows, _events(spark), unit="hour").select(
        *KEYS, "event_id", "sentiment_mean"
    )


@query
def outside_event_window(spark, d):
    rows = _sentiment(spark, d).select(*KEYS, "sentiment_mean")
    return events.rows_outside_events(rows, _events(spark), unit="hour")


@query
def trajectory_before(spark, d):
    return events.trajectory_before(_sentiment(spark, d), _events(spark), "sentiment_mean")


@query
def trajectory_around(spark, d):
    return events.trajectory_around(_sentiment(spark, d), _events(spark), "sentiment_momentum")


@query
def event_study(spark, d):
    return events.event_study(_anomaly(spark, d))


@query
def top_crashes(spark, d):
    returns = features.return_features(tables.line_bars(spark, d))
    inside = returns.where(F.col("Date").between(F.lit(RANGE_START), F.lit(RANGE_END)))
    return events.smallest(inside, "log_return", 10).select(*KEYS, "log_return")


@query
def top_crashes_per_symbol(spark, d):
    returns = features.return_features(tables.line_bars(spark, d))
    return events.smallest_per_series(returns, "log_return", 5).select(*KEYS, "log_return", "rank")


@query
def crash_zoom(spark, d):
    returns = features.return_features(tables.line_bars(spark, d)).select(
        *KEYS, "Close", "log_return"
    )
    return events.crash_zoom(returns, "log_return", 3)


# --- correlations ------------------------------------------------------------


@query
def feature_correlation(spark, d):
    return correlation.correlation_matrix(_features(spark, d), FEATURES, complete=True)


@query
def target_correlation(spark, d):
    wide = features.market_features_wide(tables.line_bars(spark, d))
    labelled = sentiment.labelled_dataset(wide, use_news=False)
    return correlation.target_correlation(labelled, BASELINE_FEATURES, "future_return_5d")


@query
def cross_correlation(spark, d):
    returns = features.return_features(tables.event_bars(spark, d))
    pairs = reports.return_and_sentiment(returns, _sentiment(spark, d))
    return correlation.cross_correlation(pairs, "sentiment_mean", "return")


# --- evaluation --------------------------------------------------------------


@query
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(tables.scored_documents(spark, d))


@query
def classification_metrics(spark, d):
    return metrics.classification_metrics(tables.scored_documents(spark, d))


@query
def roc_auc(spark, d):
    return metrics.roc_auc(tables.scored_documents(spark, d))


@query
def roc_curve(spark, d):
    return metrics.roc_curve(tables.scored_documents(spark, d))


@query
def probability_histogram(spark, d):
    return metrics.probability_histogram(tables.scored_documents(spark, d))


@query
def sentiment_histogram(spark, d):
    """50 equal bins over the range of all news scores."""
    return metrics.range_histogram(tables.news(spark, d), "sentiment_score", ["symbol"])


@query
def target_distribution(spark, d):
    return reports.target_distribution(_features(spark, d))


@query
def label_distribution(spark, d):
    labelled = features.label_three_classes(features.forward_returns(tables.line_bars(spark, d)))
    return reports.label_distribution(labelled)


@query
def model_comparison(spark, d):
    return metrics.model_comparison(metrics.evaluate(tables.scored_documents(spark, d)))


# --- contracts ---------------------------------------------------------------


@query
def raw_quality(spark, d):
    """Fail-fast checks on single order lines, whose dates repeat."""
    return quality.raw_quality(tables.line_rows(spark, d))


@query
def raw_contract(spark, d):
    return contracts.evaluate(tables.line_bars(spark, d), contracts.raw_contract())


@query
def raw_contract_lines(spark, d):
    """The same contract on single order lines, which break several rules."""
    return contracts.evaluate(tables.line_rows(spark, d), contracts.raw_contract())


@query
def feature_contract(spark, d):
    """Stored order is the date order the table is written in."""
    stored = _features(spark, d).withColumn(contracts.ROW_POSITION, F.unix_date("Date"))
    return contracts.evaluate(stored, contracts.feature_contract())


@query
def contract_report(spark, d):
    results = contracts.evaluate(tables.line_rows(spark, d), contracts.raw_contract())
    report = contracts.report(results, contracts.RAW_CONTRACT_NAME, "order_lines")
    return report.select(
        "validation_name",
        "success",
        "total_expectations",
        "successful_expectations",
        "failed_expectations",
        F.array_join("failed_expectation_types", ",").alias("failed_expectation_types"),
        F.array_join(
            F.transform("failed_expectation_details", lambda e: F.coalesce(e["column"], F.lit("-"))),
            ",",
        ).alias("failed_columns"),
        "dataset_name",
    )


@query
def contract_violations(spark, d):
    """Order lines that break a row rule, counted by symbol and rule."""
    rules = [r for r in contracts.raw_contract() if r.type != contracts.UNIQUE]
    bad = contracts.violations(tables.line_rows(spark, d), rules)
    return bad.groupBy("symbol", F.col("failed_rule").alias("rule")).agg(
        F.count("*").alias("rows")
    )


@query
def feature_admission(spark, d):
    return contracts.feature_admission(_features(spark, d))


@query
def duplicate_keys(spark, d):
    return market.duplicate_keys(tables.line_rows(spark, d), KEYS)


# --- splits and drift --------------------------------------------------------


@query
def chrono_split(spark, d):
    return splits.chrono_split(_features(spark, d)).select(*KEYS, "split")


@query
def drift_split(spark, d):
    return splits.drift_split(_features(spark, d)).select(*KEYS, "period")


@query
def split_series(spark, d):
    return reports.split_series(_features(spark, d))


@query
def split_summary(spark, d):
    return splits.split_summary(splits.chrono_split(_features(spark, d)))


@query
def drift_wasserstein(spark, d):
    return drift.wasserstein(splits.drift_split(_features(spark, d)))


@query
def drift_ks(spark, d):
    return drift.ks_statistic(splits.drift_split(_features(spark, d)))


@query
def drift_summary(spark, d):
    period = splits.drift_split(_features(spark, d))
    summary = drift.drift_summary(period, drift.wasserstein(period))
    return summary.select(
        "reference_rows",
        "current_rows",
        F.array_join("features", ",").alias("features"),
        "number_of_features",
        "dataset_drift",
        "drifted_columns_count",
        "drifted_columns_share",
    )


# --- learning, scoring, explanation ------------------------------------------


@query
def standardize(spark, d):
    return _standardized(spark, d)


@query
def score_fixed_coeff(spark, d):
    return _predictions(spark, d)


@query
def evaluate_model(spark, d):
    rows = _standardized(spark, d).where(F.col("split") != "train")
    scored = models.predict_linear(rows, FIXED_MODEL, keep=["split", *KEYS])
    return metrics.evaluate(scored, ["split"])


@query
def batch_scoring(spark, d):
    """Requests for the test rows; wild volume moves arrive as missing."""
    rows = _standardized(spark, d).where(F.col("split") == "test").select(*KEYS, *FEATURES)
    wild = F.abs(F.col("volume_change")) > 3
    requests = rows.withColumn("volume_change", F.when(~wild, F.col("volume_change")))
    return models.score(requests, FIXED_MODEL)


@query
def shap_values(spark, d):
    rows = _standardized(spark, d).where(F.col("split") == "validation")
    return explain.shap_values(rows, FIXED_MODEL)


@query
def shap_importance(spark, d):
    return explain.shap_importance(shap_values(spark, d), FEATURES)


@query
def shap_summary(spark, d):
    summary = explain.shap_summary(shap_values(spark, d), FEATURES, "fixed_logistic", "1")
    return summary.select(
        "model_name",
        "model_version",
        "explainer_type",
        "explained_dataset",
        "n_observations",
        "n_features",
        "positive_class",
        F.array_join(F.transform("top_features", lambda t: t["feature"]), ",").alias("top_features"),
    )


@query
def run_log(spark, d):
    """Logged counts of an evaluation, keyed by stage."""
    counts = metrics.confusion_matrix(tables.scored_documents(spark, d)).where(
        F.col("model") == "champion"
    )
    wide = counts.agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("rows"))).alias("correct"),
    )
    return sinks.run_log_rows("run-1", "baseline_test", "metric", wide)


@query
def predictions_in_range(spark, d):
    """Dates arrive as text; unreadable ones are dropped."""
    stored = _predictions(spark, d).withColumn("Date", F.col("Date").cast("string"))
    return reports.predictions_in_range(stored, "2000-01-01", "2000-12-31")


@query
def train_lr(spark, d):
    """Coefficients of the logistic regression fitted on the training split."""
    split = _split(spark, d)
    model = models.train_logistic(split.where(F.col("split") == "train"))
    test = split.where(F.col("split") == "test")
    scored = models.predict_linear(test, model)
    cells = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.lit(w).alias("coefficient"))
            for f, w in zip((*model.features, "intercept"), (*model.coefficients, model.intercept))
        ]
    )
    return scored.agg(
        F.count("*").alias("test_rows"), F.avg("probability_up").alias("mean_probability")
    ).select(F.inline(cells), "test_rows", "mean_probability")


@query
def train_rf(spark, d):
    """Test metrics of the random forest fitted on the training split."""
    split = _split(spark, d)
    forest = models.train_forest(split.where(F.col("split") == "train"))
    test = split.where(F.col("split") == "test").withColumn("model", F.lit("random_forest"))
    scored = models.predict_forest(test, forest, keep=["model", *KEYS])
    return metrics.evaluate(scored)


# --- inputs the plain queries do not have: fine prices, gaps, odd times, wrong order ------


def _fine_trades(spark: SparkSession, d: str) -> tuple:
    """Order lines with prices of many decimals, a third of them negative."""
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) / 7
    sign = F.when(F.col("l_linenumber") % 3 == 0, -1.0).otherwise(1.0)
    return (
        tables.table(spark, d, "lineitem"),
        F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        price * sign,
        F.col("l_quantity"),
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("Date"),
    )


@query
def scan_bars_fine(spark, d):
    """Bars of prices that no fixed number of decimals holds."""
    return tables.to_bars(*_fine_trades(spark, d))


def _gappy_bars(spark: SparkSession, d: str) -> DataFrame:
    """Daily bars that lack some closes, the first ones among them."""
    bars = tables.line_bars(spark, d)
    gone = (F.dayofyear("Date") % 11).isin(0, 3, 4) | (F.col("Date") < "1992-02-01")
    return bars.withColumn("Close", F.when(~gone, F.col("Close")))


@query
def f_ema_gaps(spark, d):
    return _close_columns(features.ema_features(_gappy_bars(spark, d)), "ema_10", "ema_20")


@query
def f_macd_gaps(spark, d):
    return _close_columns(features.macd_features(_gappy_bars(spark, d)), "macd", "macd_signal")


def _sparse_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars of which one in ten has a close."""
    bars = tables.line_bars(spark, d)
    return bars.withColumn("Close", F.when(F.dayofyear("Date") % 10 == 7, F.col("Close")))


@query
def f_ema_sparse(spark, d):
    return _close_columns(features.ema_features(_sparse_bars(spark, d)), "ema_10", "ema_20")


@query
def f_macd_sparse(spark, d):
    return _close_columns(features.macd_features(_sparse_bars(spark, d)), "macd", "macd_signal")


@query
def feature_contract_newest_first(spark, d):
    """A feature table stored newest first breaks exactly the order rule."""
    stored = _features(spark, d).withColumn(contracts.ROW_POSITION, -F.unix_date("Date"))
    return contracts.evaluate(stored, contracts.feature_contract())


@query
def contract_report_unjudged(spark, d):
    """Without a stored order one feature rule cannot be judged, so the run is no success."""
    results = contracts.evaluate(_features(spark, d), contracts.feature_contract())
    return contracts.report(results, contracts.FEATURE_CONTRACT_NAME, "features").select(
        "validation_name",
        "success",
        "total_expectations",
        "successful_expectations",
        "failed_expectations",
        "unevaluated_expectations",
    )


ODD_EVENTS = [f"2024-01-{day:02d} {time}" for day, time in ((5, "12:30:00"), (9, "00:00:01"), (20, "23:59:59"))]


def _odd_events(spark: SparkSession) -> DataFrame:
    return events.event_list(spark, ODD_EVENTS, "ALL", "timestamp_ntz")


@query
def pre_event_window_any_time(spark, d):
    rows = _sentiment(spark, d).select(*KEYS, "sentiment_mean")
    return events.pre_event_rows(rows, _odd_events(spark), unit="hour").select(
        *KEYS, "event_id", "sentiment_mean"
    )


@query
def outside_event_window_any_time(spark, d):
    rows = _sentiment(spark, d).select(*KEYS, "sentiment_mean")
    return events.rows_outside_events(rows, _odd_events(spark), unit="hour")


@query
def tick_positions_at_events(spark, d):
    """Where events fall in a series of ticks: rows before each one."""
    ticks = tables.event_ticks(spark, d)
    marks = events.event_list(spark, ODD_EVENTS, "view", "timestamp_ntz")
    return events.event_positions(ticks, marks, TICKS).select(
        "symbol", "event_id", F.col("_at").alias("rows_before")
    )


@query
def drift_ks_verdict(spark, d):
    return drift.ks_drift(splits.drift_split(_features(spark, d)))


@query
def train_lr_facts(spark, d):
    """Whether the slope of the penalised loss vanishes at the fitted weights, by coefficient."""
    split = splits.require_parts(_split(spark, d))
    train = split.where(F.col("split") == "train")
    model = models.train_logistic(train)
    error = model.probability() - F.col(TARGET)
    slopes = train.agg(
        F.count("*").alias("_n"),
        *[F.avg(error * model.z(f)).alias(f"_g{i}") for i, f in enumerate(model.features)],
        F.avg(error).alias("_g"),
    )
    cells = [
        F.struct(
            F.lit(f).alias("feature"),
            (F.abs(F.col(f"_g{i}") + F.lit(w) / (models.LOGISTIC["c"] * F.col("_n"))) < 1e-5).alias("stationary"),
        )
        for i, (f, w) in enumerate(zip(model.features, model.coefficients))
    ]
    cells.append(F.struct(F.lit("intercept").alias("feature"), (F.abs("_g") < 1e-5).alias("stationary")))
    return slopes.select(F.inline(F.array(*cells)), F.col("_n").alias("train_rows"))


@query
def train_rf_bounds(spark, d):
    """Whether the forest separates the classes as well as fixed bounds ask, by split."""
    split = splits.require_parts(_split(spark, d))
    forest = models.train_forest(split.where(F.col("split") == "train"))
    found = metrics.evaluate(models.predict_forest(split, forest, keep=["split", *KEYS]), ["split"])
    return found.select(
        "split",
        (F.col("accuracy") > FOREST_BOUNDS["accuracy"]).alias("accurate"),
        (F.col("roc_auc") > FOREST_BOUNDS["roc_auc"]).alias("separates"),
    )


@query
def train_rf_facts(spark, d):
    """Size of the forest, rows of its splits, and its predictions against their probabilities."""
    split = splits.require_parts(_split(spark, d))
    forest = models.train_forest(split.where(F.col("split") == "train"))
    fitted = forest.stages[-1]
    scored = models.predict_forest(split, forest, keep=["split", *KEYS])
    up = F.col("probability_up")
    return scored.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.lit(fitted.getNumTrees).cast("int").alias("trees"),
        F.lit(max(t.depth for t in fitted.trees) <= models.FOREST["max_depth"]).alias("depth_in_bounds"),
        F.bool_and(up.between(0, 1)).alias("probabilities_in_range"),
        F.bool_and((up > 0.5).cast("int") == F.col("predicted_target")).alias("predictions_follow"),
    )


# --- streams: the tables arrive in batches by time; every batch restarts the query ---------

BATCHES = 3


def _arriving(rows: DataFrame, time: str, start: Callable[[DataFrame], object]) -> None:
    """Append ``rows`` to a folder in batches by ``time`` and run the stream after each."""
    spark, folder = rows.sparkSession, scratch_path(rows.sparkSession, "arriving")
    at = runs.micros(time)
    shares = F.array(*[F.lit(i / BATCHES) for i in range(1, BATCHES)])
    (cuts,) = rows.agg(F.percentile_approx(at, shares)).first()
    batch = sum(((at > c).cast("int") for c in cuts or []), F.lit(0))
    for number in range(BATCHES):
        rows.where(batch == number).write.mode("append").parquet(folder)
        start(spark.readStream.schema(rows.schema).parquet(folder)).awaitTermination()


@query
def stream_event_bars(spark, d):
    """Hourly bars of purchases that arrive in batches."""
    events = tables.table(spark, d, "events").where(F.col("event_type") == "purchase")
    trades = events.select(
        F.concat(F.lit("ALL"), F.left("event_type", F.lit(0))).alias("symbol"),
        "ts",
        F.col("event_id").alias("trade"),
        (F.col("value") + tables.FIRST_EVENT_PRICE).alias("price"),
        F.lit(1).alias("volume"),
    )
    out, checkpoint = scratch_path(spark, "stream-bars"), scratch_path(spark, "stream-bars-state")
    _arriving(
        trades,
        "ts",
        lambda rows: stream_bars.start_bars(stream_bars.tumbling_bars(rows), out, "event_bars", checkpoint),
    )
    return stream_bars.latest_bars(spark, out)


@query
def stream_market_features(spark, d):
    """Features of daily bars that arrive in batches."""
    out, checkpoint = scratch_path(spark, "stream-features"), scratch_path(spark, "stream-features-state")
    bars = tables.line_bars(spark, d).select(*KEYS, "Close", "Volume")
    _arriving(bars, "Date", lambda rows: stream_features.start_features(rows, out, checkpoint=checkpoint))
    return spark.read.schema(f"symbol string, Date date, {', '.join(f'{f} double' for f in FEATURES)}, {TARGET} int").parquet(out)


@query
def stream_contract_gate(spark, d):
    """Order lines that arrive in batches, judged by the raw contract: rows by side and rule."""
    out, checkpoint = scratch_path(spark, "gate"), scratch_path(spark, "gate-state")
    rules = contracts.raw_contract()
    _arriving(tables.line_rows(spark, d), "Date", lambda rows: gate.start_gate(rows, rules, out, checkpoint=checkpoint))
    sides = [
        gate.read_side(spark, out, side).select("symbol", F.lit(side).alias("side"), F.explode_outer(gate.FAILED).alias("rule"))
        for side in (gate.ACCEPTED, gate.QUARANTINE)
    ]
    return sides[0].unionByName(sides[1]).groupBy("symbol", "side", "rule").agg(F.count("*").alias("rows"))


# --- intervals, missing cells, checks while writing ----------------------------------------

WINDOW_MINUTES = 25


def _ticks_and_windows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Every event, and for each symbol the time before each purchase: many intervals that overlap."""
    ticks = tables.event_ticks(spark, d).select("symbol", "Date", "event_id")
    ends = tables.table(spark, d, "events").where(F.col("event_type") == "purchase")
    shown = F.array(*[F.lit(s) for s in ("view", "error", "click")])
    windows = ends.select(
        F.explode(shown).alias("symbol"),
        F.col("event_id").alias("interval_id"),
        F.expr(f"ts - INTERVAL '{WINDOW_MINUTES}' MINUTE").alias("start"),
        F.col("ts").alias("end"),
    )
    return ticks, windows


@query
def tick_rows_inside(spark, d):
    """Every tick with each interval that covers it."""
    return intervals.rows_inside(*_ticks_and_windows(spark, d))


@query
def tick_rows_outside(spark, d):
    return intervals.rows_outside(*_ticks_and_windows(spark, d))


@query
def tick_open_intervals(spark, d):
    return intervals.open_intervals(*_ticks_and_windows(spark, d))


@query
def wide_correlation(spark, d):
    """All 32 features against each other, a seventh of the cells missing."""
    wide = features.market_features_wide(tables.line_bars(spark, d))
    holes = [
        F.when((F.dayofyear("Date") + i) % 7 != 0, F.col(c)).alias(c) for i, c in enumerate(features.WIDE_FEATURES)
    ]
    return correlation.pairwise_correlations(wide.select(*holes), features.WIDE_FEATURES)


@query
def roc_corners(spark, d):
    return metrics.roc_curve(tables.scored_documents(spark, d), corners_only=True)


@query
def feature_contract_while_writing(spark, d):
    """The feature contract, judged while the table is written."""
    stored = _features(spark, d).withColumn(contracts.ROW_POSITION, F.unix_date("Date"))
    folder = scratch_path(spark, "checked-features")
    return contracts.evaluate_while_writing(stored, contracts.feature_contract(), lambda rows: rows.write.parquet(folder))


@query
def raw_contract_while_writing(spark, d):
    """The raw contract on order lines, which break several rules, judged while they are written."""
    folder = scratch_path(spark, "checked-lines")
    return contracts.evaluate_while_writing(
        tables.line_rows(spark, d), contracts.raw_contract(), lambda rows: rows.write.parquet(folder)
    )


@query
def prediction_overlay_written(spark, d):
    """The overlay as written, its one-to-one check part of the write."""
    folder = scratch_path(spark, "overlay")
    reports.write_overlay(tables.line_bars(spark, d), _predictions(spark, d), lambda rows: rows.write.parquet(folder))
    return spark.read.parquet(folder)


# --- text and stored tables: what a run writes is read back and judged ---------------------


@query
def strict_text_bars(spark, d):
    """Bars stored as CSV, read as text, judged cell by cell and cast strictly."""
    root = scratch_path(spark, "landed")
    sinks.write_dataset(tables.line_bars(spark, d), root, "raw_bars")
    return quality.load_clean(market.read_text_csv(spark, f"{root}/{sinks.DATASETS['raw_bars'].path}"))


@query
def stored_predictions(spark, d):
    """The predictions as the named Parquet table gives them back."""
    root = scratch_path(spark, "run")
    sinks.write_dataset(_predictions(spark, d), root, "predictions")
    return sinks.read_dataset(spark, root, "predictions")


@query
def stored_contract_report(spark, d):
    """The contract report as the named JSON table gives it back."""
    root = scratch_path(spark, "run")
    sinks.write_dataset(contract_report(spark, d), root, "raw_contract_report")
    return sinks.read_dataset(spark, root, "raw_contract_report")


@query
def first_duplicate_dates(spark, d):
    """The five repeated keys that a rejected load names."""
    return market.first_duplicates(tables.line_rows(spark, d), KEYS)


# --- samples for the eye: the few rows are the feature ---------------------------------------


@query
def bars_head_tail(spark, d):
    return reports.edge_rows(tables.line_bars(spark, d))


@query
def first_predictions(spark, d):
    """The first 20 test predictions in the order of time."""
    return reports.first_rows(_predictions(spark, d))


# --- small samples --------------------------------------------------------------------------


@query
def drift_ks_suppliers(spark, d):
    """Suppliers of the first nations against the others; few rows have an exact p-value."""
    early = F.col("s_nationkey") < REFERENCE_NATIONS
    rows = tables.table(spark, d, "supplier").withColumn(
        "period", F.when(early, "reference").otherwise("current")
    )
    return drift.ks_statistic(rows, ["s_acctbal", "s_suppkey"])
