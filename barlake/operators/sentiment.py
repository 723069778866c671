"""News sentiment: aggregation, smoothing, the joined dataset, buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.ranks import quantiles
from barlake.functions.scalars import loss
from barlake.functions.series import DAILY, Series, lag, lead, roll, roll_partial
from barlake.operators.features import HORIZON, add, forward, label_three_classes
from barlake.schemas import BASELINE_FEATURES, NEWS_FEATURES, DataContractError

SENTIMENT_COLUMNS = ["sentiment_mean", "sentiment_std", "news_volume", "sentiment_momentum"]

# Bucket names from the lowest quartile up, and the zero group.
PRESSURE_LABELS = ["Very Negative", "Negative", "Mild Negative", "Slight Negative"]
NO_PRESSURE = "No Negative Sentiment"


def daily_sentiment(news: DataFrame, series: Series = DAILY) -> DataFrame:
    """Mean, sample deviation, log volume and mean change per step with news.

    The aggregation combines on the map side, so a step that holds a third of
    all news costs no more than any other; its output has one row per step.
    """
    score = F.col("sentiment_score")
    steps = news.groupBy(*series.keys, series.time).agg(
        F.avg(score).alias("sentiment_mean"),
        F.stddev_samp(score).alias("sentiment_std"),
        F.log1p(F.count(score)).alias("news_volume"),
    )
    mean = F.col("sentiment_mean")
    return series.apply(
        steps,
        lambda df, w: df.withColumn("sentiment_momentum", mean - lag(mean, 1, w)),
        back=1,
    )


def sentiment_export(sentiment: DataFrame) -> DataFrame:
    return sentiment.select("symbol", "Date", F.col("sentiment_mean").alias("sentiment"))


def mean_in_range(news: DataFrame, start, end) -> DataFrame:
    """Mean raw score per step, steps in the closed range only."""
    return (
        news.where(F.col("Date").between(start, end))
        .groupBy("symbol", "Date")
        .agg(F.avg("sentiment_score").alias("sentiment_mean"))
    )


def feature_columns(available: list[str], use_news: bool = True) -> tuple[str, list[str]]:
    """Mode and feature list that the columns at hand allow."""
    market = [c for c in BASELINE_FEATURES if c in available]
    news = [c for c in NEWS_FEATURES if c in available] if use_news else []
    if not market and not news:
        raise DataContractError("The table has none of the market or news features")
    return ("HYBRID" if news else "BASELINE"), market + news


def join_sentiment(market: DataFrame, sentiment: DataFrame, series: Series = DAILY,
                   lag_availability: bool = False) -> DataFrame:
    """Market rows with the sentiment of the row before; steps without news are 0.

    ``news_available`` tells whether the row itself has news; with
    ``lag_availability`` it is lagged like the other news columns.
    """
    keys = [*series.keys, series.time]
    joined = market.join(sentiment.select(*keys, *SENTIMENT_COLUMNS), keys, "left")
    flagged = joined.withColumn(
        "news_available", F.col("news_volume").isNotNull().cast("int")
    ).fillna(0.0, subset=SENTIMENT_COLUMNS)
    lagged = SENTIMENT_COLUMNS + (["news_available"] if lag_availability else [])
    return series.apply(
        flagged, lambda df, w: df.withColumns({c: lag(F.col(c), 1, w) for c in lagged}), back=1
    )


def labelled_dataset(joined: DataFrame, series: Series = DAILY, use_news: bool = True) -> DataFrame:
    """Features, 5-step return and 3-class target; the last 5 rows are dropped."""
    _, features = feature_columns(joined.columns, use_news)
    news = [c for c in features if c in NEWS_FEATURES]

    def build(df: DataFrame, w: WindowSpec) -> DataFrame:
        ahead = add(df, w, forward)
        return ahead.withColumn("_later", lead(F.col(series.time), HORIZON, w))

    rows = series.apply(joined, build, back=0, forward=HORIZON)
    labelled = label_three_classes(rows.where(F.col("_later").isNotNull()))
    return (
        labelled.fillna(0, subset=news)
        .dropna(subset=[*features, "future_return_5d", "target"])
        .select(*series.keys, series.time, *features, "future_return_5d", "target", "target_order")
    )


def hybrid_dataset(market: DataFrame, sentiment: DataFrame, series: Series = DAILY,
                   lag_availability: bool = False) -> DataFrame:
    return labelled_dataset(join_sentiment(market, sentiment, series, lag_availability), series)


def dataset_metadata(dataset: DataFrame, use_news: bool = True) -> DataFrame:
    mode, features = feature_columns(dataset.columns, use_news)
    return dataset.agg(F.count("*").alias("n_rows")).select(
        F.lit(mode).alias("mode"),
        "n_rows",
        F.lit(len(features)).alias("n_features"),
        F.lit(",".join(features)).alias("features"),
    )


def rows_with_news(joined: DataFrame, year: int, month: int) -> DataFrame:
    return joined.where(
        (F.year("Date") == year) & (F.month("Date") == month) & (F.col("news_available") == 1)
    )


def sentiment_anomaly(
    df: DataFrame,
    series: Series = DAILY,
    smooth: int = 20,
    baseline: int = 60,
    trend: int = 30,
    partial: bool = False,
) -> DataFrame:
    """Smoothed sentiment, its baseline, the anomaly and the anomaly's trend.

    ``partial`` lets windows at the start of a series hold fewer rows.
    """
    over = roll_partial if partial else roll
    mean = F.col("sentiment_mean")

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        based = rows.withColumns(
            {
                "sentiment_smooth": over(mean, smooth, F.avg, w),
                "sentiment_baseline": over(mean, baseline, F.avg, w),
            }
        ).withColumn("sentiment_anomaly", mean - F.col("sentiment_baseline"))
        return based.withColumn(
            "anomaly_trend", over(F.col("sentiment_anomaly"), trend, F.avg, w)
        )

    return series.apply(df, build, back=baseline + trend)


def sentiment_pressure(df: DataFrame, series: Series = DAILY, rows: int = 5) -> DataFrame:
    """Sum of the negative anomalies of the last rows, with forward returns."""

    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        negative = -loss(F.col("sentiment_anomaly"))
        pressed = frame.withColumn("sentiment_pressure", roll(negative, rows, F.sum, w))
        return add(pressed, w, forward)

    return series.apply(df, build, back=rows, forward=HORIZON)


def local_minima(
    df: DataFrame, column: str, threshold: float = -0.1, series: Series = DAILY
) -> DataFrame:
    """Rows under the threshold and lower than both neighbours."""
    x = F.col(column)

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns({"_before": lag(x, 1, w), "_after": lead(x, 1, w)})

    return (
        series.apply(df, build, back=1, forward=1)
        .where((x < threshold) & (F.col("_before") > x) & (F.col("_after") > x))
        .drop("_before", "_after")
    )


def extreme_rows(df: DataFrame, column: str, share: float = 0.05) -> DataFrame:
    """Rows below the exact ``share`` quantile of their series."""
    edge = quantiles(df, ["symbol"], column, {"threshold": share})
    return df.join(edge, "symbol").where(F.col(column) < F.col("threshold"))


def pressure_buckets(pairs: DataFrame) -> DataFrame:
    """Mean forward return and share of drops by quartile of negative pressure.

    Quartile edges are exact and interpolated; buckets are closed on the right
    and the lowest value is included. Edges that coincide raise, as the buckets
    would be ambiguous.
    """
    pairs = pairs.dropna(subset=["sentiment_pressure", "future_simple_return_5d"])
    pressure = F.col("sentiment_pressure")
    names = ["q0", "q1", "q2", "q3", "q4"]
    edges = quantiles(
        pairs.where(pressure < 0),
        ["symbol"],
        "sentiment_pressure",
        {name: i / 4 for i, name in enumerate(names)},
    )
    distinct = F.assert_true(
        F.size(F.array_distinct(F.array(*names))) == len(names),
        F.lit("Quartile edges of the pressure must be distinct"),
    )
    checked = edges.where(distinct.isNull())
    below = [F.col(name) for name in names[1:4]]
    bucket = F.when(pressure == 0, NO_PRESSURE)
    for label, edge in zip(PRESSURE_LABELS, below):
        bucket = bucket.when(pressure <= edge, label)
    bucket = bucket.otherwise(PRESSURE_LABELS[-1])
    future = F.col("future_simple_return_5d")
    return (
        pairs.where(pressure <= 0)
        .join(checked, "symbol", "left")
        .groupBy("symbol", bucket.alias("bucket"))
        .agg(
            F.count("*").alias("rows"),
            (F.avg(future) * 100).alias("mean_future_return_pct"),
            (F.avg((future < 0).cast("double")) * 100).alias("drop_share_pct"),
        )
    )
