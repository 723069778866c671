"""Sentiment joins and event operators against direct pandas loops."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import pandas_of, weekdays
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barlake.operators import events as E
from barlake.operators import features as X
from barlake.operators import sentiment as S
from barlake.schemas import BAR_SCHEMA, DataContractError

N = 120
DAYS = weekdays("2024-01-01", N)


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(
        {
            "symbol": "T",
            "Date": DAYS,
            "Close": np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.01, N))), 2),
            "sentiment_anomaly": rng.normal(0, 0.12, N),
            "sentiment_mean": np.where(rng.random(N) < 0.1, np.nan, rng.normal(0, 1, N)),
        }
    )
    rows = [
        tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r)
        for r in frame.itertuples(index=False)
    ]
    df = spark.createDataFrame(
        rows, "symbol string, Date date, Close double, sentiment_anomaly double, sentiment_mean double"
    )
    return df, frame


def test_event_study_equals_loop(series):
    df, frame = series
    out = pandas_of(E.event_study(df), "offset")
    returns = np.log(frame["Close"] / frame["Close"].shift())
    paths = []
    for i in frame.index[frame["sentiment_anomaly"] < -0.1]:
        if i - 20 < 1 or i + 20 >= N:  # row 0 has no return
            continue
        paths.append(np.cumsum(returns[i - 20 : i + 21]))
    np.testing.assert_allclose(out["mean_path"], np.mean(paths, axis=0), atol=1e-12)
    assert (out["events"] == len(paths)).all() and out["offset"].tolist() == list(range(-20, 21))
    blocked = E.event_study(df, series=E.DAILY.blocked(30))
    np.testing.assert_allclose(pandas_of(blocked, "offset")["mean_path"], out["mean_path"])


def events_at(spark, *places):
    return E.event_list(spark, [DAYS[i] + dt.timedelta(days=d) for i, d in places], "T")


def test_trajectory_before_equals_loop(spark, series):
    df, frame = series
    places = [(50, 0), (70, 1), (100, 0), (20, 0), (5, 0), (0, 0)]
    events = events_at(spark, *places)
    found = []
    for i, d in places:
        values = frame[frame["Date"] < DAYS[i] + dt.timedelta(days=d)].tail(30)["sentiment_mean"]
        if len(values) > 5 and len(values.dropna()) > 5:
            found.append(values.dropna().values)
    shortest = min(len(v) for v in found)
    matrix = np.vstack([v[-shortest:] for v in found])
    out = pandas_of(E.trajectory_before(df, events, "sentiment_mean"), "day")
    assert out["day"].tolist() == list(range(-shortest, 0)) and (out["events"] == len(found)).all()
    np.testing.assert_allclose(out["mean_value"], matrix.mean(axis=0))
    np.testing.assert_allclose(out["std_value"], matrix.std(axis=0))


def test_trajectory_around_equals_loop(spark, series):
    df, frame = series
    places = [(50, 0), (70, 1), (100, 0), (3, 0), (N - 1, 900)]
    events = events_at(spark, *places)
    found = []
    for i, d in places:
        day = DAYS[i] + dt.timedelta(days=d)
        both = pd.concat([frame[frame["Date"] < day].tail(30), frame[frame["Date"] >= day].head(30)])
        if len(both) >= 10:
            found.append(both["sentiment_mean"].dropna().values)
    shortest = min(len(v) for v in found)
    matrix = np.vstack([v[:shortest] for v in found])
    out = pandas_of(E.trajectory_around(df, events, "sentiment_mean"), "day")
    assert out["day"].tolist() == list(np.arange(-shortest // 2, -shortest // 2 + shortest))
    np.testing.assert_allclose(out["mean_value"], matrix.mean(axis=0))
    np.testing.assert_allclose(out["std_value"], matrix.std(axis=0))


def test_event_windows(spark, series):
    df, frame = series
    days = [DAYS[0], DAYS[30], DAYS[33], DAYS[N - 1] + dt.timedelta(days=3)]
    events = E.event_list(spark, days, "T")
    expected, outside = [], pd.Series(True, index=frame.index)
    for event, day in enumerate(days):
        mask = (frame["Date"] >= day - dt.timedelta(days=10)) & (frame["Date"] < day)
        expected += [(event, d) for d in frame[mask]["Date"]]
        outside &= ~mask
    rows = E.pre_event_rows(df, events).collect()
    assert sorted((r["event_id"], r["Date"]) for r in rows) == sorted(expected)
    kept = sorted(r["Date"] for r in E.rows_outside_events(df, events).collect())
    assert kept == sorted(frame[outside]["Date"])


def test_smallest_and_zoom(series):
    df, frame = series
    worst = frame.nsmallest(4, "sentiment_anomaly")
    out = E.smallest(df, "sentiment_anomaly", 4).collect()
    assert [r["Date"] for r in out] == worst["Date"].tolist()
    zoom = E.crash_zoom(df, "sentiment_anomaly", 4, steps=5)
    low = min(worst["Date"]) - dt.timedelta(days=5)
    high = max(worst["Date"]) + dt.timedelta(days=5)
    expected = [d for d in DAYS if low <= d <= high]
    assert sorted(r["Date"] for r in zoom.collect()) == expected


def news_of(spark, scores):
    rows = [("T", DAYS[i], s) for i, day in enumerate(scores) for s in day]
    return spark.createDataFrame(rows, "symbol string, Date date, sentiment_score double")


def test_daily_sentiment_and_join(spark):
    scores = [[0.5, -0.5, 0.3], [], [0.2], [], [-0.4, -0.6]] + [[]] * 35
    daily = S.daily_sentiment(news_of(spark, scores))
    out = pandas_of(daily)
    assert out["Date"].tolist() == [DAYS[0], DAYS[2], DAYS[4]]
    np.testing.assert_allclose(out["sentiment_mean"], [0.1, 0.2, -0.5])
    assert np.isnan(out["sentiment_std"][1]) and np.isnan(out["sentiment_momentum"][0])
    np.testing.assert_allclose(out["news_volume"], np.log1p([3, 1, 2]))
    np.testing.assert_allclose(out["sentiment_momentum"][1:], [0.1, -0.7])

    bars = spark.createDataFrame(
        [("T", d, 1.0, 2.0, 0.5, 100.0 + i, 100.0, 10 + i) for i, d in enumerate(DAYS[:40])], BAR_SCHEMA
    )
    joined = pandas_of(S.join_sentiment(bars, daily))
    assert joined["news_available"].tolist()[:6] == [1, 0, 1, 0, 1, 0]
    np.testing.assert_allclose(joined["sentiment_mean"][1:6], [0.1, 0, 0.2, 0, -0.5])
    assert np.isnan(joined["sentiment_mean"][0])
    lagged = pandas_of(S.join_sentiment(bars, daily, lag_availability=True))
    assert lagged["news_available"].tolist()[1:6] == [1, 0, 1, 0, 1]


def test_hybrid_dataset_drops_the_last_five_rows(spark):
    rng = np.random.default_rng(2)
    closes = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.02, N))), 2).tolist()
    bars = spark.createDataFrame(
        [("T", d, c, c + 1, c - 1, c, c, 1000 + i) for i, (d, c) in enumerate(zip(DAYS, closes))],
        BAR_SCHEMA,
    )
    wide = X.market_features_wide(bars)
    daily = S.daily_sentiment(news_of(spark, [[0.1]] * N))
    data = S.hybrid_dataset(wide, daily)
    assert data.count() == N - 38 - 5
    assert {r["target"] for r in data.collect()} <= {"bearish", "neutral", "bullish"}
    row = S.dataset_metadata(data).first()
    assert row["mode"] == "HYBRID" and row["n_features"] == 20 and row["n_rows"] == N - 43
    plain = S.labelled_dataset(wide, use_news=False)
    assert S.dataset_metadata(plain, use_news=False).first()["mode"] == "BASELINE"
    assert S.feature_columns(wide.columns)[0] == "BASELINE"
    with pytest.raises(DataContractError, match="none of the market"):
        S.feature_columns(["Date"])


def pairs_of(spark, values):
    rows = [("T", v, (i % 7 - 3) / 100) for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "symbol string, sentiment_pressure double, future_simple_return_5d double"
    )


def test_pressure_buckets_equal_quantile_cut(spark):
    values = [-0.1, -0.2, -0.2, -0.3, -0.45, -0.5, -0.6, -0.7, -0.7, 0.0, 0.0, -0.05, -1.0]
    out = {r["bucket"]: r for r in S.pressure_buckets(pairs_of(spark, values)).collect()}
    frame = pd.DataFrame({"p": values, "r": [(i % 7 - 3) / 100 for i in range(len(values))]})
    negative = frame[frame["p"] < 0].copy()
    negative["bucket"] = pd.qcut(negative["p"], 4, labels=S.PRESSURE_LABELS).astype(str)
    neutral = frame[frame["p"] == 0].assign(bucket=S.NO_PRESSURE)
    for name, part in pd.concat([negative, neutral]).groupby("bucket"):
        assert out[name]["rows"] == len(part)
        assert out[name]["mean_future_return_pct"] == pytest.approx(part["r"].mean() * 100)
        assert out[name]["drop_share_pct"] == pytest.approx((part["r"] < 0).mean() * 100)
    assert len(out) == 5


def test_pressure_buckets_need_distinct_edges(spark):
    with pytest.raises(PySparkException, match="distinct"):
        S.pressure_buckets(pairs_of(spark, [-0.1] * 9 + [-0.2])).collect()


def test_pressure_and_minima(series):
    df, frame = series
    rows = df.withColumn("log_return", F.lit(0.0))
    out = pandas_of(S.sentiment_pressure(rows))["sentiment_pressure"]
    expected = frame["sentiment_anomaly"].clip(upper=0).rolling(5).sum()
    np.testing.assert_allclose(out, expected, atol=1e-12)
    x = frame["sentiment_anomaly"]
    low = frame[(x < -0.1) & (x.shift(1) > x) & (x.shift(-1) > x)]["Date"].tolist()
    assert sorted(r["Date"] for r in S.local_minima(df, "sentiment_anomaly").collect()) == low
    edge = np.percentile(x, 5)
    extreme = {r["Date"] for r in S.extreme_rows(df, "sentiment_anomaly").collect()}
    assert extreme == set(frame[x < edge]["Date"])


def test_anomaly_windows(series):
    df, frame = series
    rows = df.drop("sentiment_anomaly").fillna(0.0, subset=["sentiment_mean"])
    mean = frame["sentiment_mean"].fillna(0)
    out = pandas_of(S.sentiment_anomaly(rows, smooth=20, baseline=30, trend=10))
    anomaly = mean - mean.rolling(30).mean()
    np.testing.assert_allclose(out["sentiment_anomaly"], anomaly, atol=1e-12)
    np.testing.assert_allclose(out["anomaly_trend"], anomaly.rolling(10).mean(), atol=1e-12)
    partial = pandas_of(S.sentiment_anomaly(rows, baseline=30, trend=10, partial=True))
    anomaly = mean - mean.rolling(30, min_periods=1).mean()
    np.testing.assert_allclose(partial["sentiment_anomaly"], anomaly, atol=1e-12)
    assert not partial["anomaly_trend"].isna().any()


def test_windows_of_events_at_any_time(spark):
    """The window of an event at 10:30 holds the hours from 00:30 up to it."""
    hours = spark.range(14).select(
        F.lit("ALL").alias("symbol"),
        F.expr("timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ '2024-01-05 00:00:00')").alias("Date"),
    )
    for time, first, last in (("10:30:00", 1, 10), ("10:00:00", 0, 9), ("10:00:01", 1, 10)):
        marks = E.event_list(spark, [f"2024-01-05 {time}"], "ALL", "timestamp_ntz")
        inside = sorted(r["Date"].hour for r in E.pre_event_rows(hours, marks, unit="hour").collect())
        assert inside == list(range(first, last + 1))
        outside = E.rows_outside_events(hours, marks, unit="hour").count()
        assert outside == 14 - len(inside)
