import datetime as dt

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.functions.ranks import index_rows, quantiles, running_totals, stretches
from barlake.functions.series import Series
from barlake.operators.features import sma_features
from barlake.operators.splits import chrono_split

FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def ticks(spark, n, hot_share=0.4, seed=0):
    """Ticks of two symbols, a large share of them at one time stamp."""
    rng = np.random.default_rng(seed)
    times = np.where(rng.random(n) < hot_share, 500, rng.integers(0, 1000, n))
    frame = pd.DataFrame(
        {
            "symbol": np.where(rng.random(n) < 0.8, "HOT", "COLD"),
            "Date": [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=int(t)) for t in times],
            "tick": rng.permutation(n),
            "Close": np.round(100 + rng.normal(0, 5, n), 2),
        }
    )
    return spark.createDataFrame(frame), frame


def test_positions_with_a_hot_time_stamp(spark):
    df, frame = ticks(spark, 3000)
    out = index_rows(df, ["symbol"], "Date", "tick", "pos", parts=16).toPandas()
    ordered = frame.sort_values(["symbol", "Date", "tick"])
    ordered["expected"] = ordered.groupby("symbol").cumcount()
    both = out.merge(ordered, on="tick")
    assert len(both) == 3000 and (both["pos"] == both["expected"]).all()


def test_hot_time_stamp_is_split_over_stretches(spark):
    """No stretch may hold much more than its share of the rows, nor do results depend on the cuts."""
    df, _ = ticks(spark, 4000, hot_share=0.6)
    sizes = [r["count"] for r in stretches(df, ["symbol", "Date", "tick"], 16).groupBy("_stretch").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 14 and max(sizes) < 2.5 * 4000 / 16
    few, many = (
        index_rows(df, ["symbol"], "Date", "tick", "pos", parts=n).orderBy("tick").toPandas() for n in (2, 23)
    )
    pd.testing.assert_frame_equal(few, many)


def missing_ticks(spark):
    """Ticks without key, time or tie among others."""
    day = dt.datetime(2024, 1, 1)
    rows = [("A", day + dt.timedelta(hours=i), i, float(i)) for i in range(9)]
    rows += [(None, day, 20, 1.0), (None, None, 21, 2.0), ("A", None, 22, 3.0), ("B", day, None, 4.0)]
    return spark.createDataFrame(rows, "symbol string, Date timestamp_ntz, tick long, Close double")


def test_blocks_keep_every_row(spark):
    df = missing_ticks(spark)
    series = Series(time="Date", tie="tick", block_rows=2)
    plain, blocked = sma_features(df, Series(time="Date", tie="tick")), sma_features(df, series)
    assert plain.count() == blocked.count() == 13
    assert sorted(map(str, plain.collect())) == sorted(map(str, blocked.collect()))
    split = chrono_split(df, series=series)
    assert split.count() == 13 and split.where("symbol IS NULL").count() == 2


def test_missing_keys_keep_their_totals(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("k", 1.0)], "k string, v double")
    rows = running_totals(df, ["k"], "v", {"n": F.lit(1)}).collect()
    assert {(r["k"], r["v"], r["n_before"], r["n_total"]) for r in rows} == {(None, 1.0, 0, 2), (None, 2.0, 1, 2), ("k", 1.0, 0, 1)}


def test_blocks_of_long_series_equal_pandas(spark):
    df, frame = ticks(spark, 2500)
    series = Series(time="Date", tie="tick", block_rows=100)
    out = sma_features(df, series).toPandas().set_index("tick")["sma_20"]
    frame = frame.sort_values(["symbol", "Date", "tick"])
    frame["expected"] = frame.groupby("symbol")["Close"].transform(lambda c: c.rolling(20).mean())
    expected = frame.set_index("tick")["expected"].sort_index()
    np.testing.assert_allclose(out.sort_index(), expected, atol=1e-9)


def test_split_of_long_series(spark):
    df, frame = ticks(spark, 2000)
    series = Series(time="Date", tie="tick", block_rows=100)
    out = chrono_split(df, series=series).toPandas()
    for symbol, part in out.groupby("symbol"):
        n = int((frame["symbol"] == symbol).sum())
        sizes = part["split"].value_counts()
        assert sizes["train"] == int(n * 0.7) and sizes["validation"] == int(n * 0.15)
        order = part.sort_values(["Date", "tick"])["split"].tolist()
        assert order == sorted(order, key=["train", "validation", "test"].index)


@FEW
@given(st.lists(st.integers(-50, 50).map(lambda v: v / 4), min_size=1, max_size=200))
def test_running_totals_equal_brute_force(spark, values):
    df = spark.createDataFrame([("k", v) for v in values], "k string, v double")
    out = running_totals(df, ["k"], "v", {"n": F.lit(1)}, parts=8).toPandas().sort_values("v")
    distinct, counts = np.unique(values, return_counts=True)
    assert out["v"].tolist() == distinct.tolist() and out["n"].tolist() == counts.tolist()
    assert out["n_before"].tolist() == (np.cumsum(counts) - counts).tolist()
    assert (out["n_total"] == len(values)).all()
    assert out["next_value"].tolist()[:-1] == distinct.tolist()[1:]
    assert pd.isna(out["next_value"].tolist()[-1])


@FEW
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=150))
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([("k", float(v)) for v in values], "k string, v double")
    shares = {"low": 0.05, "mid": 0.5, "high": 0.75, "top": 1.0}
    row = quantiles(df, ["k"], "v", shares).first()
    for name, share in shares.items():
        np.testing.assert_allclose(row[name], np.percentile(values, share * 100), atol=1e-6)


def test_missing_values_do_not_count(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", None), ("k", 3.0)], "k string, v double")
    assert quantiles(df, ["k"], "v", {"mid": 0.5}).first()["mid"] == 2.0
