"""Market features of arriving bars: the last closes of every symbol as state.

Row-framed windows are not allowed on streams, so the state of a symbol holds its last
20 bars: 19 before the newest, and the newest itself, whose target is only known when the
next bar comes. Then it leaves with its features. The watermark is the newest date of all
symbols so far less ``ttl_days``: the state of a symbol whose newest bar is as old expires,
and what comes later starts anew.

A bar is late if it is older than the watermark, or not newer than the bars of its symbol
in earlier batches. Late bars, bars without date, and all but one of a date's bars in a
batch are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barlake.schemas import FEATURES, TARGET
from barlake.streaming.runs import EPOCH, checkpoint_location, micros, zoned

HELD = 20
TTL_DAYS = 365
_STATE = "at array<long>, close array<double>, volume array<double>"
_OUT = "symbol string, micros_at long, " + ", ".join(f"{f} double" for f in FEATURES) + f", {TARGET} int"


def _rolled(x: np.ndarray, n: int, fn) -> np.ndarray:
    """``fn`` over windows of n values; missing unless all n are present."""
    out = np.full(len(x), np.nan)
    if len(x) >= n:
        out[n - 1 :] = fn(np.lib.stride_tricks.sliding_window_view(x, n), axis=1)
    return out


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[np.nan], x[:-1]])


def feature_rows(close: np.ndarray, volume: np.ndarray) -> pd.DataFrame:
    """The model features and the target of consecutive bars; missing cells are NaN."""
    with np.errstate(all="ignore"):
        move = np.where(_before(close) != 0, close / _before(close), np.nan)
        log_return = np.where(move > 0, np.log(move), np.nan)
        sma = {n: _rolled(close, n, np.mean) for n in (10, 20)}
        change = close - _before(close)
        up = _rolled(np.where(np.isnan(change), np.nan, np.maximum(change, 0)), 14, np.mean)
        down = _rolled(np.where(np.isnan(change), np.nan, np.maximum(-change, 0)), 14, np.mean)
        rsi = np.where(down > 0, 100 - 100 / (1 + up / down), np.where((down == 0) & (up > 0), 100.0, np.nan))
        columns = {
            "simple_return": move - 1,
            "log_return": log_return,
            "sma_10": sma[10],
            "sma_20": sma[20],
            "sma_ratio_10": close / sma[10] - 1,
            "rsi_14": rsi,
            "volatility_10": _rolled(log_return, 10, lambda w, axis: np.std(w, axis=axis, ddof=1)),
            "volume_change": np.where(_before(volume) > 0, volume / _before(volume) - 1, np.nan),
        }
    ahead = np.concatenate([close[1:], [np.nan]])
    columns[TARGET] = np.where(np.isnan(ahead) | np.isnan(close), np.nan, ahead > close)
    return pd.DataFrame(columns).replace([np.inf, -np.inf], np.nan)


def _last_closes(ttl_days: int):
    """Emits the bars of a symbol once the next one is there."""

    def advance(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        new = pd.concat(list(rows), ignore_index=True)
        new = new.dropna(subset=["micros_at"]).sort_values(["micros_at", "Close"]).drop_duplicates("micros_at")
        at, close, volume = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        if state.exists:
            at, close, volume = (np.array(v, kind) for v, kind in zip(state.get, (np.int64, float, float)))
            new = new[new["micros_at"] > at[-1]]
        if len(new):
            waiting = max(len(at) - 1, 0)
            at = np.concatenate([at, new["micros_at"].to_numpy(np.int64)])
            close = np.concatenate([close, new["Close"].to_numpy(float)])
            volume = np.concatenate([volume, new["Volume"].to_numpy(float)])
            state.update((at[-HELD:].tolist(), close[-HELD:].tolist(), volume[-HELD:].tolist()))
            done = feature_rows(close, volume).assign(symbol=key[0], micros_at=at).iloc[waiting:-1]
            done = done.dropna(subset=[*FEATURES, TARGET]).astype({TARGET: "int32"})
            yield done[["symbol", "micros_at", *FEATURES, TARGET]]
        if state.exists:
            state.setTimeoutTimestamp(int(at[-1] // 1000 + ttl_days * 86_400_000) + 1)

    return advance


def stream_features(bars: DataFrame, ttl_days: int = TTL_DAYS) -> DataFrame:
    """symbol, Date, the model features and the target of arriving bars, complete rows only.

    Over all batches these are the rows of ``market_features`` of the bars that were not late.
    """
    kind = bars.schema["Date"].dataType.simpleString()
    timed = bars.withColumn("event_time", zoned("Date")).withWatermark("event_time", f"{ttl_days} days")
    slim = timed.select("symbol", "event_time", micros("Date").alias("micros_at"), F.col("Close").cast("double"), F.col("Volume").cast("double"))
    found = slim.groupBy("symbol").applyInPandasWithState(
        _last_closes(ttl_days), _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    date = F.timestamp_add("MICROSECOND", F.col("micros_at"), F.expr(EPOCH)).cast(kind)
    return found.select("symbol", date.alias("Date"), *FEATURES, TARGET)


def start_features(
    bars: DataFrame, output: str, name: str = "features", ttl_days: int = TTL_DAYS, checkpoint: str | None = None
) -> StreamingQuery:
    """Append the features of all bars that are there now to the Parquet table at ``output``."""
    return (
        stream_features(bars, ttl_days)
        .writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint or checkpoint_location(bars, name))
        .trigger(availableNow=True)
        .start(output)
    )
