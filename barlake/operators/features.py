"""Market features and targets: row-framed windows over keyed series.

Every feature group is a function from the window that orders one series (or
one block of a long series) to *layers*: dictionaries of named columns, where
a layer may read the input and the layers before it. Groups are combined layer
by layer, so a whole feature set costs one exchange, one sort and one window
operator per layer, however many groups it has.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.ema import averages
from barlake.functions.scalars import finite_or_null, gain, loss, ratio
from barlake.functions.series import DAILY, Series, lag, lead, roll
from barlake.schemas import FEATURES, TARGET

Layers = list[dict[str, Column]]
Group = Callable[[WindowSpec], Layers]

# Rows reached back by the frames of each group, nesting included.
REACH_RSI = 14
REACH_VOLATILITY = 20
REACH_SMA = 19
REACH_DRAWDOWN = 38

# Derived columns of the wide feature set, in table order.
WIDE_FEATURES = [
    "simple_return",
    "log_return",
    "sma_10",
    "sma_20",
    "ema_10",
    "ema_20",
    "sma_ratio_10",
    "sma_ratio_20",
    "ema_ratio_10",
    "ema_ratio_20",
    "mom_5",
    "mom_10",
    "rsi_14",
    "macd",
    "macd_signal",
    "macd_hist",
    "volatility_10",
    "volatility_20",
    "high_low_range",
    "drawdown_10",
    "drawdown_20",
    "max_drawdown_20",
    "drawdown_change",
    "drawdown_abs",
    "drawdown_persistence",
    "volatility_20_sq",
    "ret_5",
    "ret_10",
    "log_volume",
    "volume_change",
    "volume_ma_10",
    "volume_ratio_10",
]
PERSISTENT_DRAWDOWN = -0.02
LABEL_UP, LABEL_DOWN = 0.015, -0.015
HORIZON = 5


def returns(w: WindowSpec) -> Layers:
    move = ratio(F.col("Close"), lag(F.col("Close"), 1, w))
    return [{"simple_return": move - 1, "log_return": F.ln(move)}]


def sma(w: WindowSpec) -> Layers:
    close = F.col("Close")
    return [
        {f"sma_{n}": roll(close, n, F.avg, w) for n in (10, 20)},
        {f"sma_ratio_{n}": ratio(close, F.col(f"sma_{n}")) - 1 for n in (10, 20)},
    ]


def rsi(w: WindowSpec) -> Layers:
    """Relative strength over simple means of 14 gains and losses.

    Without any loss the index is 100; without any move it is NULL.
    """
    change, up, down = F.col("_change"), F.col("_up"), F.col("_down")
    return [
        {"_change": F.col("Close") - lag(F.col("Close"), 1, w)},
        {"_up": roll(gain(change), 14, F.avg, w), "_down": roll(loss(change), 14, F.avg, w)},
        {
            "rsi_14": F.when((down == 0) & (up > 0), F.lit(100.0)).when(
                down > 0, 100 - 100 / (1 + ratio(up, down))
            )
        },
    ]


def volatility(w: WindowSpec) -> Layers:
    """Reads ``log_return``."""
    r = F.col("log_return")
    return [
        {"high_low_range": ratio(F.col("High") - F.col("Low"), F.col("Close"))},
        {
            "volatility_10": roll(r, 10, F.stddev_samp, w),
            "volatility_20": roll(r, 20, F.stddev_samp, w),
            "volatility_20_sq": roll(r * r, 20, F.avg, w),
        },
    ]


def short_volatility(w: WindowSpec) -> Layers:
    """Reads ``log_return``; the one volatility that is a model feature."""
    return [{}, {"volatility_10": roll(F.col("log_return"), 10, F.stddev_samp, w)}]


def momentum(w: WindowSpec) -> Layers:
    """Reads ``log_return``."""
    close, r = F.col("Close"), F.col("log_return")
    return [
        {f"mom_{n}": ratio(close, lag(close, n, w)) - 1 for n in (5, 10)},
        {f"ret_{n}": roll(r, n, F.sum, w) for n in (5, 10)},
    ]


def drawdown(w: WindowSpec, deep: float = PERSISTENT_DRAWDOWN) -> Layers:
    close, dd = F.col("Close"), F.col("drawdown_20")
    is_deep = F.coalesce(dd < deep, F.lit(False)).cast("int")
    return [
        {f"_peak_{n}": roll(close, n, F.max, w) for n in (10, 20)},
        {
            f"drawdown_{n}": ratio(close - F.col(f"_peak_{n}"), F.col(f"_peak_{n}"))
            for n in (10, 20)
        },
        {
            "max_drawdown_20": roll(dd, 20, F.min, w),
            "drawdown_change": dd - lag(dd, 1, w),
            "drawdown_abs": F.abs(dd),
            "drawdown_persistence": roll(is_deep, 10, F.sum, w).cast("double"),
        },
    ]


def volume_change(w: WindowSpec) -> Layers:
    """Missing when the volume before is not positive."""
    volume, previous = F.col("Volume"), lag(F.col("Volume"), 1, w)
    return [{"volume_change": F.when(previous > 0, ratio(volume, previous) - 1)}]


def volume_level(w: WindowSpec) -> Layers:
    volume = F.col("Volume")
    return [
        {"log_volume": F.log1p(volume), "volume_ma_10": roll(volume, 10, F.avg, w)},
        {"volume_ratio_10": ratio(volume, F.col("volume_ma_10"))},
    ]


def smooth_ratios(w: WindowSpec) -> Layers:
    """Reads ``ema_10`` and ``ema_20``."""
    return [{f"ema_ratio_{n}": ratio(F.col("Close"), F.col(f"ema_{n}")) - 1 for n in (10, 20)}]


def next_target(w: WindowSpec) -> Layers:
    """1 if the next close is higher, else 0; NULL on the last row."""
    upcoming = lead(F.col("Close"), 1, w)
    return [{TARGET: F.when(upcoming.isNotNull(), (upcoming > F.col("Close")).cast("int"))}]


def forward(w: WindowSpec) -> Layers:
    """Reads ``log_return``: sum of the next 5 log returns, and the 5-step return."""
    r, frame = F.col("log_return"), w.rowsBetween(1, HORIZON)
    ahead = lead(F.col("Close"), HORIZON, w)
    return [
        {"future_simple_return_5d": ratio(ahead, F.col("Close")) - 1},
        {"future_return_5d": F.when(F.count(r).over(frame) == HORIZON, F.sum(r).over(frame))},
    ]


def add(df: DataFrame, w: WindowSpec, *groups: Group) -> DataFrame:
    """Add the columns of all groups, one step per layer; names with _ are dropped."""
    helpers: set[str] = set()
    for layer in zip_longest(*[group(w) for group in groups], fillvalue={}):
        columns = {name: column for part in layer for name, column in part.items()}
        helpers |= {name for name in columns if name.startswith("_")}
        df = df.withColumns(columns) if columns else df
    return df.drop(*helpers)


def _apply(
    bars: DataFrame, series: Series, *groups: Group, back: int, forward: int = 0
) -> DataFrame:
    return series.apply(bars, lambda df, w: add(df, w, *groups), back=back, forward=forward)


def return_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, returns, back=1)


def sma_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, sma, back=REACH_SMA)


def rsi_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, rsi, back=REACH_RSI)


def volatility_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, returns, volatility, back=REACH_VOLATILITY)


def momentum_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, returns, momentum, back=10)


def drawdown_features(
    bars: DataFrame, series: Series = DAILY, deep: float = PERSISTENT_DRAWDOWN
) -> DataFrame:
    return _apply(bars, series, lambda w: drawdown(w, deep), back=REACH_DRAWDOWN)


def volume_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, volume_change, volume_level, back=9)


def target(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, next_target, back=0, forward=1)


def forward_returns(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return _apply(bars, series, returns, forward, back=1, forward=HORIZON)


def ema_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return add(averages(bars, "Close", (10, 20), series=series), series.window(), smooth_ratios)


def macd_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    return averages(bars, "Close", (), macd=True, series=series)


def market_features(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    """The eight model features and the next-step target, complete rows only.

    Rows whose features are missing or not finite are dropped, as is the last
    row of each series. The target compares neighbouring bars before any drop.
    """
    groups = (returns, sma, rsi, short_volatility, volume_change, next_target)
    built = _apply(bars, series, *groups, back=REACH_VOLATILITY, forward=1)
    kept = [c for c in bars.columns if c not in (*FEATURES, TARGET)]
    return built.select(
        *[F.col(f"`{c}`") for c in kept],
        *[finite_or_null(F.col(c)).alias(c) for c in FEATURES],
        TARGET,
    ).dropna(subset=[*FEATURES, TARGET])


def market_features_wide(bars: DataFrame, series: Series = DAILY) -> DataFrame:
    """All 32 derived columns, rows complete in every one of them."""
    groups = (
        returns, sma, smooth_ratios, momentum, rsi, volatility, drawdown, volume_change, volume_level
    )
    averaged = averages(bars, "Close", (10, 20), macd=True, series=series)
    built = _apply(averaged, series, *groups, back=REACH_DRAWDOWN)
    return built.select(*[F.col(f"`{c}`") for c in bars.columns], *WIDE_FEATURES).dropna(
        subset=WIDE_FEATURES
    )


def label_three_classes(
    df: DataFrame,
    column: str = "future_return_5d",
    up: float = LABEL_UP,
    down: float = LABEL_DOWN,
) -> DataFrame:
    """``target`` bearish / neutral / bullish and its order ``target_order``."""
    r = F.col(column)
    return df.where(r.isNotNull()).withColumns(
        {
            "target": F.when(r > up, "bullish").when(r < down, "bearish").otherwise("neutral"),
            "target_order": F.when(r > up, 2).when(r < down, 0).otherwise(1),
        }
    )
