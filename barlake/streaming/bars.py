"""Tumbling bars of arriving trades, with a watermark.

The state holds one row an open bar. After each batch the watermark is the largest trade
time so far less ``delay``. A trade whose bar ended at or before the watermark is late and
is left out; every other trade counts, in whatever order and batch it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.streaming.runs import BATCH, start_batches, zoned, zoneless

WIDTH, DELAY = "1 hour", "1 hour"
_BAR = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]


def tumbling_bars(trades: DataFrame, width: str = WIDTH, delay: str = DELAY) -> DataFrame:
    """Bars of (symbol, ts, trade, price, volume); the first and last price by (trade, price).

    Trades without time or price make no bar. Volume is the sum of ``volume``.
    """
    place = F.struct("trade", "price")
    rows = trades.where("ts IS NOT NULL AND price IS NOT NULL").withColumn("_at", zoned("ts"))
    bars = (
        rows.withWatermark("_at", delay)
        .groupBy(F.window("_at", width).alias("_w"), "symbol")
        .agg(
            F.min(place).alias("_first"),
            F.max(place).alias("_last"),
            F.max("price").alias("High"),
            F.min("price").alias("Low"),
            F.sum("volume").cast("bigint").alias("Volume"),
        )
    )
    return bars.select(
        "symbol",
        zoneless("_w.start").alias("Date"),
        F.col("_first.price").alias("Open"),
        "High",
        "Low",
        F.col("_last.price").alias("Close"),
        F.col("_last.price").alias("Adj Close"),
        "Volume",
    )


def start_bars(bars: DataFrame, output: str, name: str = "bars", checkpoint: str | None = None) -> StreamingQuery:
    """Write each batch's new and changed bars below ``output``; :func:`latest_bars` reads them."""
    return start_batches(bars, output, name, "update", checkpoint=checkpoint)


def latest_bars(spark: SparkSession, output: str) -> DataFrame:
    """Every bar as of the last batch that changed it."""
    kept = spark.read.parquet(output).groupBy("symbol", "Date").agg(F.max_by(F.struct(*[f"`{c}`" for c in _BAR]), BATCH).alias("_bar"))
    return kept.select("symbol", "Date", "_bar.*")
