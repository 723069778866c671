"""Canonical series built from the shared star-schema tables.

Raw rows are reduced to bars by one aggregation with map-side combine, so what
is shuffled is at most one row per task, symbol and day, whatever the share of
the hottest symbol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.scalars import constant_key

# First and last price need a (trade number, price) pair as ordering key. Packed into a
# 38-digit decimal, the key keeps the aggregation a hash aggregation; a struct, which is
# exact for every price, makes Spark sort before the partial aggregation.
_TRADE_STEP = "10000000000000000000BD"
CENTS = 100

FIRST_EVENT_PRICE = 100.0


# Schemas of the shared tables the toolkit reads, so that no job
# runs to infer them.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _packed(trade: Column, price: Column, steps: int) -> Column:
    return trade.cast("decimal(19,0)") * F.expr(_TRADE_STEP) + F.rint(price * steps).cast(
        "bigint"
    ).cast("decimal(19,0)")


def _unpacked(key: Column, steps: int) -> Column:
    return (key % F.expr(_TRADE_STEP)).cast("double") / steps


def _checked(value: Column, bad: Column, message: str, kind: str) -> Column:
    """``value``, or an error at run time where ``bad`` counts rows."""
    return F.when(bad > 0, F.raise_error(F.lit(message)).cast(kind)).otherwise(value)


def to_bars(
    trades: DataFrame,
    trade: Column,
    price: Column,
    volume: Column,
    *keys: Column,
    price_steps: int | None = None,
) -> DataFrame:
    """Open, High, Low, Close and Volume per key from single trades.

    Open and Close are the prices of the lowest and highest (trade, price)
    pair, so equal trade numbers cannot make the result depend on row order.
    Any price is kept exactly. ``price_steps`` is a promise that prices are
    multiples of 1 / ``price_steps`` and trades and prices not negative; it buys
    a cheaper aggregation, and a price that breaks it raises. Volume is a whole
    number: a total that is not one raises.
    """
    key = (
        _packed(trade, price, price_steps)
        if price_steps
        else F.struct(trade.alias("trade"), price.alias("price"))
    )
    rows = trades.select(
        *keys,
        F.when(price.isNotNull(), key).alias("_key"),
        price.alias("_price"),
        trade.alias("_trade"),
        volume.alias("_volume"),
    )
    names = [c for c in rows.columns if not c.startswith("_")]
    broken = F.lit(0)
    if price_steps:
        at = F.col("_price")
        exact = F.rint(at * price_steps) / price_steps == at
        broken = F.count_if(~exact | (at < 0) | (F.col("_trade") < 0))
    bars = rows.groupBy(*names).agg(
        F.min("_key").alias("_first"),
        F.max("_key").alias("_last"),
        F.max("_price").alias("High"),
        F.min("_price").alias("Low"),
        F.sum("_volume").alias("_total"),
        broken.alias("_broken"),
    )

    def price_of(c: str) -> Column:
        if not price_steps:
            return F.col(c)["price"]
        message = f"A price is negative or no multiple of 1/{price_steps}"
        return _checked(_unpacked(F.col(c), price_steps), F.col("_broken"), message, "double")

    fraction = (F.col("_total") != F.floor("_total")).cast("int")
    whole = F.col("_total").cast("bigint")
    close = price_of("_last")
    return bars.select(
        *names,
        price_of("_first").alias("Open"),
        "High",
        "Low",
        close.alias("Close"),
        close.alias("Adj Close"),
        _checked(whole, F.coalesce(fraction, F.lit(0)), "A total volume is not a whole number", "bigint").alias(
            "Volume"
        ),
    )


def line_bars(spark: SparkSession, sf_dir: str, symbol: str = "l_returnflag") -> DataFrame:
    """Daily bars of order lines; ``symbol`` names the column that keys a series."""
    return to_bars(
        table(spark, sf_dir, "lineitem"),
        F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        F.col("l_extendedprice"),
        F.col("l_quantity"),
        F.col(symbol).cast("string").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("Date"),
        price_steps=CENTS,
    )


def single_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars over all order lines as one series."""
    return to_bars(
        table(spark, sf_dir, "lineitem"),
        F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        F.col("l_extendedprice"),
        F.col("l_quantity"),
        constant_key("ALL", F.col("l_returnflag")).alias("symbol"),
        F.col("l_shipdate").cast("date").alias("Date"),
        price_steps=CENTS,
    )


def hour_of(ts: str) -> Column:
    """Hour of a zone-less timestamp, independent of the session time zone."""
    return F.expr(f"timestampadd(HOUR, hour({ts}), CAST(CAST({ts} AS DATE) AS TIMESTAMP_NTZ))")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of purchase events as one series; prices start at 100."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return to_bars(
        events,
        F.col("event_id"),
        F.col("value") + FIRST_EVENT_PRICE,
        F.lit(1),
        constant_key("ALL", F.col("event_type")).alias("symbol"),
        hour_of("ts").alias("Date"),
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one tick: a few symbols, unbounded rows per symbol."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts").alias("Date"),
        "event_id",
        (F.col("value") + FIRST_EVENT_PRICE).alias("Close"),
    )


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored news items (all events but purchases) keyed by hour."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") != "purchase")
        .select(
            constant_key("ALL", F.col("event_type")).alias("symbol"),
            hour_of("ts").alias("Date"),
            ((F.col("value") - 50) / 50).alias("sentiment_score"),
        )
    )


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single order lines in the shape of raw market rows, dates repeated."""
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").cast("date").alias("Date"),
        price.alias("Open"),
        (price * (1 + F.col("l_tax") - F.col("l_discount"))).alias("High"),
        (price * (1 - F.col("l_discount"))).alias("Low"),
        (price * (1 - F.col("l_discount") / 2)).alias("Close"),
        price.alias("Adj Close"),
        F.col("l_quantity").cast("bigint").alias("Volume"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models' scores for the labelled documents, in long form."""
    joined = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id"
    )
    p_a = F.round(F.col("n_chars") / (F.col("n_chars") + 2000), 2)
    p_b = F.round(1 / (1 + F.col("doc_id") % 7), 2)
    models = F.array(
        F.struct(F.lit("champion").alias("model"), p_a.alias("probability_up")),
        F.struct(F.lit("challenger").alias("model"), p_b.alias("probability_up")),
    )
    return joined.select(
        "doc_id", F.col("quality").alias("actual_target"), F.inline(models)
    ).select(
        "model",
        "doc_id",
        "actual_target",
        (F.col("probability_up") > 0.5).cast("int").alias("predicted_target"),
        "probability_up",
    )
