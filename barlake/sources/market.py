"""Landing market data: CSV files and wide vendor extracts to the bar schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.scalars import col, constant_key
from barlake.schemas import MARKET_SCHEMA, PRICE_COLUMNS, REQUIRED_COLUMNS, DataContractError

LEVEL_SEPARATOR = "|"
_FIELDS = [c for c in REQUIRED_COLUMNS if c != "Date"]


def read_market_csv(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """Daily bars of one symbol from CSV with a header and the seven columns.

    The schema is explicit, so nothing is inferred; a malformed cell fails the
    job. A missing path is an AnalysisException when the frame is defined.
    """
    bars = (
        spark.read.schema(MARKET_SCHEMA)
        .options(header=True, mode="FAILFAST", enforceSchema=False)
        .csv(path)
    )
    key = constant_key(symbol, F.col("Date").cast("string"))
    return bars.select(key.alias("symbol"), *[col(c) for c in REQUIRED_COLUMNS])


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, for files that must be validated before the cast."""
    return spark.read.options(header=True, inferSchema=False).csv(path)


def require_columns(df: DataFrame, required: Sequence[str], what: str) -> None:
    """Raise, before any job runs, if ``df`` lacks one of the columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise DataContractError(f"{what} is missing required columns: {missing}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return (
        df.groupBy(*[col(k) for k in keys])
        .agg(F.count("*").alias("rows"))
        .where(F.col("rows") > 1)
    )


def first_duplicates(df: DataFrame, keys: Sequence[str], count: int = 5) -> DataFrame:
    """The first repeated keys in key order: what an error message quotes."""
    return duplicate_keys(df, keys).orderBy(*keys).limit(count)


def reject_duplicates(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Raise with the first five repeated dates if a key occurs twice."""
    examples = first_duplicates(df, keys).select("Date").collect()
    if examples:
        dates = [str(row["Date"]) for row in examples]
        raise DataContractError(f"{what} contains duplicate dates: {dates}")


def _levels(columns: Sequence[str]) -> dict[str, dict[str, str]]:
    """Ticker -> price name -> column name, for either nesting order."""
    tickers: dict[str, dict[str, str]] = {}
    for name in columns:
        first, _, second = name.partition(LEVEL_SEPARATOR)
        if first in _FIELDS:
            tickers.setdefault(second, {})[first] = name
        elif second in _FIELDS:
            tickers.setdefault(first, {})[second] = name
    return tickers


def normalize_vendor_extract(
    df: DataFrame, ticker: str | None = None, check: bool = True
) -> DataFrame:
    """Bars in long form from a wide extract.

    Price columns are named ``price|ticker`` or ``ticker|price``, or just
    ``price`` for a flat extract of one ticker. ``ticker`` selects one of
    several; if it is absent and the extract holds a single one, that one is
    taken under the requested name. One ``inline`` turns columns into rows, so
    nothing is shuffled. ``check`` runs the emptiness and duplicate-date jobs.
    """
    if "Datetime" in df.columns and "Date" not in df.columns:
        df = df.withColumnRenamed("Datetime", "Date")
    if "Date" not in df.columns:
        raise DataContractError("The vendor extract does not contain a Date column")

    tickers = _levels([c for c in df.columns if c != "Date"])
    if ticker is not None:
        if ticker in tickers:
            tickers = {ticker: tickers[ticker]}
        elif len(tickers) == 1:
            tickers = {ticker: next(iter(tickers.values()))}
        else:
            raise DataContractError(f"Ticker {ticker!r} is not one of {sorted(tickers)}")
    if not tickers:
        raise DataContractError(f"The vendor extract is missing required columns: {_FIELDS}")
    for name, found in tickers.items():
        missing = [c for c in _FIELDS if c not in found]
        if missing:
            raise DataContractError(
                f"The vendor extract is missing required columns for {name!r}: {missing}"
            )
    if "" in tickers:
        raise DataContractError("A flat extract needs a ticker")
    if check and df.isEmpty():
        raise DataContractError(f"The vendor extract has no rows for ticker {ticker!r}")

    groups = [
        F.struct(
            F.lit(name).alias("symbol"),
            *[col(found[c]).cast("double").alias(c) for c in PRICE_COLUMNS],
            col(found["Volume"]).cast("bigint").alias("Volume"),
        )
        for name, found in sorted(tickers.items())
    ]
    bars = df.select(_zone_less_date(df).alias("Date"), F.inline(F.array(*groups)))
    if len(groups) > 1:
        # A date on which one ticker did not trade is no row of that ticker; with a single
        # ticker an empty row is a fault that the contract must see.
        bars = bars.where(F.coalesce(*[col(c) for c in (*PRICE_COLUMNS, "Volume")]).isNotNull())
    bars = bars.select("symbol", *[col(c) for c in REQUIRED_COLUMNS])
    if check:
        reject_duplicates(bars, ["symbol", "Date"], "The vendor extract")
    return bars


def _zone_less_date(df: DataFrame):
    """Dates stay dates; a zoned timestamp loses its zone; text must parse."""
    kind = df.schema["Date"].dataType
    if isinstance(kind, T.TimestampType):
        return F.col("Date").cast("timestamp_ntz")
    if isinstance(kind, T.StringType):
        return F.col("Date").cast("date")
    return F.col("Date")
