"""Chronological splits: whole rows get a label, keys stay in the table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.ranks import join_nullsafe
from barlake.functions.scalars import col
from barlake.functions.series import DAILY, POSITION, Series
from barlake.schemas import DataContractError

# Split shares.
TRAIN, VALIDATION, TEST = 0.70, 0.15, 0.15
REFERENCE = 0.70

_ROWS = "_rows"


def _sized(df: DataFrame, series: Series) -> DataFrame:
    """Add the row position and the row count of each series."""
    placed = series.with_positions(df)
    if series.block_rows is None:
        return placed.withColumn(_ROWS, F.count("*").over(Window.partitionBy(*series.keys)))
    counts = df.groupBy(*series.keys).agg(F.count("*").alias(_ROWS))
    return join_nullsafe(placed, counts, series.keys)


def _share(fraction: float) -> Column:
    return F.floor(F.col(_ROWS).cast("double") * F.lit(float(fraction)))


def check_fractions(train: float, validation: float, test: float) -> None:
    """Raise unless the three shares are proper fractions of one whole."""
    shares = {"train": train, "validation": validation, "test": test}
    for part, share in shares.items():
        if not 0.0 < share < 1.0:
            raise DataContractError(f"The {part} share is {share}; it must lie strictly between 0 and 1")
    whole = math.fsum(shares.values())
    if abs(whole - 1.0) > 1e-9:
        raise DataContractError(f"The shares of train, validation and test sum to {whole}, not to 1")


def chrono_split(
    df: DataFrame,
    train: float = TRAIN,
    validation: float = VALIDATION,
    test: float = TEST,
    series: Series = DAILY,
) -> DataFrame:
    """Add ``split``: the oldest share trains, the next validates, the rest tests."""
    check_fractions(train, validation, test)
    train_end = _share(train)
    validation_end = train_end + _share(validation)
    label = (
        F.when(F.col(POSITION) < train_end, "train")
        .when(F.col(POSITION) < validation_end, "validation")
        .otherwise("test")
    )
    return _sized(df, series).withColumn("split", label).drop(POSITION, _ROWS)


def drift_split(df: DataFrame, reference: float = REFERENCE, series: Series = DAILY) -> DataFrame:
    """Add ``period``: the oldest share is the reference, the rest is current."""
    if not 0 < reference < 1:
        raise DataContractError(f"The reference share is {reference}; it must lie strictly between 0 and 1")
    label = F.when(F.col(POSITION) < _share(reference), "reference").otherwise("current")
    return _sized(df, series).withColumn("period", label).drop(POSITION, _ROWS)


def split_summary(split: DataFrame, by: str = "split", time: str = "Date") -> DataFrame:
    return split.groupBy("symbol", by).agg(
        F.count("*").alias("rows"),
        F.min(col(time)).alias("first_date"),
        F.max(col(time)).alias("last_date"),
    )


SPLIT_PARTS = ("train", "validation", "test")
PERIODS = ("reference", "current")


def require_parts(
    split: DataFrame, by: str = "split", parts: tuple[str, ...] = SPLIT_PARTS, keys: tuple[str, ...] = ("symbol",)
) -> DataFrame:
    """``split`` itself; raises if a series, or the whole table, lacks rows in one of ``parts``.

    Splits are lazy, so this check is a step of its own: call it before anything is
    learnt or compared.
    """
    counted = split.groupBy(*keys).agg(
        *[F.count_if(F.col(by) == p).alias(f"n{i}") for i, p in enumerate(parts)]
    )
    empty = " OR ".join(f"n{i} = 0" for i in range(len(parts)))
    if split.isEmpty() or not counted.where(empty).isEmpty():
        raise DataContractError(f"Every series needs rows in each of: {', '.join(parts)}")
    return split
