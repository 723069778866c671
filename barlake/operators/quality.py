"""Fail-fast validation and cleaning of raw market rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.scalars import col, finite_or_null
from barlake.schemas import PRICE_COLUMNS, REQUIRED_COLUMNS, DataContractError
from barlake.sources.market import duplicate_keys, require_columns

NUMERIC_COLUMNS = [*PRICE_COLUMNS, "Volume"]


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _date(df: DataFrame) -> Column:
    return F.col("Date").try_cast("date") if _is_text(df, "Date") else F.col("Date")


def _missing(df: DataFrame, name: str) -> Column:
    x = col(name)
    kind = df.schema[name].dataType
    return x.isNull() | F.isnan(x) if isinstance(kind, (T.DoubleType, T.FloatType)) else x.isNull()


def _number(df: DataFrame, name: str) -> Column:
    return col(name).try_cast("double") if _is_text(df, name) else col(name)


def coerce(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Cast ``columns`` (name -> type); cells that cannot be parsed become NULL."""
    return df.withColumns({name: col(name).try_cast(kind) for name, kind in columns.items()})


def raw_quality(df: DataFrame, keys: Sequence[str] = ("symbol", "Date")) -> DataFrame:
    """Violations per check, in the order in which they are enforced.

    One aggregation over the rows plus one over the keys, whatever the number
    of checks.
    """
    require_columns(df, REQUIRED_COLUMNS, "The dataset")
    checks: list[tuple[str, str, Column]] = [
        (
            "date_unparsable",
            "Date",
            F.count_if(_date(df).isNull() & F.col("Date").isNotNull()),
        )
    ]
    checks += [("missing_value", c, F.count_if(_missing(df, c))) for c in REQUIRED_COLUMNS]
    duplicates = duplicate_keys(
        df.select(*[k for k in keys if k != "Date"], _date(df).alias("Date")), keys
    )
    extra = duplicates.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)))
    later = [("non_positive_price", c, F.count_if(_number(df, c) <= 0)) for c in PRICE_COLUMNS]
    later += [("negative_volume", "Volume", F.count_if(_number(df, "Volume") < 0))]

    counted = df.agg(
        F.count("*").alias("_rows"),
        *[x.alias(f"_before_{i}") for i, (_, _, x) in enumerate(checks)],
        *[x.alias(f"_after_{i}") for i, (_, _, x) in enumerate(later)],
    ).withColumn("_duplicates", extra.scalar())
    entries = [("empty", "", (F.col("_rows") == 0).cast("bigint"))]
    entries += [(n, c, F.col(f"_before_{i}")) for i, (n, c, _) in enumerate(checks)]
    entries += [("duplicate_date", "Date", F.col("_duplicates"))]
    entries += [(n, c, F.col(f"_after_{i}")) for i, (n, c, _) in enumerate(later)]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("check_name"),
                F.lit(column).alias("column_name"),
                found.cast("bigint").alias("violations"),
            )
            for i, (name, column, found) in enumerate(entries)
        ]
    )
    return counted.select(F.inline(rows))


# Message per check, in order.
_MESSAGES = {
    "empty": "Dataset is empty",
    "date_unparsable": "Date column cannot be parsed as datetime",
    "missing_value": "Missing values found in required columns: {columns}",
    "duplicate_date": "Duplicate dates found",
    "non_positive_price": "Price columns must contain positive values: {columns}",
    "negative_volume": "Volume must contain non-negative values",
}


def validate_raw_market_data(
    df: DataFrame, keys: Sequence[str] = ("symbol", "Date")
) -> DataFrame:
    """The rows with ``Date`` parsed; raises on the first check that fails."""
    failed: dict[str, list[str]] = {}
    for row in raw_quality(df, keys).where(F.col("violations") > 0).orderBy("position").collect():
        failed.setdefault(row["check_name"], []).append(row["column_name"])
    for name, message in _MESSAGES.items():
        if name in failed:
            raise DataContractError(message.format(columns=failed[name]))
    return df.withColumn("Date", _date(df))


def clean_bars(df: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Only the required columns, strictly cast; NaN becomes NULL.

    A text cell that is not a date or a number fails the job.
    """
    require_columns(df, REQUIRED_COLUMNS, "The dataset")
    date = F.col("Date").cast("date") if _is_text(df, "Date") else F.col("Date")
    return df.select(
        *keys,
        date.alias("Date"),
        *[finite_or_null(col(c).cast("double")).alias(c) for c in PRICE_COLUMNS],
        col("Volume").cast("bigint").alias("Volume"),
    )


def load_clean(df: DataFrame) -> DataFrame:
    """Validate, clean, validate: the eager form used at the start of a run.

    Text is judged before it is cast, so that a bad date is reported as one and
    not as a failed cast; the second pass sees what casting made missing.
    """
    if any(_is_text(df, c) for c in REQUIRED_COLUMNS if c in df.columns):
        df = validate_raw_market_data(df)
    return validate_raw_market_data(clean_bars(df))

