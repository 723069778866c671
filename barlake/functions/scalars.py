"""Column helpers with the missing-value rules of the toolkit.

Missing is always NULL: division by zero, a logarithm of a non-positive number
and non-finite input cells all become NULL and never raise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(name: str | Column) -> Column:
    """A column by exact name; names with blanks or dots need no quoting."""
    return name if isinstance(name, Column) else F.col(f"`{name}`")


def constant_key(value: str, text: Column) -> Column:
    """``value`` as a key that stays a column of the plan.

    Spark folds a literal key away, which turns a join on it into a cross join.
    ``text`` is any text column of the rows; none of it ends up in the key.
    """
    return F.concat(F.lit(value), F.left(F.coalesce(text, F.lit("")), F.lit(0)))


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def gain(x: Column) -> Column:
    """Positive part of x; NULL stays NULL (``greatest`` would skip it)."""
    return F.when(x > 0, x).when(x.isNotNull(), F.lit(0.0))


def loss(x: Column) -> Column:
    """Size of the negative part of x; NULL stays NULL."""
    return F.when(x < 0, -x).when(x.isNotNull(), F.lit(0.0))


def finite_or_null(x: Column) -> Column:
    """NaN and both infinities become NULL."""
    return F.when(F.abs(x) < F.lit(INF), x)


def infinite_to_zero(x: Column) -> Column:
    """Only the infinities become 0.0; NULL and NaN are left as they are."""
    return F.when(F.abs(x) == F.lit(INF), F.lit(0.0)).otherwise(x)


def rounded(df, *skip: str, digits: int = 6):
    """Round every DOUBLE column, for comparison of results across engines."""
    return df.select(
        *[
            F.round(col(f.name), digits).alias(f.name)
            if f.dataType.typeName() == "double" and f.name not in skip
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def nan_to_null(df):
    """Every NaN cell becomes NULL; infinities stay."""
    return df.withColumns(
        {
            f.name: F.nanvl(col(f.name), F.lit(None))
            for f in df.schema.fields
            if f.dataType.typeName() in ("double", "float")
        }
    )
