"""Global ranks, running totals and exact quantiles without one big sort group.

1. A range exchange deals the rows by (keys, order) into stretches of about equal
   size, whatever key or value is hot; their number is that of the session's
   shuffle partitions. The stretches are written to the shared folder once, so
   that every later step sees the same ones.
2. The totals of the stretches (one row a key and stretch) are accumulated.
3. A window inside each stretch finishes the job.

Results do not depend on where the stretches are cut. Missing keys are a group of
their own; no row is lost.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.scalars import col
from barlake.functions.scratch import written

_STRETCH = "_stretch"


def dealt(df: DataFrame, by: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """``df`` with the number of the range of ``by`` that each row lies in, not yet written.

    Ranges may be cut elsewhere when it is computed again; for one reader only.
    """
    ordered = [col(c) for c in by]
    ranged = df.repartitionByRange(parts, *ordered) if parts else df.repartitionByRange(*ordered)
    return ranged.withColumn(_STRETCH, F.spark_partition_id())


def stretches(df: DataFrame, by: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """``df`` with the number of the range of ``by`` that each row lies in."""
    return written(dealt(df, by, parts), "stretches")


def join_nullsafe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns that may be missing; the columns of ``left``, then the rest of ``right``."""
    rest = [c for c in right.columns if c not in on]
    renamed = right.select(*[col(c).alias(f"_right_{c}") for c in on], *[col(c) for c in rest])
    same = reduce(Column.__and__, [left[f"`{c}`"].eqNullSafe(renamed[f"`_right_{c}`"]) for c in on])
    return left.join(renamed, same).select(*[left[f"`{c}`"] for c in left.columns], *[renamed[f"`{c}`"] for c in rest])


def index_rows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: str,
    name: str,
    parts: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in (time, tie) order, per key.

    Rows without time come first. Rows equal in (keys, time, tie) take adjacent
    positions in any order.
    """
    keys = list(keys)
    rows = stretches(df, [*keys, time, tie], parts)
    where = [*keys, _STRETCH]
    before = Window.partitionBy(*keys).orderBy(_STRETCH).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*where)
        .agg(F.count("*").alias("_n"))
        .select(*where, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*where).orderBy(time, tie)
    local = rows.withColumn("_local", F.row_number().over(inside))
    return join_nullsafe(local, offsets, where).select(
        *[col(c) for c in df.columns], (F.col("_offset") + F.col("_local") - 1).alias(name)
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    counts: dict[str, Column],
    parts: int | None = None,
) -> DataFrame:
    """One row per key and distinct value with running totals of ``counts``.

    ``counts`` maps names to row-level numbers, not negative, that are summed.
    Each name ``c`` yields ``c`` (at this value), ``c_before`` (strictly smaller
    values), ``c_total`` and ``c_lower`` (at the next smaller value); ``next_value`` is the
    next larger value. Both are NULL where there is none.
    Missing values and values that count for nothing are left out. Repeated values
    collapse before the shuffle, so a hot value costs one row.
    """
    keys = list(keys)
    names = list(counts)
    counted = reduce(Column.__add__, [F.col(n) for n in names])
    distinct = (
        df.where(col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[F.sum(x).alias(n) for n, x in counts.items()])
        .where(counted > 0)
    )
    rows = stretches(distinct, [*keys, value], parts)
    where = [*keys, _STRETCH]
    by_key = Window.partitionBy(*keys)
    in_order = by_key.orderBy(_STRETCH)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*where)
        .agg(
            F.min(col(value)).alias("_first"),
            *[F.sum(n).alias(f"_{n}") for n in names],
            *[F.max_by(n, col(value)).alias(f"_{n}_last") for n in names],
        )
        .select(
            *where,
            F.lead("_first").over(in_order).alias("_next_first"),
            *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_offset") for n in names],
            *[F.sum(f"_{n}").over(by_key).alias(f"{n}_total") for n in names],
            *[F.lag(f"_{n}_last").over(in_order).alias(f"_{n}_last") for n in names],
        )
    )
    inside = Window.partitionBy(*where).orderBy(value)
    inside_before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select(
        "*",
        F.lead(col(value)).over(inside).alias("_next"),
        *[F.coalesce(F.sum(n).over(inside_before), F.lit(0)).alias(f"_{n}_local") for n in names],
        *[F.lag(n).over(inside).alias(f"_{n}_lower") for n in names],
    )
    return join_nullsafe(local, offsets, where).select(
        *keys,
        col(value),
        F.coalesce("_next", "_next_first").alias("next_value"),
        *names,
        *[(F.col(f"_{n}_offset") + F.col(f"_{n}_local")).alias(f"{n}_before") for n in names],
        *[f"{n}_total" for n in names],
        *[F.coalesce(f"_{n}_lower", f"_{n}_last").alias(f"{n}_lower") for n in names],
    )


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]
) -> DataFrame:
    """Exact linearly interpolated quantiles, one row per key.

    ``shares`` maps output names to shares in [0, 1]. Unlike the built-in exact
    percentile no task ever holds all the distinct values of a key.
    """
    keys = list(keys)
    totals = running_totals(df, keys, value, {"n": F.lit(1)})
    at = col(value)
    picks: list[Column] = []
    for name, share in shares.items():
        place = F.lit(float(share)) * (F.col("n_total") - 1)
        for edge, position in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            hit = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(hit, at)).alias(f"_{name}_{edge}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_{name}_weight"))
    ends = totals.groupBy(*keys).agg(*picks)
    return ends.select(
        *keys,
        *[
            (
                F.col(f"_{n}_lo")
                + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_weight")
            ).alias(n)
            for n in shares
        ],
    )
