"""Pearson correlations: one aggregation, pairwise-complete rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.scalars import col
from barlake.functions.series import DAILY, Series, lag, lead

MAX_LAG = 20


def pearson(x: str, y: str) -> str:
    """SQL aggregate: correlation over rows with both, NULL without variance.

    The built-in ``corr`` raises for a constant column in ANSI mode.
    """
    return (
        f"try_divide(covar_pop(`{x}`, `{y}`),"
        f" sqrt(var_pop(`{x}`) FILTER (WHERE `{y}` IS NOT NULL)"
        f" * var_pop(`{y}`) FILTER (WHERE `{x}` IS NOT NULL)))"
    )


def _to_rows(wide: DataFrame, keep: Sequence[str], cells: list[tuple[str, str]]) -> DataFrame:
    """Aggregate columns to rows; a cell is (SQL of its labels, column)."""
    rows = ", ".join(f"struct({labels}, `{name}` AS correlation)" for labels, name in cells)
    return wide.select(*keep, F.expr(f"inline(array({rows}))"))


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], complete: bool = False
) -> DataFrame:
    """Every ordered pair of ``columns`` with its correlation.

    All pairs are aggregates of one pass; nothing is multiplied or shuffled
    but one partial row per task. ``complete`` tells that no value is missing: then
    one variance a column and one covariance a pair are enough.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    if complete:
        wide = _complete_correlations(df, columns, pairs)
    else:
        wide = df.agg(*[F.expr(pearson(a, b)).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for first, second in {(a, b), (b, a)}:
            cells.append((f"'{first}' AS feature_a, '{second}' AS feature_b", f"_{i}"))
    return _to_rows(wide, [], cells)


def _complete_correlations(
    df: DataFrame, columns: Sequence[str], pairs: list[tuple[str, str]]
) -> DataFrame:
    spread = {c: f"_var_{i}" for i, c in enumerate(columns)}
    moments = [F.var_pop(col(c)).alias(name) for c, name in spread.items()]
    moments += [
        F.covar_pop(col(a), col(b)).alias(f"_cov_{i}") for i, (a, b) in enumerate(pairs) if a != b
    ]
    both = df.agg(*moments)

    def share(i: int, a: str, b: str) -> Column:
        top = F.col(f"_cov_{i}") if a != b else F.col(spread[a])
        return F.try_divide(top, F.sqrt(F.col(spread[a]) * F.col(spread[b])))

    return both.select(*[share(i, a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])


def pairwise_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every ordered pair of ``columns`` with its correlation over the rows that have both.

    For many columns with missing cells. A row becomes one small row a pair that it has both
    values of, which is combined at once: each task sends one row a pair, and the generated
    code does not grow with the pairs. Pairs no row has both values of have no correlation.
    """
    n = len(columns)
    cells = df.select(F.array(*[col(c).cast("double") for c in columns]).alias("_v"))
    held = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get("_v", i).isNotNull())
    pairs = F.flatten(
        F.transform(
            "_held",
            lambda i: F.transform(
                F.filter("_held", lambda j: j >= i),
                lambda j: F.struct(i.alias("_i"), j.alias("_j"), F.get("_v", i).alias("_x"), F.get("_v", j).alias("_y")),
            ),
        )
    )
    moments = (
        cells.withColumn("_held", held)
        .select(F.inline(pairs))
        .groupBy("_i", "_j")
        .agg(F.covar_pop("_x", "_y").alias("_c"), F.var_pop("_x").alias("_vx"), F.var_pop("_y").alias("_vy"))
        .select("_i", "_j", F.expr("try_divide(_c, sqrt(_vx * _vy))").alias("correlation"))
    )
    names = F.array(*[F.lit(c) for c in columns])
    every = df.sparkSession.range(n * n).select((F.col("id") % n).cast("int").alias("_a"), F.floor(F.col("id") / n).cast("int").alias("_b"))
    keyed = every.withColumns({"_i": F.least("_a", "_b"), "_j": F.greatest("_a", "_b")})
    return keyed.join(moments, ["_i", "_j"], "left").select(
        F.get(names, F.col("_a")).alias("feature_a"), F.get(names, F.col("_b")).alias("feature_b"), "correlation"
    )


def target_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of every column but the target itself with the target."""
    others = [c for c in columns if c != target]
    wide = df.agg(*[F.expr(pearson(c, target)).alias(f"_{i}") for i, c in enumerate(others)])
    return _to_rows(wide, [], [(f"'{c}' AS feature", f"_{i}") for i, c in enumerate(others)])


def cross_correlation(
    df: DataFrame, x: str, y: str, max_lag: int = MAX_LAG, series: Series = DAILY
) -> DataFrame:
    """Correlation of ``x`` shifted by -max_lag..max_lag rows with ``y``.

    The shifts share one window, the correlations one aggregation.
    """
    shifts = range(-max_lag, max_lag + 1)

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return rows.withColumns(
            {
                f"_{i}": lag(col(x), k, w) if k >= 0 else lead(col(x), -k, w)
                for i, k in enumerate(shifts)
            }
        )

    rows = df.dropna(subset=[x, y]).select(*series.keys, *series.order, x, y)
    shifted = series.apply(rows, build, back=max_lag, forward=max_lag)
    wide = shifted.groupBy(*series.keys).agg(
        *[F.expr(pearson(f"_{i}", y)).alias(f"_{i}") for i, _ in enumerate(shifts)]
    )
    return _to_rows(wide, series.keys, [(f"{k} AS lag", f"_{i}") for i, k in enumerate(shifts)])
