"""Ordered work over keyed series.

A *calendar* series has at most one row per key and calendar step, so a group
can never hold more rows than the calendar has steps (36,525 days a century)
and one window per key is safe however large the raw data is. A *long* series
(ticks, one row per trade) has no such bound: its rows are numbered with the
two-level ranks of :mod:`barlake.functions.ranks`, cut into blocks of
``block_rows`` rows, and every block gets a copy of the few neighbouring rows
its frames reach. Each block is then one window group, so one hot key spreads
over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barlake.functions.ranks import index_rows
from barlake.functions.scalars import col

BLOCK = "_block"
POSITION = "_position"
INDEX = "_index"


@dataclass(frozen=True)
class Series:
    """How the rows of a table form series.

    ``tie`` makes the order total when several rows share ``time``. ``block_rows``
    turns on blocks. With ``present``, blocks and their reach count only rows where
    that column has a value; rows without one stay with the row before (calendar
    series only: with ``tie`` every row counts).
    """

    keys: tuple[str, ...] = ("symbol",)
    time: str = "Date"
    tie: str | None = None
    block_rows: int | None = None
    present: str | None = None

    @property
    def order(self) -> list[str]:
        return [self.time] + ([self.tie] if self.tie else [])

    def window(self) -> WindowSpec:
        """One window group per key: only for calendar series."""
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def blocked(self, block_rows: int, present: str | None = None) -> "Series":
        return replace(self, block_rows=block_rows, present=present)

    def with_positions(self, df: DataFrame) -> DataFrame:
        """Add the 0-based row number of every row within its series."""
        if self.block_rows is None or self.tie is None:
            return df.withColumn(POSITION, (F.row_number().over(self.window()) - 1).cast("long"))
        return index_rows(df, self.keys, self.time, self.tie, POSITION)

    def apply(
        self,
        df: DataFrame,
        build: Callable[[DataFrame, WindowSpec], DataFrame],
        back: int,
        forward: int = 0,
    ) -> DataFrame:
        """Run ``build(df, w)`` where ``w`` orders the rows of one series.

        ``back`` and ``forward`` are the number of rows the frames used by
        ``build`` reach before and after the current row, nesting included.
        """
        if self.block_rows is None:
            return build(df, self.window())
        size, index = self.block_rows, F.col(INDEX)
        first = F.greatest(index - forward, F.lit(0))
        copies = self._indexed(df).withColumn(
            BLOCK,
            F.explode(F.sequence(F.floor(first / size), F.floor((index + back) / size))),
        )
        w = Window.partitionBy(*self.keys, BLOCK).orderBy(POSITION)
        built = build(copies, w)
        return built.where(F.floor(index / size) == F.col(BLOCK)).drop(BLOCK, POSITION, INDEX)

    def _indexed(self, df: DataFrame) -> DataFrame:
        """Add the position of every row and the number its block goes by."""
        placed = self.with_positions(df)
        if self.present is None or self.tie is not None:
            return placed.withColumn(INDEX, F.col(POSITION))
        running = self.window().rowsBetween(Window.unboundedPreceding, 0)
        seen = F.count(col(self.present)).over(running)
        return placed.withColumn(INDEX, F.greatest(seen - 1, F.lit(0)))


DAILY = Series()


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(1 - n, 0)


def roll(x: Column, n: int, fn: Callable[[Column], Column], w: WindowSpec) -> Column:
    """Rolling ``fn`` over n rows; NULL unless all n values are present."""
    frame = trailing(w, n)
    return F.when(F.count(x).over(frame) == n, fn(x).over(frame))


def roll_partial(x: Column, n: int, fn: Callable[[Column], Column], w: WindowSpec) -> Column:
    """Rolling ``fn`` over up to n rows."""
    return fn(x).over(trailing(w, n))


def lag(x: Column, n: int, w: WindowSpec) -> Column:
    return F.lag(x, n).over(w)


def lead(x: Column, n: int, w: WindowSpec) -> Column:
    return F.lead(x, n).over(w)


def warm_up(df: DataFrame, start: str, rows: int, series: Series = DAILY) -> DataFrame:
    """Rows from ``start`` on plus the ``rows`` rows before it, per series.

    Filter with this before computing features over a date range and with the
    plain range afterwards: the early rows feed the frames of the later ones.
    Only the rows before ``start`` are ranked, with a group limit per key.
    """
    early = df.where(col(series.time) < F.lit(start))
    newest_first = Window.partitionBy(*series.keys).orderBy(
        *[col(c).desc() for c in series.order]
    )
    tail = (
        early.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= rows)
        .drop("_rank")
    )
    return df.where(col(series.time) >= F.lit(start)).unionByName(tail)
