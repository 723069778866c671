"""Exponential moving averages as a scan of affine maps.

The non-adjusted average starts at the first value present. A later value x, g rows
after the last one present, gives ``y = c*y + (1-c)*x`` with ``c = q^g / (q^g + a)``,
``a = 2/(span+1)`` and ``q = 1-a``; without gaps c is q. Rows without a value hold the
average. Each row is an affine map of the averages before it, and maps compose: rows are
packed into blocks, a fold over a block composes its maps, the maps of whole blocks give
every block the averages it starts from, and a row applies its own map to those. All
factors lie between 0 and 1, so no gap and no length of the series overflows, and no
value is left out.

The MACD line and its signal are part of the same maps: the signal ``s = q*s + a*(fast -
slow)`` moves on in every row, also where the averages hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.ranks import index_rows, join_nullsafe
from barlake.functions.scalars import col
from barlake.functions.series import DAILY, POSITION, Series

BLOCK_ROWS = 128
FAST, SLOW, SIGNAL = 12, 26, 9
_BLOCK = "_ema_block"


def alpha(span: int) -> float:
    return 2.0 / (span + 1)


class Maps:
    """Affine maps of the averages of some spans, and of the MACD signal if ``macd``.

    A map is a struct: factor ``m`` and addend ``b`` of each span; for the signal its own
    factor ``ms``, addend ``bs``, and the shares ``pf`` and ``ps`` of the fast and the slow
    average before it. The methods give SQL text: a map is a long expression, and text
    reaches the session in one call.
    """

    def __init__(self, spans: Sequence[int], macd: bool):
        self.spans = sorted({*spans, *((FAST, SLOW) if macd else ())})
        self.macd = macd
        self.fields = [f"{x}{n}" for n in self.spans for x in "mb"] + (["ms", "pf", "ps", "bs"] if macd else [])

    def struct(self, values: dict[str, str]) -> str:
        return f"named_struct({', '.join(f"'{f}', {values[f]}" for f in self.fields)})"

    def identity(self) -> str:
        return self.struct({f: "1D" if f[0] == "m" else "0D" for f in self.fields})

    def of_row(self, x: str, gap: str) -> str:
        """The map of a row: x its value, ``gap`` the rows since the last one present (NULL: none)."""
        out: dict[str, str] = {}
        for n in self.spans:
            a = alpha(n)
            old = f"pow({1.0 - a!r}D, {gap})"
            kept = f"coalesce({old} / ({old} + {a!r}D), 0D)"
            out[f"m{n}"] = f"if({x} IS NULL, 1D, {kept})"
            out[f"b{n}"] = f"if({x} IS NULL, 0D, (1D - {kept}) * {x})"
        if self.macd:
            a = f"if({gap} IS NULL, 1D, {alpha(SIGNAL)!r}D)"
            out["ms"] = f"1D - {a}"
            out["pf"], out["ps"] = f"{a} * {out[f'm{FAST}']}", f"-{a} * {out[f'm{SLOW}']}"
            out["bs"] = f"{a} * ({out[f'b{FAST}']} - {out[f'b{SLOW}']})"
        return self.struct(out)

    def then(self, f: str, s: str) -> str:
        """The map that applies ``f``, then ``s`` (names of struct columns or variables)."""
        out: dict[str, str] = {}
        for n in self.spans:
            out[f"m{n}"] = f"{s}.m{n} * {f}.m{n}"
            out[f"b{n}"] = f"{s}.m{n} * {f}.b{n} + {s}.b{n}"
        if self.macd:
            out["ms"] = f"{s}.ms * {f}.ms"
            out["pf"] = f"{s}.ms * {f}.pf + {s}.pf * {f}.m{FAST}"
            out["ps"] = f"{s}.ms * {f}.ps + {s}.ps * {f}.m{SLOW}"
            out["bs"] = f"{s}.ms * {f}.bs + {s}.pf * {f}.b{FAST} + {s}.ps * {f}.b{SLOW} + {s}.bs"
        return self.struct(out)

    def prefixes(self, maps: str) -> str:
        """All composed beginnings of an array of maps, the whole one last."""
        grown = f"concat(done, transform(array(element_at(done, -1)), f -> {self.then('f', 's')}))"
        return f"slice(aggregate({maps}, array({self.identity()}), (done, s) -> {grown}), 2, size({maps}))"

    def composed(self, maps: str) -> str:
        return f"aggregate({maps}, {self.identity()}, (f, s) -> {self.then('f', 's')})"


def _gaps(df: DataFrame, value: str, series: Series) -> tuple[DataFrame, str]:
    """``df`` with positions and blocks, and (as SQL) the rows since the last value present."""
    keys, at = list(series.keys), F.col(POSITION)
    present, gap = F.when(col(value).isNotNull(), at), f"({POSITION} - _last)"
    if series.tie is None or series.block_rows is None:
        before = series.window().rowsBetween(Window.unboundedPreceding, -1)
        placed = series.with_positions(df).withColumn(_BLOCK, F.floor(at / BLOCK_ROWS))
        return placed.withColumn("_last", F.last(present, ignorenulls=True).over(before)), gap
    placed = index_rows(df, keys, series.time, series.tie, POSITION).withColumn(_BLOCK, F.floor(at / BLOCK_ROWS))
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy(*keys, _BLOCK).agg(F.max(present).alias("_latest"))
    blocks = blocks.withColumn("_earlier", F.max("_latest").over(earlier)).drop("_latest")
    local = placed.withColumn("_local", F.last(present, ignorenulls=True).over(inside))
    found = join_nullsafe(local, blocks, [*keys, _BLOCK])
    return found.withColumn("_last", F.coalesce("_local", "_earlier")).drop("_local", "_earlier"), gap


def _carried(blocks: DataFrame, keys: list[str], maps: Maps, levels: int) -> DataFrame:
    """Add ``_start``, the composed maps of all earlier blocks of the series, to rows (keys, block, last).

    One level folds over all earlier blocks. A further one cuts the blocks into blocks, too.
    """
    if levels <= 1:
        earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        gathered = blocks.withColumn("_earlier", F.collect_list("_whole").over(earlier))
        return gathered.withColumn("_start", F.expr(maps.composed("_earlier"))).drop("_earlier")
    upper = (
        blocks.groupBy(*keys, F.floor(F.col(_BLOCK) / BLOCK_ROWS).alias("_upper"))
        .agg(F.sort_array(F.collect_list(F.struct(_BLOCK, "_whole"))).alias("_parts"))
        .withColumn("_done", F.expr(maps.prefixes("_parts._whole")))
        .select(*keys, F.col("_upper").alias(_BLOCK), F.element_at("_done", -1).alias("_whole"), "_parts", "_done")
    )
    started = _carried(upper, keys, maps, levels - 1)
    before = F.expr(f"concat(array({maps.identity()}), slice(_done, 1, size(_done) - 1))")
    each = started.select(*keys, "_start", F.inline(F.arrays_zip(F.col(f"_parts.{_BLOCK}").alias("_at"), before.alias("_before"))))
    starts = each.select(*keys, F.col("_at").alias(_BLOCK), F.expr(maps.then("_start", "_before")).alias("_start"))
    return join_nullsafe(blocks, starts, [*keys, _BLOCK])


def averages(
    df: DataFrame, value: str, spans: Sequence[int], macd: bool = False, series: Series = DAILY
) -> DataFrame:
    """Add ``ema_<span>`` of ``value`` for each span; with ``macd`` also macd, macd_signal and macd_hist.

    NULL before the first value present of a series; later rows without one hold it.
    """
    keys, maps = list(series.keys), Maps(spans, macd)
    placed, gap = _gaps(df, value, series)
    row = F.struct(*[col(c) for c in df.columns if c not in keys])
    packed = (
        placed.groupBy(*keys, _BLOCK)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        POSITION,
                        (F.col("_last").isNotNull() | col(value).isNotNull()).alias("begun"),
                        F.expr(maps.of_row(f"`{value}`", gap)).alias("map"),
                        row.alias("row"),
                    )
                )
            ).alias("_rows")
        )
        .withColumn("_done", F.expr(maps.prefixes("_rows.map")))
        .withColumn("_whole", F.element_at("_done", -1))
    )
    # 128 ** 3 rows of a long series; a calendar has a few hundred blocks a century.
    levels = 1 if series.tie is None or series.block_rows is None else 3
    if levels == 1:
        started = _carried(packed, keys, maps, 1)
    else:
        starts = _carried(packed.select(*keys, _BLOCK, "_whole"), keys, maps, levels).drop("_whole")
        started = join_nullsafe(packed, starts, [*keys, _BLOCK])
    zipped = F.arrays_zip(F.col("_rows.row").alias("row"), F.col("_rows.begun").alias("begun"), F.col("_done").alias("map"))
    rows = started.select(*keys, "_start", F.explode(zipped).alias("_r"))
    out = {f"ema_{n}": f"(_r.map.m{n} * _start.b{n} + _r.map.b{n})" for n in maps.spans}
    if macd:
        out["macd"] = f"({out[f'ema_{FAST}']} - {out[f'ema_{SLOW}']})"
        out["macd_signal"] = (
            f"(_r.map.ms * _start.bs + _r.map.pf * _start.b{FAST} + _r.map.ps * _start.b{SLOW} + _r.map.bs)"
        )
        out["macd_hist"] = f"{out['macd']} - {out['macd_signal']}"
    wanted = [f"ema_{n}" for n in spans] + (["macd", "macd_signal", "macd_hist"] if macd else [])
    return rows.select(
        *[col(c) if c in keys else F.col("_r.row")[c].alias(c) for c in df.columns],
        *[F.expr(f"if(_r.begun, {out[name]}, NULL)").alias(name) for name in wanted],
    )
