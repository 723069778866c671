"""What the corpus operators share: reading, shared scratch tables, ranks, vectorised words.

Missing text counts as empty text everywhere unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows a rank group aims at, and the fewest groups; the fan-out follows the row count.
RANK_ROWS = 50_000
RANK_GROUPS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of the text; missing text has none."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def row_numbers(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], rows: int, name: str
) -> DataFrame:
    """Add a gapless number from 0 within each ``by`` group; any group may be hot.

    Rows fall into hashed parts of the group, a window numbers each part in
    ``order``, and the sizes of the earlier parts are added. The number of parts
    depends on ``rows`` (the rows of ``df``) alone, so the numbers do not depend
    on partitions, files or retries. Rows equal in all of ``order`` are
    interchangeable.
    """
    parts = max(RANK_GROUPS, -(-rows // RANK_ROWS)) if not by else max(64, -(-rows // RANK_ROWS))
    dealt = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__size"))
    before = (
        Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        *by, "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy(*by, "__part").orderBy(*order)
    return (
        dealt.withColumn("__at", F.row_number().over(inside) - 1)
        .join(starts, [*by, "__part"])
        .withColumn(name, (F.col("__start") + F.col("__at")).cast("long"))
        .drop("__part", "__at", "__start")
    )


def draw_limit(wanted: int, rows: int) -> int:
    """Largest 63-bit hash of a sample of about ``wanted`` of ``rows`` rows; see :func:`draw_hash`."""
    return min((1 << 63) - 1, max((wanted << 63) // max(rows, 1), 1))


def draw_hash(column: str) -> Column:
    """A hash of 63 bits; rows whose hash is at most :func:`draw_limit` are the sample."""
    return F.xxhash64(column).bitwiseAND((1 << 63) - 1)


#: A key with more than this share of the rows is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1e-3


def hot_join(left: DataFrame, right: DataFrame, on: str, weight: str, rows: int, share: float = HOT_SHARE) -> DataFrame:
    """Inner join on a key that ``right`` has once, with ``weight`` = its rows in ``left``.

    Keys with more than ``share`` of all ``rows`` of ``left`` are joined by a broadcast of
    at most 1 / ``share`` rows, the others by a shuffle, so no task gets more than that share.
    """
    limit = max(share * rows, 1)
    hot, cold = right.where(F.col(weight) > limit), right.where(F.col(weight) <= limit)
    rest = left.join(F.broadcast(hot.select(on)), on, "left_anti")
    return rest.join(cold, on).unionByName(left.join(F.broadcast(hot), on))


def unused_name(columns: Sequence[str], name: str) -> str:
    """A column name that starts with __ and is not among ``columns`` (in any case)."""
    taken, name = {c.lower() for c in columns}, f"__{name}"
    while name in taken:
        name += "_"
    return name


# ---- words as arrays -------------------------------------------------------------------

#: Bytes that separate words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _POWERS[base] = have = np.cumprod(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the finaliser of SplitMix64)."""
    h = h.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every maximal run of bytes that are not white space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes, equal for equal bytes wherever they stand."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(INVERSE, n)[starts])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(0x100000001B3) + words[i : len(words) - n + 1 + i]
    return mix(out)


def as_bytes(text: str | None) -> np.ndarray:
    """UTF-8 bytes of a text; missing text has none."""
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def slices(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to ``most`` or one item more."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)
