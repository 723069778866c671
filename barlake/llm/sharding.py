"""Shards from a keyed permutation of the global row numbers.

Every row has a number from 0 to N-1. A Feistel network permutes the smallest
power-of-two range that holds N, and numbers that land at N or above walk on
through the network until they come back below N (cycle walking), which makes it
a permutation of exactly 0..N-1. Row p of the permuted order goes to shard
p mod S, slot p div S: shard sizes differ by one row at most, slots have no gaps,
and both directions are computable from (N, S, key) without any table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.ranks import index_rows
from barlake.llm.common import text_bytes

ROUNDS = 6
#: Round function modulus (2**31 - 1): products stay below 2**62.
PRIME = 2147483647


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of 0..n-1; ``n`` may be up to 2**60."""

    n: int
    key: int = 42

    @property
    def bits(self) -> int:
        return max(2, int(self.n - 1).bit_length())

    def round_keys(self) -> list[tuple[int, int]]:
        """Multiplier and addend of every round, from the key by a plain congruence."""
        state, keys = self.key % PRIME + 1, []
        for _ in range(ROUNDS):
            state = (state * 48271 + 11) % PRIME
            multiplier = state % (PRIME - 1) + 1
            state = (state * 48271 + 11) % PRIME
            keys.append((multiplier, state))
        return keys

    def _mixed(self, half: np.ndarray, multiplier: int, addend: int) -> np.ndarray:
        h = (half * multiplier + addend) % PRIME
        h = h ^ (h >> 15)
        return ((h % PRIME) * 69621 + addend) % PRIME >> 3

    def _network(self, x: np.ndarray, forward: bool) -> np.ndarray:
        """One pass. The halves have ``low`` and ``bits - low`` bits and swap every round."""
        wide, low = self.bits - self.bits // 2, self.bits // 2
        keys = self.round_keys()
        if forward:
            left, right = x >> low, x & ((1 << low) - 1)
            widths = wide
            for multiplier, addend in keys:
                left, right = right, (left ^ self._mixed(right, multiplier, addend)) & ((1 << widths) - 1)
                widths = self.bits - widths
            return (left << low) | right
        left, right = x >> low, x & ((1 << low) - 1)
        widths = low
        for multiplier, addend in reversed(keys):
            left, right = (right ^ self._mixed(left, multiplier, addend)) & ((1 << widths) - 1), left
            widths = self.bits - widths
        return (left << low) | right

    def _walk(self, x: np.ndarray, forward: bool) -> np.ndarray:
        x = self._network(np.asarray(x, np.int64), forward)
        while (out := np.flatnonzero(x >= self.n)).size:
            x[out] = self._network(x[out], forward)
        return x

    def apply(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, True)

    def invert(self, places: np.ndarray) -> np.ndarray:
        """Row numbers that stand at the given places of the permuted order."""
        return self._walk(places, False)


def locate(row: int, rows: int, shards: int, key: int = 42) -> tuple[int, int]:
    """Shard and slot of one row number, without touching the data."""
    place = int(Permutation(rows, key).apply(np.array([row]))[0])
    return place % shards, place // shards


def row_at(shard: int, slot: int, rows: int, shards: int, key: int = 42) -> int:
    """The row number that stands in a slot of a shard."""
    return int(Permutation(rows, key).invert(np.array([slot * shards + shard]))[0])


def assign_shards(docs: DataFrame, shards: int, key: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text (missing: none) plus 8. Row numbers
    follow doc_id, then a hash of the text; they depend on the rows alone, not on
    files or partitions. Missing doc_ids come first. Rows equal in doc_id and text
    are interchangeable and still get a slot each. An empty table gives no rows.
    Other columns of ``docs`` are not read.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    data = text_bytes()
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.xxhash64("text").alias("__text"),
    )
    rows = docs.count()
    permutation = Permutation(max(rows, 1), key)

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation.apply(numbers.to_numpy()))

    numbered = index_rows(slim, [], "doc_id", "__text", "row_number")
    placed = numbered.withColumn("__place", place("row_number"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        "row_number",
        (F.col("__place") % shards).cast("int").alias("shard"),
        F.expr(f"__place div {int(shards)}").cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, shards: int, path: str, key: int = 42, files_per_shard: int = 1) -> None:
    """Write whole rows of ``docs`` below ``path``, one folder a shard, in slot order.

    Needs a unique doc_id, for rows meet their places by it. A shard may be split
    into several files of consecutive slots.
    """
    places = assign_shards(docs, shards, key).select("doc_id", "shard", "slot")
    rows = docs.join(places, "doc_id")
    span = F.greatest(F.lit(1), F.ceil(F.lit(docs.count()) / F.lit(shards * files_per_shard)))
    rows.repartition(shards * files_per_shard, "shard", F.floor(F.col("slot") / span)).sortWithinPartitions(
        "shard", "slot"
    ).write.partitionBy("shard").parquet(path)
