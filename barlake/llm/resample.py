"""Importance resampling towards a target: bit-sliced weights, Gumbel scores, exact ranks.

Words are hashed to buckets; a bucket's gain is the log ratio of its share in the target
to its share in the documents, as a whole number of thousandths. Gains are stored as bit
planes of two's complement: plane j holds bit j of every bucket's gain. A document's
bucket counts become planes, too. The sum of count times gain is then

    sum over i, j of +-2**(i + j) * popcount(counts plane i AND gains plane j)

with a minus for the sign plane, which is exact. Two scans of the texts, for counts and
for weights; of the documents only ids and numbers travel.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.ranks import stretches
from barlake.functions.scratch import written

BUCKETS, GRAMS, LEAST_WORDS, SHARE, SEED = 10_000, 1, 20, 10, 2024
#: Lower-cases A-Z; every other ASCII byte that is no letter or digit separates.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: Features whose bucket a worker remembers at once.
_REMEMBERED = 200_000
_DOCS = 256


def words_of(text: str | None) -> list[bytes]:
    """The words of a text; missing text has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _features(words: list[bytes], grams: int) -> Iterator[bytes]:
    yield from words
    for n in range(2, grams + 1):
        for i in range(len(words) - n + 1):
            yield b" ".join(words[i : i + n])


class _Buckets:
    """Bucket counts of texts, with a bounded memory of features seen before."""

    def __init__(self, buckets: int, grams: int):
        self.buckets, self.grams, self.known = buckets, grams, {}

    def count(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, count), a bucket maybe more than once."""
        counts = Counter(_features(words, self.grams))
        if len(self.known) > _REMEMBERED:
            self.known.clear()
        known, places = self.known, []
        for feature in counts:
            place = known.get(feature)
            if place is None:
                known[feature] = place = zlib.crc32(feature) % self.buckets
            places.append(place)
        return np.array(places, np.int64), np.fromiter(counts.values(), np.int64, len(counts))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, grams: int = GRAMS) -> np.ndarray:
    """Features of all rows of ``text`` by bucket; one row a bucket reaches the driver."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine, total = _Buckets(buckets, grams), np.zeros(buckets, np.int64)
        for frame in frames:
            for text in frame["text"]:
                places, n = mine.count(words_of(text))
                np.add.at(total, places, n)
        met = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": met.astype(np.int32), "n": total[met]})

    out = np.zeros(buckets, np.int64)
    found = texts.select("text").mapInPandas(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in found.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the smoothed log ratio of each bucket."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * float(s_all + buckets) / (float(s + 1) * float(t_all + buckets))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def planes(numbers: np.ndarray, bits: int) -> np.ndarray:
    """Bits 0 to ``bits`` - 1 of the last axis of numbers as rows of 64-bit words."""
    width = -(-numbers.shape[-1] // 64) * 8
    out = np.zeros((*numbers.shape[:-1], bits, width), np.uint8)
    for j in range(bits):
        packed = np.packbits((numbers >> j & 1).astype(bool), axis=-1, bitorder="little")
        out[..., j, : packed.shape[-1]] = packed
    return out.view(np.uint64)


def gain_planes(numbers: np.ndarray) -> np.ndarray:
    """Planes of two's complement; the last one is the sign."""
    bits = max(int(np.abs(numbers).max(initial=0)).bit_length(), 1) + 1
    return planes(numbers, bits)


def weighted_sums(counts: np.ndarray, sliced: np.ndarray) -> np.ndarray:
    """Sum of counts times gains of every row of ``counts``, from the planes of the gains."""
    depth = max(int(counts.max(initial=0)).bit_length(), 1)
    total = np.zeros(len(counts), np.int64)
    for i in range(depth):
        mine = planes(counts >> i & 1, 1)[:, 0]
        for j, plane in enumerate(sliced):
            ones = np.bitwise_count(mine & plane).sum(axis=1, dtype=np.int64)
            total += (-ones if j == len(sliced) - 1 else ones) << (i + j)
    return total


def _weights(sliced: np.ndarray, buckets: int, grams: int):
    def weigh(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        mine = _Buckets(buckets, grams)
        for series in texts:
            parts = []
            for at in range(0, len(series), _DOCS):
                block = series.iloc[at : at + _DOCS]
                counts = np.zeros((len(block), buckets), np.int64)
                words, features = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
                for i, text in enumerate(block):
                    found = words_of(text)
                    places, n = mine.count(found)
                    np.add.at(counts[i], places, n)
                    words[i], features[i] = len(found), n.sum()
                sums = weighted_sums(counts, sliced)
                parts.append((words, features, np.where(features > 0, sums // np.maximum(features, 1), 0)))
            columns = [np.concatenate(c) for c in zip(*parts)] or [np.zeros(0, np.int64)] * 3
            yield pd.DataFrame(dict(zip(("n_words", "n_features", "weight"), columns)))

    return F.pandas_udf(weigh, "n_words long, n_features long, weight long")


def _noise(seed: int):
    """Whole thousandths of a Gumbel number that the id decides."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    grams: int = GRAMS,
    least_words: int = LEAST_WORDS,
    share: int = SHARE,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of ``docs``.

    Of the N rows with at least ``least_words`` words the floor(share * N / 100) with the
    highest scores are drawn and ranked from 1 (ties: smaller doc_id, missing ones last;
    rows equal in both rank by their number of words); the rank of all others is missing.
    Missing and empty texts have weight 0; a missing doc_id counts as empty text in the
    hash. Repeated rows count each. ``target`` may be empty: its counts are 0. Other columns
    are not read. An empty table gives no rows.
    """
    learned = gains(bucket_counts(docs, buckets, grams), bucket_counts(target, buckets, grams))
    weigh = _weights(gain_planes(learned), buckets, grams)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), weigh("text").alias("__w")).select("doc_id", "__w.*")
    scored = written(slim.withColumn("score", F.col("weight") + _noise(seed)), "scored")

    able = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    draws = scored.where(able).count() * share // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_words")]
    ranges = stretches(scored.where(able), order)
    rank, start = _ranks(ranges, order, draws)
    placed = rank.join(F.broadcast(start), "_stretch").select(
        *scored.columns, F.when(F.col("__at") + F.col("__start") <= draws, F.col("__at") + F.col("__start")).alias("rank")
    )
    return placed.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))


def _ranks(ranges: DataFrame, order: list, draws: int) -> tuple[DataFrame, DataFrame]:
    """Places inside the stretches, and the rows before each (one row a shuffle partition)."""
    sizes = sorted((r["_stretch"], r["count"]) for r in ranges.groupBy("_stretch").count().collect())
    before, total = [], 0
    for stretch, n in sizes:
        before.append((stretch, total))
        total += n
    start = ranges.sparkSession.createDataFrame(before, "_stretch int, __start long")
    inside = Window.partitionBy("_stretch").orderBy(*order)
    return ranges.withColumn("__at", F.row_number().over(inside).cast("long")), start
