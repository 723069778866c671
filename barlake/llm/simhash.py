"""SimHash fingerprints, linked by a pigeonring search.

A fingerprint has 8 segments of 8 bits on a ring. If two differ in at most 3 bits,
some segment starts a chain along which the differences of the first l segments
together stay within l * 3/8 for every l: 0, 0, 1, 1, 1, 2, 2, 3 bits. So segments
1 and 2 of the chain are equal, and of segments 3 to 5 one differs at most. That
gives 8 starts * 3 segments left out = 24 keys of 32 equal bits, an equi-grouping
instead of a comparison of all pairs; inside a group the chain is checked before
the full distance.

Work is done on distinct fingerprints. A group larger than ``GROUP_ROWS`` is not
compared: its free bits are cut into four parts, of which at least one is equal in
any linked pair, and the group is dealt again by key and part. Keys only gain bits
(a group of g free bits holds 2**g fingerprints at most), so this ends, and it is
exact. Groups report a spanning forest of their links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.scratch import written
from barlake.llm.graph import components, merge_labels

SEED = 42
SEGMENTS, WIDTH, DISTANCE = 8, 8, 3
#: Most differing bits in the first l segments of a chain.
BUDGETS = np.array([length * DISTANCE // SEGMENTS for length in range(1, SEGMENTS + 1)])
GROUP_ROWS = 2048
_LINKS = 500_000
_ALL = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The signed 64-bit SimHash of the word shingles of a text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return signed(xxhash.xxh64_intdigest(b" ".join(words), SEED))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - shingle].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], ">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(hashes)).tobytes()
    return int.from_bytes(packed, "big", signed=True)


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def first_masks() -> list[tuple[int, int]]:
    """(start, mask of the equal bits) of the 24 keys."""
    out = []
    for start in range(SEGMENTS):
        chain = [255 << (WIDTH * ((start + i) % SEGMENTS)) for i in range(5)]
        for left_out in (2, 3, 4):
            out.append((start, sum(bits for i, bits in enumerate(chain) if i != left_out)))
    return out


def finer_masks(mask: int) -> list[int]:
    """The mask with each of the four parts of its free bits added."""
    free = [i for i in range(64) if not mask >> i & 1]
    parts = [free[i :: DISTANCE + 1] for i in range(DISTANCE + 1)]
    return [mask | sum(1 << i for i in part) for part in parts if part]


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links inside the groups of rows sorted by (start, mask, held), as (a, b) rows."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        bits = rows["fp"].to_numpy().view(np.uint64)
        key = rows[["start", "mask", "held"]].to_numpy()
        run = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
        nodes, node = np.unique(rows["fp"].to_numpy(), return_inverse=True)
        labels = np.arange(len(nodes))
        start = key[:, 0]
        ring = np.arange(SEGMENTS)
        left, right, waiting = [], [], 0
        at, step = np.arange(len(rows) - 1), 1
        while len(at := at[at + step < len(rows)]) and len(at := at[run[at] == run[at + step]]):
            diff = bits[at] ^ bits[at + step]
            # Little-endian bytes: segment i is byte i.
            each = np.bitwise_count(diff.view(np.uint8).reshape(-1, SEGMENTS))
            chain = np.take_along_axis(each, (start[at][:, None] + ring) % SEGMENTS, axis=1)
            close = (np.cumsum(chain, axis=1) <= BUDGETS).all(axis=1)
            left.append(node[at[close]])
            right.append(node[at[close] + step])
            waiting += int(close.sum())
            if waiting > _LINKS:
                labels = merge_labels(labels, np.concatenate(left), np.concatenate(right))
                left, right, waiting = [], [], 0
            step += 1
        if left:
            labels = merge_labels(labels, np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(labels != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[moved], "b": nodes[labels[moved]]})

    held: pd.DataFrame | None = None
    for frame in frames:
        if not len(frame):
            continue
        rows = frame if held is None else pd.concat([held, frame], ignore_index=True)
        last = rows[["start", "mask", "held"]].iloc[-1]
        open_run = ((rows[["start", "mask", "held"]] == last).all(axis=1)).to_numpy()
        held = rows[open_run].reset_index(drop=True)
        if not open_run.all():
            yield links(rows[~open_run].reset_index(drop=True))
    if held is not None:
        yield links(held)


def near_links(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Links (a, b) whose closure equals that of all pairs of ``fp`` values 3 bits apart or less.

    ``prints`` holds distinct long values ``fp``.
    """
    spark = prints.sparkSession
    masks = [(start, signed(mask)) for start, mask in first_masks()]
    keys = F.explode(
        F.array(*[F.struct(F.lit(s).alias("start"), F.lit(m).alias("mask")) for s, m in masks])
    )
    level = prints.select("fp", keys.alias("k")).select("fp", "k.*")
    out: DataFrame | None = None
    by = ["start", "mask", "held"]
    while True:
        level = level.withColumn("held", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = level.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        shared = written(level.join(sizes, by), "near-keys")
        found = (
            shared.where(F.col("__n") <= group_rows)
            .select("fp", *by)
            .repartition(*by)
            .sortWithinPartitions(*by)
            .mapInPandas(_forest, "a long, b long")
        )
        out = found if out is None else out.unionByName(found)
        large = shared.where(F.col("__n") > group_rows)
        tried = [(r["start"], r["mask"]) for r in large.select("start", "mask").distinct().collect()]
        if not tried:
            return out
        finer = [(s, m, signed(f)) for s, m in tried for f in finer_masks(m & _ALL)]
        next_masks = spark.createDataFrame(finer, "start int, mask long, __finer long")
        level = large.select("fp", "start", "mask").join(next_masks, ["start", "mask"]).select(
            "fp", "start", F.col("__finer").alias("mask")
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp of every row, written to the shared folder."""
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.pandas_udf(_fingerprints, "long")("text").alias("fp"),
    )
    return written(slim, "fingerprints")


def near_classes(prints: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(fp, root) of every distinct fingerprint; equal roots mean one class of near copies."""
    distinct = written(prints.select("fp").distinct(), "distinct-fingerprints")
    stars = components(near_links(distinct, group_rows))
    return distinct.join(stars, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``.

    ``component_id`` is the least doc_id that links of at most 3 differing bits
    reach. Texts without words (missing, empty, white space only) have fingerprint
    0, linked like any other. Rows that repeat a doc_id share in the class of their
    own text; a missing doc_id never becomes a component_id unless all are missing.
    Other columns are not read. An empty table gives no rows.
    """
    prints = fingerprints(docs)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("__doc"))
    classes = near_classes(prints, group_rows).join(least, "fp")
    ids = classes.groupBy("root").agg(F.min("__doc").alias("component_id"))
    by_print = classes.join(ids, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row of every class of near copies, with the columns of ``docs``.

    The row with the least doc_id stays (rows without one come last, then ties go
    by a hash of the text); of rows that agree in both, any one.
    """
    prints = fingerprints(docs)
    row = F.struct(F.col("doc_id").isNull().alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("text_hash").alias("__hash"))
    least = prints.groupBy("fp").agg(F.min(row).alias("__row"))
    kept = (
        near_classes(prints, group_rows)
        .join(least, "fp")
        .groupBy("root")
        .agg(F.min("__row").alias("__row"))
        .select("__row.*")
    )
    keys = ["__none", "__id", "__hash"]
    keyed = docs.withColumns(
        {
            "__none": F.col("doc_id").isNull(),
            "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "__hash": F.xxhash64("text"),
        }
    )
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)
