"""Near copies by word shingles: SimHash classes and MinHash buckets, exact Jaccard similarity inside them.

Texts with the same set of shingles are one node. What the pigeonring search links by the
SimHash of the same shingles (``simhash``) is one bucket; pairs of the similarity often
differ in more bits than it finds, so further buckets add those: ``BANDS`` keys of ``ROWS`` minima each
put nodes into buckets; two sets of similarity 0.8 share none with probability 7e-5, of
0.85 with 8e-7. Buckets with the same nodes are one. A task gets the shingles of the nodes
of a bucket, tests the sets themselves, and lets out a spanning forest of the links it
found, never all pairs:

1. Every node goes to the largest of its buckets, with the bucket's least node for company.
   That finds most classes at the price of one copy of each node.
2. Buckets whose nodes are still in different classes are searched again. Nodes of the
   bucket's largest class need not meet each other, so they are dealt into parts, and only
   the other nodes meet all parts.

A part holds about ``part_rows`` nodes, fewer if their sets are large. Only a bucket with
many nodes that are alike, but below the similarity, costs copies in proportion to
the square of its parts; it loses no link for that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.scratch import written
from barlake.llm.common import LOWER, as_bytes, gram_hashes, hot_join, mix, span_hashes, unused_name, word_spans
from barlake.llm.graph import components
from barlake.llm.simhash import fingerprint, near_classes

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
PART_ROWS = 2048
#: Shingles that weigh as much as a further row of a part.
HEAVY = 512
_LEAST_MULTIPLIER = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_COLUMNS = 2048


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one, none without words."""
    data = LOWER[as_bytes(text)]
    words = span_hashes(data, *word_spans(data))
    return np.unique(gram_hashes(words, min(size, len(words)))) if len(words) else np.zeros(0, np.uint64)


def band_keys(found: np.ndarray) -> np.ndarray:
    """The bucket keys of a set of shingles that is not empty: the least values of ROWS hash functions each."""
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _COLUMNS):
        np.minimum(out, (found[None, at : at + _COLUMNS] * _LEAST_MULTIPLIER[:, None]).min(axis=1), out=out)
    keys = np.arange(BANDS, dtype=np.uint64)
    for least in out.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x100000001B3) + least)
    return keys.view(np.int64)


def _signatures(size: int):
    def sign(texts: pd.Series) -> pd.DataFrame:
        sets, sizes, keys, prints = [], [], [], []
        for text in texts:
            found = shingles(text, size)
            sets.append(xxhash.xxh64_intdigest(found.tobytes(), 42) - (1 << 63))
            sizes.append(len(found))
            keys.append(band_keys(found) if len(found) else np.zeros(0, np.int64))
            prints.append(fingerprint(text, size))
        return pd.DataFrame(
            {"set_id": pd.Series(sets, dtype="int64"), "n_shingles": pd.Series(sizes, dtype="int64"), "bands": keys, "fp": pd.Series(prints, dtype="int64")}
        )

    return F.pandas_udf(sign, "set_id long, n_shingles long, bands array<long>, fp long")


def _sets(size: int):
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t, size).tobytes() for t in texts], dtype=object)

    return F.pandas_udf(cut, "binary")


def spanning_links(classes: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links (i, j) that join what the sets of at least the similarity join, given the classes.

    A search from class to class: a node is compared with those only that no class has
    reached yet, all at once, by counting their shingles among its own.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    _, group = np.unique(classes, return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    first = np.searchsorted(group[by_group], np.arange(group.max(initial=-1) + 2))
    dense = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    own = [dense[e - s : e] for s, e in zip(sizes, ends)]
    owner, values, present = np.repeat(np.arange(n), sizes), dense, np.zeros(dense.max(initial=-1) + 1, bool)
    left, kept, out = np.ones(n, bool), n, []
    for seed in range(n):
        if not left[seed]:
            continue
        queue = by_group[first[group[seed]] : first[group[seed] + 1]].tolist()
        left[queue] = False
        while queue and (remaining := int(left.sum())):
            x = queue.pop()
            if remaining * 2 < kept:
                alive = left[owner]
                owner, values, kept = owner[alive], values[alive], remaining
            present[own[x]] = True
            both = np.bincount(owner[present[values]], minlength=n)
            present[own[x]] = False
            for y in np.flatnonzero(left & (both / np.maximum(sizes[x] + sizes - both, 1) >= similarity)).tolist():
                if left[y]:
                    out.append((x, y))
                    joined = by_group[first[group[y]] : first[group[y] + 1]]
                    left[joined] = False
                    queue += joined.tolist()
    return out


_BY = ["key", "low", "high"]


def _forest(similarity: float):
    """Links (a, b) inside the groups of rows sorted by (key, low, high)."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("set_id")
        ids = rows["set_id"].to_numpy()
        links = spanning_links(rows["class"].to_numpy(), [np.frombuffer(s, np.uint64) for s in rows["shingles"]], similarity)
        return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]}, dtype="int64")

    def groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            if not len(frame):
                continue
            rows = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = (rows[_BY] == rows[_BY].iloc[-1]).all(axis=1).to_numpy()
            held = rows[last]
            for _, group in rows[~last].groupby(_BY, sort=False):
                yield search(group)
        if held is not None:
            yield search(held)

    return groups


def _links(dealt: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Spanning links of the groups (key, low, high) of (set_id, class) rows."""
    full = dealt.join(sets, "set_id").select(*_BY, "set_id", "class", "shingles")
    return full.repartition(*_BY).sortWithinPartitions(*_BY).mapInPandas(_forest(similarity), "a long, b long")


def _row_key(docs: DataFrame) -> Column:
    """What orders rows: doc_id (missing last), then hashes of the text and of all columns."""
    hashable = [f"`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64("text").alias("text"),
        F.xxhash64(*hashable).alias("all"),
    )


def _parts(weight: str | Column, part_rows: int) -> Column:
    weight = F.col(weight) if isinstance(weight, str) else weight
    return F.greatest(F.ceil(weight / part_rows), F.lit(1)).cast("int")


def near_links(first: DataFrame, sets_of, similarity: float = SIMILARITY, part_rows: int = PART_ROWS) -> DataFrame:
    """Links (a, b) of set_id whose closure is that of all pairs of a bucket with the similarity.

    ``first`` has a row per set: set_id, n_shingles, bands; ``sets_of`` gives (set_id,
    shingles) for a table of set_ids.
    """
    rows = first.where("n_shingles > 0")
    total = rows.agg(F.sum(F.size("bands"))).first()[0] or 0
    weight = 1 + F.col("n_shingles") / HEAVY
    keys = rows.select("set_id", weight.alias("weight"), F.explode("bands").alias("key"))
    buckets = (
        keys.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("weight").alias("total"),
            F.min("set_id").alias("hub"),
            F.bit_xor(F.xxhash64("set_id")).alias("__x"),
            F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("__y"),
        )
        .where("n > 1")
    )
    # Buckets of the same nodes are compared once.
    distinct = written(
        buckets.groupBy("n", "hub", "__x", "__y").agg(F.min("key").alias("key"), F.max("total").alias("total"))
        .select("key", "n", "hub", "total"),
        "buckets",
    )
    members = written(hot_join(keys, distinct, "key", "n", total), "members")
    sets = sets_of(members.select("set_id").distinct())

    largest = members.groupBy("set_id").agg(F.max(F.struct("n", "key", "hub", "total")).alias("b")).select("set_id", "b.*")
    parts = _parts("total", part_rows)
    dealt = largest.select("key", F.pmod(F.xxhash64("set_id"), parts).cast("int").alias("low"), "set_id")
    hubs = largest.select("key", "hub", parts.alias("parts")).distinct().select(
        "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("low"), F.col("hub").alias("set_id")
    )
    singles = dealt.unionByName(hubs).select("key", "low", F.col("low").alias("high"), "set_id", F.col("set_id").alias("class"))
    links = written(_links(singles, sets, similarity), "alike")

    classes = components(links).select(F.col("node").alias("set_id"), F.col("root").alias("class"))
    tagged = written(
        members.join(classes, "set_id", "left").select("key", "n", "set_id", "weight", F.coalesce("class", "set_id").alias("class")),
        "tagged",
    )
    mixed = (
        tagged.groupBy("key", "class")
        .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows"))
        .groupBy("key")
        .agg(
            F.max(F.struct("weight", "class")).alias("major"),
            F.sum("weight").alias("weight"),
            F.sum("rows").alias("n"),
            F.count(F.lit(1)).alias("classes"),
        )
        .where("classes > 1")
        .select(
            "key",
            "n",
            F.col("major.class").alias("major"),
            _parts("major.weight", part_rows).alias("p"),
            _parts(F.col("weight") - F.col("major.weight"), part_rows).alias("m"),
        )
    )
    met = hot_join(tagged.drop("n"), written(mixed, "mixed"), "key", "n", total)
    spread = F.xxhash64("set_id")
    is_major = F.col("class") == F.col("major")
    own = F.when(is_major, F.pmod(spread, "p")).otherwise(F.col("p") + F.pmod(spread, "m")).cast("int")
    others = F.when(is_major, F.sequence(F.col("p"), F.col("p") + F.col("m") - 1)).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("p") + F.col("m") - 1), lambda q: q != F.col("own"))
    )
    blocks = (
        met.withColumn("own", own)
        .withColumn("other", F.explode(others))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "set_id", "class")
    )
    return links.unionByName(written(_links(blocks, sets, similarity), "alike"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, part_rows: int = PART_ROWS) -> DataFrame:
    """One row of every class of near copies, with the columns of ``docs``.

    A class is what links of at least ``similarity`` (Jaccard, of the sets of
    ``shingle`` words) reach; texts without words are one class. The row with the
    least doc_id stays (rows without one come last, then ties go by a hash of the
    text, then of all columns but maps). Below a similarity of 0.8 the buckets miss
    more pairs. An empty table stays empty.
    """
    key = unused_name(docs.columns, "row")
    keyed = docs.withColumn(key, _row_key(docs))
    rows = written(keyed.select(F.col(key).alias("row"), _signatures(shingle)("text").alias("s")).select("row", "s.*"), "signatures")
    first = written(
        rows.groupBy("set_id").agg(F.min(F.struct("row", "n_shingles", "bands", "fp")).alias("f")).select("set_id", "f.*"), "distinct-sets"
    )
    # The class of close fingerprints is one more bucket of a set.
    close = near_classes(first.where("n_shingles > 0")).select("fp", F.xxhash64(F.lit("simhash"), "root").alias("close"))
    keyed_sets = written(
        first.join(close, "fp").select("set_id", "n_shingles", F.concat("bands", F.array("close")).alias("bands")), "keyed-sets"
    )

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = first.join(ids, "set_id", "left_semi").select("set_id", F.col("row").alias(key))
        return written(
            keyed.select(key, "text").join(wanted, key).dropDuplicates(["set_id"])
            .select("set_id", _sets(shingle)("text").alias("shingles")),
            "shingles",
        )

    ends = components(near_links(keyed_sets, sets_of, similarity, part_rows)).select(F.col("node").alias("set_id"), "root")
    kept = (
        first.join(ends, "set_id", "left")
        .groupBy(F.coalesce("root", "set_id").alias("root"))
        .agg(F.min("row").alias(key))
        .select(key)
    )
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
