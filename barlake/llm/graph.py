"""Connected components of link tables, by alternating star contractions.

A large-star step points every larger neighbour of a node at the least node it
knows, a small-star step does so for the smaller ones; alternating them turns
every component into a star around its least node in about log(n) rounds. A
round is two aggregations (map-side combined, so a hub costs one row a task) and
two joins, and is written to the shared folder before the next one starts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("__least"))
    least = least.select("a", F.least("a", "__least").alias("__least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("__least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("__least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("__least").alias("b"))
    own = least.select("a", F.col("__least").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a, b) that is not a root itself.

    The root is the least node of the component. No edges give no rows; repeated
    edges and loops are allowed.
    """
    stars = written(edges.where("a <> b").distinct(), "links")
    print_of = None
    while True:
        stars = written(_small_star(_large_star(stars)), "stars")
        now = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == print_of:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        print_of = now


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of positions a[i] and b[i]; every position ends with the least of its set."""
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        if np.array_equal(low, high):
            return labels
        np.minimum.at(labels, high, low)
        while not np.array_equal(jumped := labels[labels], labels):
            labels = jumped
