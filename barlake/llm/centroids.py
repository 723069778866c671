"""Centroid clustering with Orchard's search for the nearest centroid.

Every centroid keeps the others sorted by their distance to it. The search for a
vector stands at one centroid, walks down that list and measures the centroids it has
not visited yet; a closer one takes over at once, with its own list from the top. It
ends at the first entry strictly more than twice as far from the current centroid as
the vector is: by the triangle inequality everything from there on is farther, so even
ties have been seen. All numbers are integers, so results do not depend on the order
of rows, on partitions or on retries.

A round is one scan of the integer vectors with a sum a cluster and component from
each task; only those sums (clusters x components) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.scratch import written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Components must stay below this, so that squared distances fit into 63 bits.
LARGEST = 1 << 27
#: Vectors measured together; bounds the memory of a task whatever the Arrow batch holds.
_SLICE = 8192


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per centroid the others, nearest first, and a quarter of their squared distances, rounded up."""
    k = len(centroids)
    order, reach = np.zeros((k, max(k - 1, 0)), np.int64), np.zeros((k, max(k - 1, 0)), np.int64)
    for p in range(k):
        gaps = _squared(centroids, centroids[p])
        others = np.argsort(gaps, kind="stable")
        order[p] = others = others[others != p]
        reach[p] = -(-gaps[others] // 4)
    return order, reach


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = a - b
    return np.einsum("ij,ij->i", apart, apart)


def nearest(
    vectors: np.ndarray, centroids: np.ndarray, lists: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of every row (ties: smaller number)."""
    order, reach = lists
    n, k = len(vectors), len(centroids)
    # The walk starts at the best of a few centroids; any start gives the same end.
    here = np.zeros(n, np.int64)
    best = _squared(vectors, centroids[0][None, :])
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    step = max(2, int(np.sqrt(k)))
    for s in range(step, k, step):
        apart = _squared(vectors, centroids[s][None, :])
        closer = apart < best
        here[closer], best[closer] = s, apart[closer]
        seen[:, s] = True
    at, walking = np.zeros(n, np.int64), np.arange(n)
    while len(walking := walking[at[walking] < k - 1]):
        # Twice the distance is four times its square: reach is compared with the square itself.
        walking = walking[reach[here[walking], at[walking]] <= best[walking]]
        found = order[here[walking], at[walking]]
        at[walking] += 1
        fresh = ~seen[walking, found]
        rows, found = walking[fresh], found[fresh]
        seen[rows, found] = True
        apart = _squared(vectors[rows], centroids[found])
        closer = (apart < best[rows]) | ((apart == best[rows]) & (found < here[rows]))
        moved = rows[closer]
        here[moved], best[moved], at[moved] = found[closer], apart[closer], 0
    return here, best


def integer_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer components (little-endian, 32 bits each) of the rows that are kept."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        (F.size("embedding") == dimensions) & sound
    )

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            whole = np.floor(flat * scale)
            if (np.abs(whole) >= LARGEST).any():
                raise ArithmeticError(f"a component passes {LARGEST / scale:.0f}: its distances do not fit into a long")
            rows = whole.astype("<i4").reshape(-1, dimensions)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["vec_id", "components"]
            )

    return kept.mapInArrow(scaled, "vec_id long, components binary")


def _rows(column: pa.Array, dimensions: int) -> Iterator[np.ndarray]:
    """Blocks of the vectors of an Arrow column."""
    for at in range(0, len(column), _SLICE):
        packed = b"".join(column.slice(at, _SLICE).to_pylist())
        yield np.frombuffer(packed, "<i4").reshape(-1, dimensions).astype(np.int64)


def _sums(centroids: np.ndarray):
    """Rows and component sums a cluster, one row a cluster that the task met."""
    k, dimensions = centroids.shape
    lists = neighbour_lists(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            for vectors in _rows(batch.column(0), dimensions):
                cluster, _ = nearest(vectors, centroids, lists)
                count += np.bincount(cluster, minlength=k)
                by = np.argsort(cluster, kind="stable")
                met, first = np.unique(cluster[by], return_index=True)
                total[met] += np.add.reduceat(vectors[by], first)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(count[met]), pa.array(list(total[met]), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"],
        )

    return add


def _assigned(centroids: np.ndarray):
    dimensions = centroids.shape[1]
    lists = neighbour_lists(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(v, centroids, lists) for v in _rows(batch.column(1), dimensions)]
            cluster = np.concatenate([c for c, _ in found]) if found else np.zeros(0, np.int64)
            distance = np.concatenate([d for _, d in found]) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return assign


def cluster_vectors(
    embeddings: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    A row is kept if its vector has exactly ``dimensions`` components, none missing or
    non-finite; x becomes floor(scale * x). The first centroids are the kept vectors with
    the smallest sha256 of ``seed:vec_id`` (repeated ids: smaller components first; fewer
    vectors than ``clusters``: all of them). Each round assigns every vector (ties: smaller
    number) and moves each centroid that has vectors to their floored mean. Rows without
    vec_id are clustered, but start no centroid unless nothing else is there. Repeated rows
    count each. A component of ``LARGEST / scale`` or more raises. Other columns are not
    read; no kept rows give no rows.
    """
    spark = embeddings.sparkSession
    vectors = written(integer_vectors(embeddings, dimensions, scale), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = vectors.orderBy(order.asc_nulls_last(), F.hex("components")).limit(clusters).select("components").collect()
    if not start:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    centroids = np.stack([np.frombuffer(bytes(r["components"]), "<i4") for r in start]).astype(np.int64)
    for _ in range(rounds):
        sums = (
            vectors.select("components")
            .mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
            .select("cluster", "n", F.posexplode("total").alias("at", "total"))
            .groupBy("cluster", "at")
            .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        )
        moved = centroids.copy()
        for r in sums.collect():
            moved[r["cluster"], r["at"]] = int(r["total"]) // int(r["n"])
        if np.array_equal(moved, centroids):
            break  # further rounds change nothing
        centroids = moved

    placed = written(vectors.mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long"), "assigned")
    inertia = {
        r["cluster"]: int(r["d"])
        for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    }
    facts = [
        (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c in inertia
    ]
    about = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row a cluster, a parameter of the call.
    return placed.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
