import hashlib
import math
import random

import numpy as np
import pytest

from barlake.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance string, n string"


def brute(rows, clusters, rounds, dimensions, seed=centroids.SEED):
    """{vec_id: cluster, distance} and the centroids, by plain loops over exact integers."""
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    places = [v for _, v in first[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(places)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for c in range(len(places)):
            own = [v for (_, v), (_, at) in zip(kept, found) if at == c]
            if own:
                places[c] = [sum(x) // len(own) for x in zip(*own)]
    return sorted((i, c, d) for (i, _), (d, c) in zip(kept, assign())), places


def rows_of(seed, n, dimensions=4):
    rng = random.Random(seed)
    # A coarse grid: many ties, repeated vectors and empty clusters.
    return [(i, [rng.randint(-3, 3) / 4 for _ in range(dimensions)]) for i in range(n)]


@pytest.mark.parametrize("n, clusters", [(150, 8), (60, 20), (5, 8)])
def test_clusters_equal_plain_loops(spark, n, clusters):
    rows = rows_of(n, n)
    odd = [(900, None), (901, [1.0, 2.0]), (902, [1.0, None, 0.0, 0.0]), (903, [1.0, float("nan"), 0.0, 0.0]), (904, [float("inf")] * 4)]
    given = [(i, v, 0, "x", "y", "z") for i, v in rows + odd]
    found = centroids.cluster_vectors(
        spark.createDataFrame(given, SCHEMA).repartition(3), clusters=clusters, rounds=4, dimensions=4
    ).collect()
    want, places = brute(rows + odd, clusters, 4, 4)
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in found) == want
    for r in found:
        assert r["inertia"] == sum(d for _, _, d in want)
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        text = ",".join(map(str, places[r["cluster"]]))
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_search_finds_the_nearest_and_leaves_most_out():
    rng = np.random.default_rng(1)
    middles = rng.integers(-1000, 1000, (200, 6))
    vectors = middles[rng.integers(0, 200, 3000)] + rng.integers(-20, 20, (3000, 6))
    cluster, distance = centroids.nearest(vectors, middles, centroids.neighbour_lists(middles))
    gaps = ((vectors[:, None, :] - middles[None]) ** 2).sum(axis=2)
    assert (cluster == gaps.argmin(axis=1)).all() and (distance == gaps.min(axis=1)).all()


def test_equal_centroids_and_vectors_between_two(spark):
    middles = np.array([[0, 0], [0, 0], [2, 0], [-2, 0]])
    vectors = np.array([[0, 0], [1, 0], [-1, 0], [5, 0]])
    cluster, distance = centroids.nearest(vectors, middles, centroids.neighbour_lists(middles))
    assert cluster.tolist() == [0, 0, 0, 2] and distance.tolist() == [0, 1, 1, 9]


def test_no_rows_missing_ids_and_too_large_components(spark):
    assert centroids.cluster_vectors(spark.createDataFrame([], SCHEMA), dimensions=4).count() == 0
    rows = [(None, [0.0, 1.0], 0, "", "", ""), (7, [0.5, 0.5], 0, "", "", ""), (7, [0.5, 0.5], 0, "", "", "")]
    found = centroids.cluster_vectors(spark.createDataFrame(rows, SCHEMA), clusters=2, dimensions=2).collect()
    # Both start at the rows of id 7; the first takes all three and moves off, so these go to the second.
    assert sorted((r["vec_id"] or 0, r["cluster"]) for r in found) == [(0, 0), (7, 1), (7, 1)]
    with pytest.raises(Exception, match="do not fit"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e9, 0.0], 0, "", "", "")], SCHEMA), dimensions=2)
