import math
import re
from collections import Counter

import numpy as np
import pytest

from barlake.llm import quality
from tests.llm.conftest import awkward_rows, prose

LABELS = "doc_id long, quality int, toxic int"


def junk(seed, words):
    return " ".join(w + ("###", "&&&", "$$$")[i % 3] for i, w in enumerate(prose(seed, words).split()))


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, prose(i, 80) if i % 3 else junk(i, 80)) for i in range(900)]
    labels = [(i, int(i % 3 > 0), None) for i in range(900)] + [(5, None, 0), (None, 1, 0), (10_000, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy_and_range(mixed):
    rows = quality.score_quality(*mixed).toPandas()
    truth = (rows["doc_id"] % 3 > 0).astype(int)
    apart = rows["held_out"]
    assert apart.sum() > 150 and (rows["predicted"] == truth)[apart].mean() >= 0.98
    assert rows["score"].between(0, 1).all()
    assert ((rows["score"] >= 0.7).astype(int) == rows["predicted"]).all()


def test_held_out_labels_do_not_matter(mixed):
    from pyspark.sql import functions as F

    docs, labels = mixed
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.score_quality(docs, labels).orderBy("doc_id").toPandas()["score"]
    b = quality.score_quality(docs, flipped).orderBy("doc_id").toPandas()["score"]
    assert np.array_equal(a, b)


def test_vectors_equal_a_plain_count(spark):
    texts = ["ab CD12 ab ## zz", "zz ab", None, "", "ab"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    words, dim = 64, 16
    index = quality.index_vectors(words, dim)
    want = np.zeros((words, dim))
    for t in texts:
        found = quality.Words([(t or "").encode()], words).bucket.tolist()
        for i, a in enumerate(found):
            for j, b in enumerate(found):
                if 0 < abs(i - j) <= quality.REACH:
                    want[a] += index[b]
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    want = np.divide(want, norm, out=np.zeros_like(want), where=norm > 0)
    assert np.allclose(quality.word_vectors(docs, words, dim), want, atol=1e-6)


def plain_row(text, vectors):
    """Mean and spread of the vectors of a text's words, then the shares of its counts, by loops."""
    words = len(vectors)
    runs = re.findall(rb"[a-z\x80-\xff]+|[A-Z]+|[0-9]+|[^\x00-\x20a-zA-Z0-9\x80-\xff]+", (text or "").encode())
    n = max(len(runs), 1)
    buckets = quality.Words([b" ".join(runs)], words).bucket.tolist()
    assert len(buckets) == len(runs)
    rows = [vectors[b].astype(float) for b in buckets] or [np.zeros(vectors.shape[1])]
    mean = np.sum(rows, axis=0) / n
    spread = np.sqrt(np.maximum(np.sum(np.square(rows), axis=0) / n - mean**2, 0))
    first = [r[:1] for r in runs]
    small = sum(c.islower() or c >= b"\x80" for c in first)
    capital, digits = sum(c.isupper() for c in first), sum(c.isdigit() for c in first)
    kinds = [small, capital, digits, len(runs) - small - capital - digits]
    distinct, most = len(set(runs)), max(Counter(buckets).values(), default=0)
    again = sum(a == b for a, b in zip(runs, runs[1:]))
    shares = [*[k / n for k in kinds], distinct / n, most / n, math.log1p(n), math.sqrt(distinct) / n, again / n]
    return np.concatenate([mean, spread, shares])


def test_pooled_rows_equal_plain_loops():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(64, 8)).astype(np.float32)
    texts = [None, "", "  ", "ab ab AB12 ## é", "one two two\nTHREE 33 33 !!", *[junk(i, 9) for i in range(280)]]
    for row, text in zip(quality.pooled(texts, vectors), texts):
        np.testing.assert_allclose(row, plain_row(text, vectors), atol=2e-5)


def test_network_equals_plain_loops_and_its_temperature_is_the_best():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(int)
    network = quality.Network(x, y)
    w1, b1, w2, b2 = network.layers
    scaled = [[min(max((v - m) / s, -8), 8) for v, m, s in zip(r, network.middle, network.scale)] for r in x[:50]]
    for row, found in zip(scaled, network.probability(x[:50])):
        hidden = [math.tanh(sum(v * w1[i, j] for i, v in enumerate(row)) + b1[j]) for j in range(quality.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, w2)) + b2[0]
        assert found == pytest.approx(1 / (1 + math.exp(-logit / network.temperature)), abs=1e-4)
    apart = np.random.default_rng(42).permutation(400)[:80]
    logits = network.logits(x[apart])

    def loss(t):
        return np.mean([math.log1p(math.exp(-(1 if c else -1) * z / t)) for z, c in zip(logits, y[apart])])

    assert loss(network.temperature) <= min(loss(t) for t in np.geomspace(0.5, 8, 60)) + 1e-9


def test_odd_tables(clashing, empty, spark):
    labels = spark.createDataFrame([], LABELS)
    rows = quality.score_quality(clashing, labels).collect()
    assert len(rows) == len(awkward_rows()) and {r["score"] for r in rows} == {1.0}
    one = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (7, 1, 1)], LABELS)
    assert len({r["score"] for r in quality.score_quality(clashing, one).collect()}) == 1
    assert quality.score_quality(empty, one).count() == 0
    kept = quality.keep_good(clashing, labels)
    assert kept.columns == clashing.columns and kept.count() == len(rows)
