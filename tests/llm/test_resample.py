import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from barlake.llm import resample
from tests.llm.conftest import prose


def brute(docs, target, buckets, grams, least_words, share):
    def cut(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]
        return words, [zlib.crc32(r.encode()) % buckets for r in runs]

    s, t = [0] * buckets, [0] * buckets
    for into, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in cut(text)[1]:
                into[b] += 1
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)
    ]
    out = []
    for doc, text in docs:
        words, found = cut(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(words), len(found), weight, score, None])
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: share * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(str, out))


def found_of(df):
    columns = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    return sorted(str([r[c] for c in columns]) for r in df.collect())


@pytest.mark.parametrize("grams, buckets, share", [(1, 10_000, 10), (2, 97, 50), (3, 64, 100)])
def test_rows_equal_plain_loops(spark, awkward, grams, buckets, share):
    more = [(100 + i, prose(50 + i, 15 + i)) for i in range(40)]
    docs = awkward.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    target = spark.createDataFrame([(prose(60, 30),), (None,), ("ÜBER 12 the The",)], "text string")
    found = resample.resample(docs.repartition(4), target, buckets=buckets, grams=grams, share=share)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found_of(found) == brute(rows, [r["text"] for r in target.collect()], buckets, grams, 20, share)


def test_empty_tables_and_clashing_columns(spark, clashing, empty):
    assert resample.resample(empty, empty).count() == 0
    found = resample.resample(clashing, empty)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert found.count() == clashing.count()


def test_planes_give_exact_sums():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 3, (20, 300)) * rng.integers(0, 1 << 20, (20, 300))
    gains = rng.integers(-9000, 12000, 300)
    assert (resample.weighted_sums(counts, resample.gain_planes(gains)) == counts @ gains).all()
    assert (resample.weighted_sums(counts, resample.gain_planes(np.zeros(300, np.int64))) == 0).all()
    least = np.full(300, -(1 << 12))
    assert (resample.weighted_sums(counts, resample.gain_planes(least)) == counts @ least).all()
