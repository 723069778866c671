import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm import alike
from barlake.llm.common import table
from barlake.llm.simhash import fingerprint
from tests.conftest import SF_DIR
from tests.llm.conftest import prose


def brute_kept(rows):
    """Least doc_id of every class, by exact similarities of all pairs."""

    def cut(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    rows = sorted(rows)
    sets, root = [cut(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if root[i] != root[j] and (len(a & b) >= 0.8 * len(a | b)):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {rows[r][0] for r in root}


def edited(text, seed, changes):
    words = text.split()
    for at in random.Random(seed).sample(range(len(words)), changes):
        words[at] = f"x{seed}"
    return " ".join(words)


def test_stage_keeps_what_brute_force_jaccard_keeps(spark):
    docs = table(spark, SF_DIR, "documents")
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    want = brute_kept([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["doc_id"] for r in stage(spark, docs, SF_DIR).collect()} == want


def test_copies_around_the_similarity_and_parts_of_buckets(spark):
    """Edits of each other's neighbours: classes that only links between edits join, too."""
    rows = []
    for base in range(12):
        text = prose(base, 200)
        for k in range(8):
            rows.append((len(rows), edited(text, len(rows), k)))
            if k % 3 == 2:
                text = rows[-1][1]
    rows += [(len(rows), "a b"), (len(rows) + 1, "A  b"), (len(rows) + 2, None), (len(rows) + 3, " ")]
    want = brute_kept(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert 14 < len(want) < 80
    for part_rows in (2048, 2):
        assert {r["doc_id"] for r in alike.keep_one(docs, part_rows=part_rows).collect()} == want


def test_close_fingerprints_are_candidates_without_a_common_bucket(spark, monkeypatch):
    """Sets that share no MinHash bucket: the pigeonring search finds them, the exact test judges them."""
    monkeypatch.setattr(alike, "band_keys", lambda found: found[:0].view(np.int64))
    text = prose(5, 600)
    near = next(e for e in (edited(text, seed, 1) for seed in range(99)) if (fingerprint(text, 5) ^ fingerprint(e, 5)).bit_count() <= 3)
    docs = spark.createDataFrame([(1, text), (2, near), (3, prose(6, 600))], "doc_id long, text string")
    assert {r["doc_id"] for r in alike.keep_one(docs).collect()} == {1, 3}
    assert {r["doc_id"] for r in alike.keep_one(docs, similarity=0.9999).collect()} == {1, 2, 3}


def test_one_of_each_class_stays(clashing, empty):
    kept = alike.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 4, 7, 8, None, 9, 10], key=str)
    assert alike.keep_one(empty).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_spanning_links_join_what_all_pairs_join(seed):
    rng = np.random.default_rng(seed)
    base = rng.choice(10_000, 40, replace=False)
    sets, classes = [], []
    for i in range(70):
        own = np.concatenate([base[rng.random(40) < 0.93], rng.choice(10_000, rng.integers(0, 9)) + 10_000])
        sets.append(np.unique(own).astype(np.uint64))
        classes.append(int(rng.integers(0, 60)) if seed % 2 else i)
    root = {i: i for i in range(70)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    def join(pairs):
        for i, j in pairs:
            root[find(i)] = find(j)
        return [find(i) for i in range(70)]

    def same(labels):
        return [[a == b for b in labels] for a in labels]

    known = [(i, j) for i in range(70) for j in range(i) if classes[i] == classes[j]]
    links = alike.spanning_links(np.array(classes), sets, 0.8)
    mine = same(join(known + links))
    root.update({i: i for i in range(70)})
    near = [(i, j) for i in range(70) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) / len(np.union1d(sets[i], sets[j])) >= 0.8]
    assert same(join(known + near)) == mine and len(links) < 70 <= len(near)


def test_alike_groups_below_the_similarity_lose_no_link(spark):
    """One bucket of many parts: mostly far apart, some linked."""
    rng = np.random.default_rng(3)
    sets = {}
    for i in range(60):
        sets[i] = np.unique(np.concatenate([np.arange(70), 1000 * (i + 1) + np.arange(30)])).astype(np.uint64)
        sets[100 + i] = sets[i][rng.random(100) < 0.95]
    rows = [(i, len(s), [7] + [1000 + i] * 23) for i, s in sets.items()]
    first = spark.createDataFrame(rows, "set_id long, n_shingles long, bands array<long>")
    table_of = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "set_id long, shingles binary")
    for part_rows in (2048, 8):
        links = alike.near_links(first, lambda ids: table_of.join(ids, "set_id", "left_semi"), part_rows=part_rows).collect()
        joined = {frozenset((r["a"], r["b"])) for r in links}
        assert joined == {frozenset((i, 100 + i)) for i in range(60)}


def test_survivor_does_not_depend_on_partitions_and_names_may_clash(spark):
    rows = [(1, "a b c d e f", k, f"x{k}") for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row int, __id string")
    left = {tuple(alike.keep_one(docs.repartition(n)).first()) for n in (1, 3, 5)}
    assert len(left) == 1
    odd = docs.withColumn("m", F.create_map(F.lit("k"), F.lit("v")))
    assert alike.keep_one(odd).columns == odd.columns
