import random

import numpy as np

from barlake.llm import decontaminate as d
from tests.llm.conftest import awkward_rows, prose

ITEMS = "item_id long, text string"


def brute_tiles(doc, item, least):
    """Greedy string tiling by comparing all positions."""
    free_doc, free_item = [True] * len(doc), [True] * len(item)
    covered = 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                    and free_item[i + n] and free_doc[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        for k in range(n):
            free_item[i + k] = free_doc[j + k] = False
        covered += n


def test_tiles_equal_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        item = [rng.choice("abc") for _ in range(rng.randint(3, 25))]
        doc = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        code = lambda words: d.word_hashes(" ".join(words))
        tiles = d.tile(code(doc), code(item), 3)
        assert sum(n for *_, n in tiles) == brute_tiles(doc, item, 3)
        marked = np.zeros(len(doc), int)
        for j, i, n in tiles:
            assert doc[j : j + n] == item[i : i + n]
            marked[j : j + n] += 1
        assert (marked <= 1).all()


def planted(spark):
    item = prose(50, 40).replace("\n", " ")
    words = item.split()
    reordered = " ".join(words[20:] + ["filler"] * 7 + words[:20])
    half = " ".join(words[:12])
    rows = [
        (100, prose(51, 300) + " " + item + " " + prose(52, 300), "en", "a", 1),
        (101, prose(53, 50) + " " + reordered.upper(), "en", "a", 1),
        (102, prose(54, 50) + " " + half, "en", "a", 1),
        (103, prose(55, 500), "en", "a", 1),
    ]
    docs = spark.createDataFrame(rows + awkward_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, prose(60, 30))], ITEMS)
    return docs, bench


def test_passages_are_found_in_any_order_and_clean_documents_stay(spark):
    docs, bench = planted(spark)
    found = {(r["doc_id"], r["item_id"]): r["coverage"] for r in d.find_leaks(docs, bench).collect()}
    assert found == {(100, 1): 1.0, (101, 1): 1.0}
    in_blocks = d.find_leaks(docs, bench, block_words=1).collect()
    assert {(r["doc_id"], r["item_id"]) for r in in_blocks} == set(found)
    kept = d.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 2 and kept.where("doc_id IN (100, 101)").count() == 0


def test_odd_tables(clashing, empty, spark):
    bench = spark.createDataFrame([(1, prose(2, 120)), (None, prose(4, 60))], ITEMS)
    found = sorted((str(r["doc_id"]), str(r["item_id"])) for r in d.find_leaks(clashing, bench).collect())
    assert found == [("4", "1"), ("4", "1"), ("5", "1"), ("6", "1"), ("None", "None")]
    assert d.find_leaks(empty, bench).count() == 0
    assert d.find_leaks(clashing, bench.limit(0)).count() == 0
    assert d.drop_leaks(clashing, bench.limit(0)).count() == len(awkward_rows())


def test_short_items_and_several_blocks(spark):
    items = [(1, "Hello there"), (2, "one"), (3, "four words stand here"), (4, " ".join(f"w{i}" for i in range(12))), (5, None), (6, "there world")]
    docs = [(1, "he said hello THERE world"), (2, "one two"), (3, "hello"), (4, "four words stand"), (5, "x four words stand here y"),
            (6, " ".join(f"w{i}" for i in range(3, 12))), (7, "hello"), (8, "there")]
    items = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    want = {(1, 1, 2, 2), (1, 6, 2, 2), (5, 3, 4, 4), (6, 4, 9, 12)}
    for block_words in (1_000_000, 5, 1):
        found = d.find_leaks(docs, items, block_words=block_words).collect()
        assert {(r["doc_id"], r["item_id"], r["covered_words"], r["item_words"]) for r in found} == want and len(found) == 4
        kept = d.drop_leaks(docs, items, block_words=block_words)
        assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 7, 8]
