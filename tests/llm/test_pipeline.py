import pytest

import corpus_pipeline
from barlake.llm.common import row_numbers, table
from barlake.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F
from tests.conftest import SF_DIR


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, before = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= before and len(now) > 100
        before = now


def test_run_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    by_doc = rows.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert by_doc.where("n <> t").count() == 0 and by_doc.count() > 100


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("by", [[], ["k"]])
def test_row_numbers_have_no_gaps(spark, by):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"))
    rows = row_numbers(df, by, [F.col("id")], 5000, "n").groupBy(*by).agg(F.count("*").alias("c"), F.countDistinct("n").alias("d"), F.max("n").alias("m"), F.min("n").alias("l"))
    assert all(r["c"] == r["d"] == r["m"] + 1 and r["l"] == 0 for r in rows.collect())


def test_stages_equal_brute_force(spark):
    """What each stage keeps or changes, from plain loops over its own input."""
    from barlake.llm import decontaminate, secrets
    from tests.llm.test_decontaminate import brute_tiles
    from tests.llm.test_alike import brute_kept
    from tests.llm.test_secrets import brute

    docs = table(spark, SF_DIR, "documents")
    items = [r["text"] for r in table(spark, SF_DIR, "benchmark").select("text").collect()]
    split = lambda t: t.encode().lower().split()
    stages = dict(corpus_pipeline.STAGES)

    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in stages["near_copies"](spark, docs, SF_DIR).collect()}
    assert kept == brute_kept(list(rows.items()))

    seeds = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in enumerate(map(split, items))}
    leaks = set()
    for doc, text in rows.items():
        words = split(text)
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for i, item in enumerate(items):
            target = split(item)
            if own & seeds[i] and brute_tiles(words, target, 5) >= decontaminate.COVERAGE * len(target):
                leaks.add(doc)
    clean = {r["doc_id"] for r in stages["decontamination"](spark, docs, SF_DIR).collect()}
    assert leaks and clean == set(rows) - leaks

    hidden = {r["doc_id"]: r for r in stages["secrets"](spark, docs, SF_DIR).collect()}
    for doc, text in rows.items():
        if secrets.find_spans(text):
            assert not any(text[a:b] in hidden[doc]["text"] for a, _, b in brute(text))
            assert hidden[doc]["n_chars"] == len(hidden[doc]["text"])
        else:
            assert hidden[doc]["text"] == text
