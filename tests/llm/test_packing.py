import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from barlake.llm import packing
from tests.llm.conftest import awkward_rows, prose


@pytest.fixture(scope="module")
def ids_of():
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID]


def test_word_by_word_ids_equal_those_of_the_whole_text(ids_of):
    texts = [t for _, t, *_ in awkward_rows()] + ["a\t b\r\nc d don't  <|endoftext|> x̂ ΣΑΣ é é  ", "  "]
    for cache_words in (packing.CACHE_WORDS, 5):
        encoder = packing.Encoder(packing.tokenizer_path(), cache_words=cache_words)
        for text, got in zip(texts, encoder.encode(texts)):
            assert np.frombuffer(got, "<u4").tolist() == ids_of(text)


def test_every_token_lies_in_one_piece_and_sequences_fit(awkward, clashing, ids_of):
    for docs in (awkward, clashing):
        rows = packing.pack(docs, sequence=256).collect()
        texts = {}
        for i, t, *_ in awkward_rows():
            texts.setdefault(i, []).append(ids_of(t))
        for doc_id, found in texts.items():
            own = sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["start"])
            ids = found[0]
            assert len({r["doc_tokens"] for r in own}) == 1 and own[0]["doc_tokens"] == len(ids)
            assert sum(r["length"] for r in own) == len(ids) * len(found)
            for r in own:
                piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()
                assert zlib.crc32(piece) == r["ids_crc32"]
        held = {}
        for r in rows:
            held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for pieces in held.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
            assert end <= 256
        assert sorted(held) == list(range(len(held)))


def test_empty_table(empty):
    assert packing.pack(empty).count() == 0


def test_plans_cover_the_demand_and_are_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(4, 0.8, 20000), 1, 512).astype(int)
    histogram = dict(zip(*[a.tolist() for a in np.unique(lengths, return_counts=True)]))
    plan = packing.plan_sequences(histogram, 512)
    packed = {}
    for copies, pattern in plan:
        assert copies > 0 and sum(s * n for s, n in pattern.items()) <= 512
        for s, n in pattern.items():
            packed[s] = packed.get(s, 0) + copies * n
    assert packed == histogram
    assert sum(c for c, _ in plan) <= 1.01 * lengths.sum() / 512 + 1


def test_program_equals_a_known_optimum():
    # Capacity 10: six 4s with six 6s fill six sequences, nothing else does better.
    assert packing.plan_sequences({4: 6, 6: 6}, 10) == [(6, {4: 1, 6: 1})]
    assert packing.plan_sequences({}, 10) == []


def test_token_arrays(spark, ids_of):
    docs = spark.createDataFrame([(i, prose(i, 60)) for i in range(12)], "doc_id long, text string")
    packed = packing.pack(docs, sequence=256)
    made = packing.sequences(docs, packed, sequence=256).collect()
    total = sum(len(ids_of(prose(i, 60))) for i in range(12))
    assert sum(1 for r in made for x in r["ids"] if x != 0) == total
    assert all(len(r["ids"]) == 256 or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in made)


def test_assignment_equals_plain_queues(spark):
    """Pieces wait in a queue a class, by hashed part, doc_id and start; copies of patterns take the next ones."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, prose(i, 5 + i * 37 % 300)) for i in range(150)], "doc_id long, text string")
    part = F.pmod(F.xxhash64("doc_id", "doc_key", "start"), F.lit(64)).alias("part")
    rows = packing.pack(docs, sequence=256, class_tokens=8).select("*", part).collect()
    queues = {}
    for r in sorted(rows, key=lambda r: (r["part"], r["doc_id"], r["start"])):
        queues.setdefault(-(-r["length"] // 8), []).append((r["doc_id"], r["start"], r["length"]))
    plan = packing.plan_sequences({c: len(q) for c, q in queues.items()}, 256 // 8)
    want, sequence = {}, 0
    for copies, pattern in plan:
        for _ in range(copies):
            offset = 0
            for size in sorted(pattern, reverse=True):
                for _ in range(pattern[size]):
                    doc_id, start, length = queues[size].pop(0)
                    want[doc_id, start] = (sequence, offset)
                    offset += length
            sequence += 1
    assert not any(queues.values())
    assert {(r["doc_id"], r["start"]): (r["sequence_id"], r["offset"]) for r in rows} == want
