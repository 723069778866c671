import hashlib

import numpy as np
import pytest

from barlake.llm import suffix_dedup as s
from tests.llm.conftest import SCHEMA, awkward_rows, prose


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, hash of the rest) with all windows in a dictionary."""
    last = float("inf")
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - s.WINDOW + 1):
            w = b[p : p + s.WINDOW]
            first[w] = min(first.get(w, last), last if i is None else i)
    out = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - s.WINDOW + 1):
            if first[b[p : p + s.WINDOW]] < (last if i is None else i):
                gone[p : p + s.WINDOW] = b"\1" * s.WINDOW
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(docs):
    rows = s.remove_repeats(docs).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows), key=str)


def test_awkward_documents(awkward, clashing):
    assert got(awkward) == got(clashing) == brute(awkward_rows())


def repeated_rows():
    passage = prose(90, 40)
    rows = [(i, prose(100 + i, 20) + passage[i % 7 :] + prose(200 + i, 20), "en", "a", 1) for i in range(40)]
    rows += [(50 + i, "ab" * (20 + i) + "x" * 70, "en", "a", 1) for i in range(8)]
    return rows + [(60, passage[:49], "en", "a", 1), (61, passage[:50], "en", "a", 1)]


@pytest.mark.parametrize("hot, chunk", [(4096, 4 << 20), (2, 600), (4096, 600), (2, 4 << 20)])
def test_common_passages_and_periods_in_one_or_many_chunks(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(s, "HOT_RUNS", hot)
    monkeypatch.setattr(s, "CHUNK_BYTES", chunk)
    rows = repeated_rows()
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_empty_table(empty):
    assert got(empty) == []


def test_parts_of_many():
    import time

    digits = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 5000).astype(np.uint64))
    for parts in (1, 7, 10**7):
        began = time.perf_counter()
        found = s._parts(digits, parts)
        assert time.perf_counter() - began < 1
        for part, (a, b) in found.items():
            assert all(int(d) * parts >> 48 == part for d in digits[a:b])
        assert sum(b - a for a, b in found.values()) == len(digits)
    assert s._parts(digits[:0], 5) == {}


def test_no_table_stays_in_the_catalogue(spark, awkward):
    before = {t.name for t in spark.catalog.listTables()}
    assert s.remove_repeats(awkward).count() == awkward.count()
    assert {t.name for t in spark.catalog.listTables()} == before
