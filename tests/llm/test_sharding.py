import zlib

import numpy as np
import pytest

from barlake.llm import sharding
from tests.llm.conftest import awkward_rows


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permutation_is_a_bijection_and_inverts(n):
    p = sharding.Permutation(n, key=7)
    out = p.apply(np.arange(n))
    assert sorted(out.tolist()) == list(range(n))
    assert p.invert(out).tolist() == list(range(n))


def test_permutation_of_a_huge_range_inverts():
    p = sharding.Permutation(10**15 + 7)
    rows = np.array([0, 1, 999, 10**14, 10**15 + 6])
    assert p.invert(p.apply(rows)).tolist() == rows.tolist()


def test_shards_differ_by_one_row_and_slots_have_no_gaps(awkward):
    rows = sharding.assign_shards(awkward, 5).collect()
    assert len(rows) == len(awkward_rows())
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert (r["shard"], r["slot"]) == sharding.locate(r["row_number"], len(rows), 5)
        assert sharding.row_at(r["shard"], r["slot"], len(rows), 5) == r["row_number"]
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(by_shard.get(i, [])) for i in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_sizes_and_checksums(awkward):
    got = {(r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.assign_shards(awkward, 3).collect()}
    want = {
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in awkward_rows()
    }
    assert got == want


def test_same_places_whatever_the_partitions(awkward, clashing):
    a = sharding.assign_shards(awkward.repartition(1), 4)
    b = sharding.assign_shards(clashing.repartition(7), 4)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_empty_table(empty):
    assert sharding.assign_shards(empty, 4).count() == 0


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = spark.range(100).selectExpr("id AS doc_id", "concat('t', id) AS text")
    sharding.write_shards(docs, 4, str(tmp_path / "s"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 100 and back.select("doc_id").distinct().count() == 100
    assert {r["count"] for r in back.groupBy("shard").count().collect()} == {25}
