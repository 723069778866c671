import base64
import gzip
import hashlib
import random
import time

import pytest

from barlake.functions.scratch import scratch_path
from barlake.llm import warc
from tests.llm.conftest import prose

SCHEMA = "page_id long, url string, html string, revisit string, refers_to string, kind string"


def brute(rows, least=0):
    first = {}
    for page, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            first[data] = max(page, first.get(data, page))
    out = []
    for page, html in rows:
        data = (html or "").encode()
        to = first.get(data) if len(data) >= least else None
        revisit = to is not None and to != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def pages():
    rows = [(i, f"<p>{prose(i % 5, 40)}</p>") for i in range(30)]
    rows += [(40, None), (41, ""), (42, None), (None, ""), (None, "<p>alone</p>"), (43, "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (43, "twice"), (43, "twice")]
    rows += [(50, prose(9, 60000)), (51, "\x1f\x8b\x08 ünï 日本\r\n\r\n")]
    return rows


@pytest.mark.parametrize("least, hot", [(0, 1e-3), (0, 0.5), (10, 1e-3)])
def test_round_trip_equals_plain_loops(spark, least, hot):
    rows = [(i, f"http://a.example/{i}\r\nX: 1", h, "x", "y", "z") for i, h in pages()]
    path = scratch_path(spark, "test-archives")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), path, least, hot, segment_bytes=2000, file_segments=2)
    read = warc.read_archives(spark, path, with_blocks=True).collect()
    assert {r["kind"] for r in read} == {"record"}
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in read]
    assert sorted(found, key=str) == brute(pages(), least)
    assert len({r["file"] for r in read}) > 3
    assert all("\r" not in r["uri"] and "\n" not in r["uri"] for r in read)
    texts = {r["page_id"]: bytes(r["block"]).partition(b"\r\n\r\n")[2].decode() for r in read if r["record_type"] == "response"}
    assert texts[50] == prose(9, 60000) and texts[51] == "\x1f\x8b\x08 ünï 日本\r\n\r\n"


def test_no_pages_and_missing_urls(spark):
    path = scratch_path(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_archives(spark, path).count() == 0
    path = scratch_path(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([(1, None, None, "", "", "")], SCHEMA), path)
    (row,) = warc.read_archives(spark, path).collect()
    assert (row["page_id"], row["payload_bytes"], row["uri"]) == (1, 0, "urn:none")


def members(n):
    return [warc.member(warc.record(i, f"http://a/{i}", prose(i, 20 + i).encode(), None, False)) for i in range(n)]


def ids(content):
    return [warc._page(f[4]["warc-record-id"]) for f in warc.scan(content) if f[0] == "record"]


def gaps(content):
    return [(f[1], f[2]) for f in warc.scan(content) if f[0] == "gap"]


def test_a_member_longer_than_a_length_field_shows_ends_with_zero():
    data = bytes(17 << 20)
    assert warc.member(data)[-1] == 0 and gzip.decompress(warc.member(data)) == data
    assert warc.member(b"x")[-1] == 0


@pytest.mark.parametrize("packed", [True, False])
def test_damage_costs_the_record_it_hits_and_gaps_are_exact(packed):
    parts = members(12) if packed else [gzip.decompress(m) for m in members(12)]
    starts = [sum(map(len, parts[:i])) for i in range(13)]
    whole = b"".join(parts)
    assert ids(whole) == list(range(12)) and gaps(whole) == []
    rng = random.Random(5)
    for _ in range(60):
        hit = rng.randrange(12)
        # No check covers the header lines of a plain record.
        head = 0 if packed else parts[hit].index(b"\r\n\r\n") + 4
        at = rng.randrange(starts[hit] + head, starts[hit + 1])
        bad = bytearray(whole)
        bad[at] ^= 1 << rng.randrange(8)
        found = ids(bytes(bad))
        # Bits of a gzip header or checksum may leave the record itself whole.
        assert [i for i in found if i != hit] == [i for i in range(12) if i != hit]
        if hit not in found:
            covered = gaps(bytes(bad))
            assert covered[0][0] == starts[hit] and covered[-1][1] == starts[hit + 1]
    for cut in (1, len(parts[-1]) // 2, len(parts[-1]) - 1):
        # Without its last byte a member still unpacks to a record that passes its own checks.
        assert ids(whole[:-cut]) == list(range(12 if packed and cut == 1 else 11))
        assert gaps(whole[:-cut]) == [(starts[11], len(whole) - cut)]
    junk = b"junk \x1f\x8b\x08 WARC/1.1\r\n more"
    mixed = junk + whole[: starts[5]] + junk + whole[starts[5] :] + junk
    assert ids(mixed) == list(range(12))
    n = len(junk)
    assert gaps(mixed) == [(0, n), (n + starts[5], 2 * n + starts[5]), (2 * n + len(whole), 3 * n + len(whole))]


def test_false_starts_inside_a_damaged_record_are_no_records():
    inner = b"WARC/1.1\r\nContent-Length: 999999\r\n\r\nshort"
    parts = [warc.record(i, "u", inner if i == 1 else b"ok", None, False) for i in range(3)]
    bad = b"".join(parts).replace(b"warc-type", b"warc-type")
    bad = bad[: len(parts[0]) + 3] + b"#" + bad[len(parts[0]) + 4 :]
    assert ids(bad) == [0, 2]


def test_many_records_in_one_member_and_a_whole_part_of_a_broken_one():
    plain = [gzip.decompress(m) for m in members(6)]
    one = gzip.compress(b"".join(plain))
    assert ids(one + one) == list(range(6)) * 2
    hurt = gzip.compress(b"".join(plain[:2]) + b"#" + b"".join(plain[2:]))
    assert ids(hurt) == list(range(6)) and len(gaps(hurt)) == 1
    big = gzip.compress(b"".join(warc.record(i, "u", random.Random(i).randbytes(90000), None, False) for i in range(6)))
    assert ids(big[: len(big) - 100000] + members(1)[0]) == [0, 1, 2, 3, 0]


def test_gap_rows(spark):
    parts = members(4)
    bad = parts[0] + b"#" * 10 + parts[2]
    path = scratch_path(spark, "test-archives")
    (
        spark.createDataFrame([(bytearray(bad[:-1]),)], "b binary").selectExpr("cast(b as string) AS value")
        .write.option("lineSep", "\0").text(path)
    )
    rows = {r["kind"]: r for r in warc.read_archives(spark, path).collect()}
    gap = rows["gap"]
    assert (gap["start"], gap["end"], gap["payload_bytes"]) == (len(parts[0]), len(parts[0]) + 10, 10)
    assert gap["reason"] == "no version line" and rows["record"]["page_id"] in (0, 2)


def test_many_version_lines_without_a_header_end_cost_linear_time():
    lines = b"WARC/1.1\r\nA: b\r\n" * 60_000
    whole = warc.record(7, "u", b"x", None, False)
    start = time.perf_counter()
    found = list(warc.scan(lines + whole))
    assert time.perf_counter() - start < 5
    assert ids(lines + whole) == [7] and gaps(lines + whole) == [(0, len(lines))]
    assert [f[0] for f in found] == ["gap", "record"]
