import random
import re

import xxhash

from barlake.llm import graph, simhash
from tests.llm.conftest import awkward_rows, prose


def brute_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(rows):
    """Least doc_id reachable, by comparing all pairs."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            # Signed prints: only the low 64 bits count.
            if bin((rows[i][1] ^ rows[j][1]) & simhash._ALL).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def test_fingerprints_equal_brute_force():
    for text in [t for _, t, *_ in awkward_rows()] + ["ONE Two", "a b c", "É A é\x0bz\x1cq"]:
        assert simhash.fingerprint(text) & simhash._ALL == brute_print(text)


def test_native_hash_is_the_same(spark):
    got = spark.sql("SELECT xxhash64('a b c') AS h").first()["h"]
    assert got & simhash._ALL == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_keys_miss_no_pair():
    """Any 1 to 3 differing bits leave a key whose bits agree and whose chain holds."""
    rng = random.Random(3)
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(
            not diff & mask
            and all(
                bin(sum(diff & (255 << 8 * ((start + i) % 8)) for i in range(n + 1))).count("1") <= simhash.BUDGETS[n]
                for n in range(8)
            )
            for start, mask in simhash.first_masks()
        )


def clustered(seed, centres, members, flips):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        x = rng.getrandbits(64)
        for _ in range(members):
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips)))
            out.add(simhash.signed(x))
    return sorted(out)


def test_classes_equal_brute_force_also_when_groups_are_cut(spark):
    prints = clustered(5, 12, 25, 3)
    df = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(4)
    want = brute_components(list(enumerate(prints)))
    for group_rows in (2048, 3):
        rows = simhash.near_classes(df, group_rows).collect()
        by_root = {}
        for r in rows:
            by_root.setdefault(r["root"], set()).add(prints.index(r["fp"]))
        got = sorted(((i, min(s)) for s in by_root.values() for i in s), key=str)
        assert got == want


def test_table(awkward, clashing, empty):
    rows = [(i, brute_print(t)) for i, t, *_ in awkward_rows()]
    for docs in (awkward, clashing):
        found = simhash.near_duplicates(docs)
        assert sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=str) == brute_components(rows)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_class_stays(clashing, empty):
    kept = simhash.keep_one(clashing)
    assert kept.columns == clashing.columns
    # 1, 2, 3 have no words; 4 (twice), 5 and 6 are near copies.
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 4, 7, 8, None, 9, 10], key=str)
    assert simhash.keep_one(empty).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}
    assert graph.components(df.limit(0)).count() == 0


def test_prose_is_not_a_near_copy():
    a, b = simhash.fingerprint(prose(10, 200)), simhash.fingerprint(prose(11, 200))
    assert bin((a ^ b) & simhash._ALL).count("1") > 3
