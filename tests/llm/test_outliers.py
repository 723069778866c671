import random
import re
from collections import Counter

import numpy as np
import pytest

from barlake.llm import outliers
from tests.llm.conftest import awkward_rows, prose


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = list(zip(words, words[1:], words[2:]))
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
        len(lines) - len(set(lines)), len(covered), len(re.findall("[A-Z]", text)),
    )


def test_counts_equal_brute_force():
    texts = [t for _, t, *_ in awkward_rows()] + ["a a a\na a a\n\n x|y <Z>\x0b\x1c é", "one two three one two three"]
    assert [tuple(r) for r in outliers.counts_of(texts)] == [brute_counts(t) for t in texts]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, prose(i, 100 + i % 50), "en", f"s{i % 3}") for i in range(900)]
    rows += [(2000 + i, " ".join(w + "###$$$" for w in prose(i, 90).split()), "en", "s0") for i in range(30)]
    rows += [(3000 + i, prose(i, 70), "de", f"t{i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    return outliers.judge(docs).toPandas()


def test_clean_documents_stay_and_symbol_junk_goes(judged):
    clean = judged[(judged["doc_id"] < 2000) & ~judged["base_failed"]]
    assert len(clean) > 800 and clean["kept"].all()
    assert not judged[judged["doc_id"].between(2000, 2999)]["kept"].any()
    assert judged[judged["doc_id"] >= 3000]["kept"].all()


def test_refit_is_the_mean_and_covariance_of_the_nearest_share():
    import pandas as pd

    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (4000, 5)) * [0.5, 0.3, 0.4, 0.6, 0.2] + 3
    d = ((x - 3) ** 2).sum(axis=1)
    bins = pd.DataFrame({"grp": "g", "bin": np.minimum(255, np.floor(np.log2(1 + 16 * d) * 16)).astype(int), "n": 1})
    for i in range(5):
        bins[f"s{i}"] = x[:, i]
        for j in range(i, 5):
            bins[f"s{i}{j}"] = x[:, i] * x[:, j]
    got = outliers._refit(bins.groupby(["grp", "bin"], as_index=False).sum()).iloc[0]
    cut = np.sort(bins["bin"])[int(np.ceil(0.75 * 4000)) - 1]
    inside = x[bins["bin"] <= cut]
    cov = np.cov(inside.T, bias=True) * outliers.CONSISTENT
    cov += np.diag(np.maximum(np.square(outliers.FLOORS) - np.diag(cov), 0)) + 1e-9 * np.eye(5)
    want = np.linalg.inv(cov)
    assert np.allclose([got[f"m{i}"] for i in range(5)], inside.mean(axis=0))
    assert np.allclose([got[f"w{i}{j}"] for i in range(5) for j in range(i, 5)], want[np.triu_indices(5)])


def test_odd_tables(clashing, empty):
    rows = {(r["doc_id"], r["n_words"], r["base_failed"], r["kept"]) for r in outliers.judge(clashing).collect()}
    assert (1, 0, True, False) in rows and (2, 0, True, False) in rows and (3, 0, True, False) in rows
    assert any(r[0] is None and not r[2] for r in rows)
    assert outliers.judge(clashing).count() == len(awkward_rows())
    assert outliers.judge(empty).count() == 0


def test_words_parted_by_bars_go(spark):
    """Symbol junk that lies beyond the 0.999 quantile, but within 41."""
    rows = [(i, prose(i, 100 + i % 50), "en", "a") for i in range(400)]
    rows += [(2000 + i, re.sub(r"((?:\S+\s+){2})", r"\1| ", prose(i, 90)), "en", "a") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = outliers.judge(docs).toPandas()
    bars = found[(found["doc_id"] >= 2000) & ~found["base_failed"]]
    assert len(bars) and bars["distance"].min() < 41 and not bars["kept"].any()


def settled(x, steps=outliers.STEPS):
    """Squared distances by a plain version of the estimate, from both starts."""
    ends = []
    for start in ("robust", "plain"):
        if start == "robust":
            low, mid, high = np.quantile(x, [0.25, 0.5, 0.75], axis=0, method="inverted_cdf")
            mean, precision = mid, np.diag(1 / np.maximum((high - low) / 1.349, outliers.FLOORS) ** 2)
        else:
            mean, precision = np.zeros(5), np.zeros((5, 5))
        det = 0.0
        for _ in range(steps):
            d = np.maximum(np.einsum("ij,jk,ik->i", x - mean, precision, x - mean), 0)
            at = np.minimum(np.floor(np.log2(1 + 16 * d) * 16), 255)
            inside = x[at <= np.sort(at)[int(np.ceil(0.75 * len(x))) - 1]]
            cov = np.cov(inside.T, bias=True) * outliers.CONSISTENT
            cov += np.diag(np.maximum(np.square(outliers.FLOORS) - np.diag(cov), 0)) + 1e-9 * np.eye(5)
            before, mean = (mean, det), inside.mean(axis=0)
            precision, det = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
            if max(abs(det - before[1]), *(np.abs(mean - before[0]) / outliers.FLOORS)) <= outliers.STILL:
                break
        ends.append((det, start == "plain", mean, precision))
    _, _, mean, precision = min(ends, key=lambda e: e[:2])
    return np.maximum(np.einsum("ij,jk,ik->i", x - mean, precision, x - mean), 0)


def test_distances_equal_a_plain_estimate_of_each_group(spark):
    """Groups of 60 rows have estimates of their own; one of 20 shares that of its language's small ones."""
    rng = random.Random(3)

    def text(i, loud):
        words = prose(i, 70 + i % 60).split()
        return " ".join(w.upper() if rng.random() < loud else w for w in words)

    sizes = {("en", "a"): (60, 0.0), ("en", "b"): (80, 0.5), ("de", "a"): (20, 0.1), ("de", None): (40, 0.1)}
    rows, group = [], []
    for (lang, source), (n, loud) in sizes.items():
        for _ in range(n):
            rows.append((len(rows), text(len(rows), loud), lang, source))
            group.append((lang, source) if n >= 50 else lang)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    found = outliers.judge(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    c = found[list(outliers.COUNTS)].astype(float)
    x = np.stack([
        np.log(c["word_chars"] / c["n_words"]), np.sqrt(c["n_symbols"] / c["word_chars"]), np.sqrt(c["n_dup_lines"] / c["n_lines"]),
        np.sqrt(c["n_repeat_words"] / c["n_words"]), np.sqrt(c["n_capitals"] / c["word_chars"]),
    ], axis=1)
    assert not found["base_failed"].any()
    for name in set(group):
        mine = np.array([g == name for g in group])
        np.testing.assert_allclose(found["distance"][mine], settled(x[mine]), rtol=1e-4, atol=1e-4)
