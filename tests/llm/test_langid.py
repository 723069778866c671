import math
from collections import Counter

import numpy as np
import pytest

from barlake.llm import langid
from tests.llm.conftest import awkward_rows, prose


def test_codes_keep_languages_apart():
    for n in (1, 2, 3, 5, 6, 9):
        code = langid.code_of(n)
        assert code.shape[0] == n
        for i in range(n):
            for j in range(i):
                assert (code[i] != code[j]).sum() >= max(1, code.shape[1] // 4)


def plain_features(text):
    """Counts of hashed runs of 1 to 3 bytes that hold a letter and no two gaps in a row."""
    kept = [b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").lower().encode()]
    data, counts = [32, *kept, 32], Counter()
    for n in langid.GRAMS:
        for at in range(len(data) - n + 1):
            gram = data[at : at + n]
            if set(gram) == {32} or any(a == b == 32 for a, b in zip(gram, gram[1:])):
                continue
            h = n
            for b in gram:
                h = (h ^ b) * 0x01000193 % 2**32
            counts[(h ^ (h >> 15)) % langid.BUCKETS] += 1
    row = np.zeros(langid.BUCKETS)
    for bucket, n in counts.items():
        row[bucket] = math.sqrt(n)
    return row / max(np.linalg.norm(row), 1e-9)


def test_features_equal_plain_counts():
    texts = [r[1] for r in awkward_rows()] + ["a", "  ab  cd ", "Grüße, 12 x!", "日本語 text", prose(3, 700)]
    texts += [prose(i, 3) for i in range(300)]
    short = [t for t in texts if t is None or len(t) < 10_000]
    found = langid.features(short)
    for row, text in zip(found, short):
        np.testing.assert_allclose(row, plain_features(text), atol=1e-6)


def test_decoding_equals_plain_sums():
    """The least sum of bit losses wins, each loss times the worth of its bit; ties go by the alphabet."""
    languages = ["de", "en", "fr", "it"]
    rng = np.random.default_rng(2)
    decoder = langid.Decoder(np.zeros((0, langid.BUCKETS), np.float32), np.zeros(0, int), languages)
    width = decoder.code.shape[1]
    decoder.weights = rng.normal(size=(langid.BUCKETS, width)).astype(np.float32)
    decoder.offsets = rng.normal(size=width).astype(np.float32)
    decoder.worth = rng.uniform(0.2, 2, width).astype(np.float32)
    texts = [prose(i, 5) for i in range(40)] + ["123", None]
    out = decoder.predict(texts)
    for text, name, score, ambiguous in zip(texts, out["lang_pred"], out["score"], out["ambiguous"]):
        if text is None or text == "123":
            assert (name, score, ambiguous) == ("und", 0.0, False)
            continue
        margins = plain_features(text) @ decoder.weights + decoder.offsets
        losses = [
            sum(w * math.log1p(math.exp(-m * bit)) for w, m, bit in zip(decoder.worth, margins, word))
            for word in decoder.code
        ]
        shares = np.exp(-np.array(losses)) / np.exp(-np.array(losses)).sum()
        assert name == languages[int(np.argmin(losses))]
        assert score == pytest.approx(shares.max(), abs=1e-4)
        assert ambiguous == (np.diff(np.sort(shares))[-1] < langid.AMBIGUOUS)
    decoder.weights[:], decoder.offsets[:] = 0, 0
    assert set(decoder.predict(["abc", "xyz"])["lang_pred"]) == {"de"}


def german(seed, words):
    return prose(seed, words).replace("th", "sch").replace("tion", "ung").replace("ou", "ü")


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, prose(i, 60), "en") if i % 2 else (i, german(i, 60), "de") for i in range(600)]
    rows += [(1000 + i, prose(5000 + i, 60), None) for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(mixed):
    rows = langid.identify(mixed).toPandas().merge(mixed.toPandas(), on="doc_id")
    apart = rows[rows["held_out"] & rows["lang"].notna()]
    assert len(apart) > 60 and (apart["lang_pred"] == apart["lang"]).mean() >= 0.97
    assert set(rows[rows["lang"].isna()]["lang_pred"]) == {"en"}
    assert rows["score"].between(0, 1).all()


def test_held_out_labels_do_not_matter(mixed, spark):
    from pyspark.sql import functions as F

    other = mixed.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = langid.identify(mixed), langid.identify(other)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_odd_tables(awkward, clashing, empty):
    rows = langid.identify(clashing).collect()
    assert len(rows) == len(awkward_rows())
    unknown = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert unknown == {1, 2, 3, 9}
    assert langid.identify(empty).count() == 0
    no_labels = awkward.drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in langid.identify(no_labels).collect()} == {"und"}


def test_samples_of_any_size_are_not_empty():
    from barlake.llm.common import draw_limit

    top = 1 << 63
    assert draw_limit(800, 100) == draw_limit(800, 0) == top - 1
    for rows in (10**9, 10**11, 10**15):
        assert abs(draw_limit(800, rows) / top * rows - 800) < 1


def test_a_language_whose_ids_miss_the_sample_is_learnt(spark):
    from pyspark.sql import functions as F

    from barlake.llm.common import draw_hash, draw_limit

    ids = spark.range(5000).where(~langid.held_out(F.col("id"))).where(draw_hash("id") > draw_limit(5, 50)).limit(1)
    (one,) = [r["id"] for r in ids.collect()]
    rows = [(one, f"le chat numero {i} dort", "fr") for i in range(50)] + [(i, f"the cat {i} sleeps", "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(langid.fit(docs, train_rows=5).languages) == {"en", "fr"}
    found = {r["lang_pred"] for r in langid.identify(docs, train_rows=5).collect()}
    assert found == {"en", "fr"}
