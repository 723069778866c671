"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1; each position of the code is a binary
logistic classifier over hashed n-grams of letters that predicts that bit. A text is decoded to
the language whose codeword has the least loss, each bit weighted by how well its
classifier did on rows it was not fitted on. Where the second codeword is nearly
as close the text is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import draw_hash, draw_limit, slices

GRAMS, BUCKETS = (1, 2, 3), 4096
#: Rows of one language the classifiers are fitted on at most (about; drawn by a hash of doc_id).
TRAIN_ROWS = 800
EPOCHS, BATCH, RATE, DECAY = 12, 128, 0.05, 1e-5
#: Share of the sample that only weighs the bits.
WEIGHING = 0.2
#: Up to this many languages the code has all distinct columns.
EXHAUSTIVE = 5
#: Score gap to the second language below which a text is ambiguous.
AMBIGUOUS = 0.2
UNKNOWN = "und"
_SLICE_BYTES = 1 << 19
_BLOCK = 256

#: Letters a-z and bytes beyond ASCII stay, everything else is a gap.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
_HAS_LETTER = regex.compile(r"\p{L}")


def code_of(languages: int, seed: int = 42) -> np.ndarray:
    """Codewords (rows): all distinct columns for few languages, else the best of many random codes."""
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= EXHAUSTIVE:
        columns = [[1 if c >> r & 1 else -1 for r in range(languages)] for c in range(1, 1 << (languages - 1))]
        return np.array(columns, np.int8).T.reshape(languages, -1)
    rng = np.random.default_rng(seed)
    width = int(np.ceil(10 * np.log2(languages)))
    best, least = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, width))
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + width * np.eye(languages, dtype=int)
        split = np.abs(code.sum(axis=0)).max() < languages
        if split and apart.min() > least:
            best, least = code, apart.min()
    return best


def features(texts: list[str | None]) -> np.ndarray:
    """Unit rows of the square roots of hashed n-gram counts; texts without letters give zeros."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    for first, last in slices([len(r) + 2 for r in raw], _SLICE_BYTES):
        for low in range(first, last, _BLOCK):
            part = raw[low : min(low + _BLOCK, last)]
            data = _LETTER[np.frombuffer(b" " + b"  ".join(part) + b" ", np.uint8)].astype(np.uint32)
            doc = np.repeat(np.arange(len(part)), [len(r) + 2 for r in part])
            gap = data == 32
            counts = np.zeros(len(part) * BUCKETS, np.int64)
            for n in GRAMS:
                size = len(data) - n + 1
                if size <= 0:
                    continue
                h = np.full(size, n, np.uint32)
                empty = np.ones(size, bool)
                for i in range(n):
                    h = (h ^ data[i : i + size]) * np.uint32(0x01000193)
                    empty &= gap[i : i + size]
                # Inside a text only one gap stands between two words.
                for i in range(n - 1):
                    empty |= gap[i : i + size] & gap[i + 1 : i + 1 + size]
                at = (h ^ (h >> np.uint32(15))) % np.uint32(BUCKETS)
                counts += np.bincount(
                    doc[:size][~empty] * BUCKETS + at[~empty].astype(np.int64), minlength=len(counts)
                )
            rows = np.sqrt(counts.reshape(len(part), BUCKETS).astype(np.float32))
            norm = np.linalg.norm(rows, axis=1, keepdims=True)
            out[low : low + len(part)] = rows / np.maximum(norm, 1e-9)
    return out


class Decoder:
    """Bit classifiers, bit weights and codewords."""

    def __init__(self, x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 42):
        self.languages = languages
        self.code = code_of(len(languages)).astype(np.float32)
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        apart, rest = order[: int(len(x) * WEIGHING)], order[int(len(x) * WEIGHING) :]
        width = self.code.shape[1]
        self.weights = np.zeros((x.shape[1], width), np.float32)
        self.offsets = np.zeros(width, np.float32)
        if width:
            self._train(x[rest], self.code[y[rest]], rng)
        self.worth = np.ones(width, np.float32)
        if width and len(apart):
            wrong = ((x[apart] @ self.weights + self.offsets) * self.code[y[apart]] <= 0).mean(axis=0)
            wrong = np.clip(wrong, 1e-3, 0.499)
            self.worth = (0.5 * np.log((1 - wrong) / wrong)).astype(np.float32)
            self.worth /= self.worth.mean()

    def _train(self, x: np.ndarray, bits: np.ndarray, rng: np.random.Generator) -> None:
        """Logistic loss of all bits together, AdaGrad on mini-batches."""
        past, past_offset = np.full_like(self.weights, 1e-6), np.full_like(self.offsets, 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at : at + BATCH]
                z = (x[rows] @ self.weights + self.offsets) * bits[rows]
                slope = -bits[rows] / (1 + np.exp(np.clip(z, -30, 30))) / len(rows)
                g = x[rows].T @ slope + DECAY * self.weights
                h = slope.sum(axis=0)
                past += g * g
                past_offset += h * h
                self.weights -= RATE * 4 * g / np.sqrt(past)
                self.offsets -= RATE * h / np.sqrt(past_offset)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score, ambiguous of every text."""
        letters = np.array([bool(t and _HAS_LETTER.search(t)) for t in texts], bool)
        names = np.array([*self.languages, UNKNOWN], dtype=object)
        if not self.languages:
            share = np.zeros((len(texts), 1))
        else:
            margins = features(texts) @ self.weights + self.offsets
            losses = np.stack(
                [(np.logaddexp(0, -np.clip(margins * row, -30, 30)) * self.worth).sum(axis=1) for row in self.code], axis=1
            )
            share = np.exp(-(losses - losses.min(axis=1, keepdims=True)))
            share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        ordered = np.sort(share, axis=1)
        gap = ordered[:, -1] - (ordered[:, -2] if share.shape[1] > 1 else 0)
        known = letters & bool(self.languages)
        return pd.DataFrame(
            {
                "lang_pred": names[np.where(known, best, len(self.languages))],
                "score": np.where(known, share.max(axis=1), 0.0).astype(float),
                "ambiguous": known & (gap < AMBIGUOUS),
            }
        )


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: CRC-32 of the doc_id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Decoder:
    """The decoder of the languages in ``lang``, from about ``train_rows`` rows of each.

    Rows without lang, text or doc_id, and held-out rows, are not learnt from. Of codewords
    that are equally near the language first in the alphabet is chosen. The
    driver receives the hashed features of the sample, never texts.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where(
        "lang is not null and text is not null and doc_id is not null"
    ).where(~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Decoder(np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), [])
    limit = F.create_map(*[F.lit(v) for lang in languages for v in (lang, draw_limit(train_rows, counts[lang]))])
    drawn = known.where(draw_hash("doc_id") <= limit[F.col("lang")])

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = features(frame["text"].tolist()).astype(np.float16)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "lang": frame["lang"], "x": [r.tobytes() for r in x]})

    schema = "doc_id long, lang string, x binary"
    sample = drawn.mapInPandas(rows, schema).toPandas()
    # Few distinct ids may all miss the sample; no language is left without rows.
    for lang in sorted(set(languages) - set(sample["lang"])):
        least = known.where(F.col("lang") == lang).orderBy(draw_hash("doc_id"), F.xxhash64("text")).limit(train_rows)
        sample = pd.concat([sample, least.mapInPandas(rows, schema).toPandas()], ignore_index=True)
    sample = sample.sort_values(["doc_id", "lang", "x"], ignore_index=True)
    place = {lang: i for i, lang in enumerate(languages)}
    y = sample["lang"].map(place).to_numpy(int)
    x = np.stack([np.frombuffer(b, np.float16) for b in sample["x"]]).astype(np.float32) if len(sample) else np.zeros((0, BUCKETS), np.float32)
    return Decoder(x, y, languages)


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every row of ``docs``.

    Texts that are missing or have no letter are ``und`` with score 0, as is every
    text where no language can be learnt. The text is the only input of a
    prediction. Repeated rows are predicted alike; an empty table gives no rows.
    """
    decoder = fit(docs, train_rows)
    sent = docs.sparkSession.sparkContext.broadcast(decoder)

    def predict(texts: pd.Series) -> pd.DataFrame:
        return sent.value.predict(texts.tolist())

    found = F.pandas_udf(predict, "lang_pred string, score double, ambiguous boolean")("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), found.alias("__found")
    ).select("doc_id", "held_out", "__found.*")
