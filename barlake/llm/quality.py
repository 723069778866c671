"""Document quality from random-indexing word vectors and a two-layer network.

Words are the maximal runs of bytes of one class (letters small, letters capital,
digits, symbols), hashed to ``WORDS`` buckets. Every bucket has a sparse random
index vector; the vector of a word is the sum, over all its occurrences in all
documents, of the index vectors of its neighbours, scaled to length 1. Tasks sum
their own occurrences, so what is shuffled is tasks * buckets, and the sums cover
the whole corpus. A document is pooled into the mean and the spread of its words'
vectors and a few shares of its word counts; a network with one hidden layer,
fitted in numpy on a bounded sample of labelled rows, gives a probability whose
temperature is set on rows the fit did not see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import draw_hash, draw_limit, mix, slices, span_hashes

WORDS, DIM = 4096, 48
#: Non-zero entries of an index vector, and neighbours to either side that count.
NONZERO, REACH = 4, 2
#: Labelled rows the network is fitted on at most (about; they are drawn by a hash of doc_id).
TRAIN_ROWS = 8000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 0.005, 1e-4
#: Share of the sample that sets the temperature only.
CALIBRATION = 0.2
KEEP_FROM = 0.7
_SLICE_BYTES = 1 << 20
_BLOCK = 256

#: Byte classes: 0 white space and controls, 1 small letters and bytes beyond ASCII,
#: 2 capital letters, 3 digits, 4 symbols.
_CLASS = np.full(256, 4, np.int8)
_CLASS[:33] = 0
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[128:] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_SHARES = 9


def index_vectors(words: int = WORDS, dim: int = DIM) -> np.ndarray:
    """The sparse random index vector of every bucket: ``NONZERO`` entries of +1 or -1."""
    out = np.zeros((words, dim), np.float32)
    rows = np.arange(words)
    for k in range(NONZERO):
        h = mix(rows.astype(np.uint64) * np.uint64(NONZERO) + np.uint64(k + 1))
        np.add.at(out, (rows, (h % np.uint64(dim)).astype(np.int64)), np.where(h >> np.uint64(63), 1.0, -1.0))
    return out


class Words:
    """The words of a slice of documents: bucket, class and document of each."""

    def __init__(self, raw: list[bytes], words: int = WORDS):
        data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        kind = _CLASS[data]
        change = np.flatnonzero(np.diff(kind)) + 1
        starts = np.concatenate([[0], change]) if len(data) else np.zeros(0, np.int64)
        ends = np.concatenate([change, [len(data)]]) if len(data) else starts
        held = kind[starts] > 0 if len(data) else np.zeros(0, bool)
        starts, ends = starts[held], ends[held]
        self.kind = kind[starts] if len(data) else np.zeros(0, np.int8)
        self.hash = span_hashes(data, starts, ends)
        self.bucket = (self.hash % np.uint64(words)).astype(np.int64)
        edges = np.cumsum([0] + [len(r) + 1 for r in raw])
        self.cut = np.searchsorted(starts, edges)
        self.doc = np.repeat(np.arange(len(raw)), np.diff(self.cut))


def _sliced(texts: list[str | None], words: int) -> Iterator[tuple[int, int, Words]]:
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for first, last in slices([len(r) + 1 for r in raw], _SLICE_BYTES):
        yield first, last, Words(raw[first:last], words)


def neighbour_sums(texts: list[str | None], out: np.ndarray) -> None:
    """Add the index vectors of the neighbours of every word to the row of its bucket in ``out``."""
    words, dim = out.shape
    index = index_vectors(words, dim)
    places = np.argsort(index == 0, axis=1, kind="stable")[:, :NONZERO]
    signs = np.take_along_axis(index, places, axis=1)
    for _, _, found in _sliced(texts, words):
        for reach in range(1, REACH + 1):
            same = found.doc[:-reach] == found.doc[reach:]
            left, right = found.bucket[:-reach][same], found.bucket[reach:][same]
            for of, near in ((left, right), (right, left)):
                at = (of[:, None] * dim + places[near]).ravel()
                sums = np.bincount(at, weights=signs[near].ravel(), minlength=words * dim)
                out += sums.reshape(words, dim).astype(np.int64)


def word_vectors(docs: DataFrame, words: int = WORDS, dim: int = DIM) -> np.ndarray:
    """The vectors of all buckets, from all texts of ``docs``; unit length, zero if never seen.

    What reaches the driver is ``words`` rows, however large the corpus is. The
    sums are whole numbers, so the result does not depend on the order of tasks.
    """
    names = [f"v{i}" for i in range(dim)]

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((words, dim), np.int64)
        for frame in frames:
            neighbour_sums(frame["text"].tolist(), sums)
        seen = np.flatnonzero(sums.any(axis=1))
        yield pd.DataFrame({"bucket": seen, **{n: sums[seen, i] for i, n in enumerate(names)}})

    rows = (
        docs.select("text")
        .mapInPandas(partial, ", ".join(["bucket long", *[f"{n} long" for n in names]]))
        .groupBy("bucket")
        .agg(*[F.sum(n).alias(n) for n in names])
        .collect()
    )
    out = np.zeros((words, dim))
    for row in rows:
        out[row["bucket"]] = [row[n] for n in names]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """One row a text: mean and spread of its words' vectors, then shares of its word counts."""
    words, dim = vectors.shape
    out = np.zeros((len(texts), 2 * dim + _SHARES), np.float32)
    squares = vectors**2
    for first, last, found in _sliced(texts, words):
        docs = last - first
        for low in range(0, docs, _BLOCK):
            high = min(low + _BLOCK, docs)
            inside = slice(found.cut[low], found.cut[high])
            doc, bucket = found.doc[inside] - low, found.bucket[inside]
            counts = np.bincount(doc * words + bucket, minlength=(high - low) * words)
            counts = counts.reshape(high - low, words).astype(np.float32)
            n = np.maximum(np.diff(found.cut[low : high + 1]), 1)[:, None].astype(np.float32)
            mean = counts @ vectors / n
            spread = np.sqrt(np.maximum(counts @ squares / n - mean**2, 0))
            kinds = np.bincount(doc * 5 + found.kind[inside], minlength=(high - low) * 5)
            kinds = kinds.reshape(high - low, 5)[:, 1:] / n
            pairs = np.unique(np.stack([doc.astype(np.uint64), found.hash[inside]], axis=1), axis=0)
            distinct = np.bincount(pairs[:, 0].astype(np.int64), minlength=high - low)[:, None]
            most = counts.max(axis=1, keepdims=True) / n
            again = found.hash[inside][1:] == found.hash[inside][:-1]
            again &= doc[1:] == doc[:-1]
            stutter = np.bincount(doc[1:][again], minlength=high - low)[:, None] / n
            rows = out[first + low : first + high]
            rows[:] = np.hstack([mean, spread, kinds, distinct / n, most, np.log1p(n), np.sqrt(distinct) / n, stutter])
    return out


class Network:
    """Two layers, fitted by Adam on mini-batches; probabilities are calibrated by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 42):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        apart = order[: int(len(x) * CALIBRATION)]
        fit = order[len(apart) :]
        self.middle = x[fit].mean(axis=0)
        self.scale = x[fit].std(axis=0) + 1e-3
        width = x.shape[1]
        self.layers = [
            rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32),
            np.zeros(1, np.float32),
        ]
        self.temperature = 1.0
        self._train(self._scaled(x[fit]), y[fit].astype(np.float32), rng)
        if len(apart):
            logits, truth = self.logits(x[apart]), y[apart]
            grid = np.geomspace(0.5, 8.0, 60)
            losses = [np.logaddexp(0, np.where(truth == 1, -logits, logits) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(losses))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.scale, -8, 8).astype(np.float32)

    def _train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        slow = [np.zeros_like(p) for p in self.layers]
        square = [np.zeros_like(p) for p in self.layers]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at : at + BATCH]
                step += 1
                w1, b1, w2, b2 = self.layers
                hidden = np.tanh(x[rows] @ w1 + b1)
                error = (1 / (1 + np.exp(-(hidden @ w2 + b2))) - y[rows]) / len(rows)
                back = np.outer(error, w2) * (1 - hidden**2)
                slopes = [x[rows].T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ error + DECAY * w2, error.sum(keepdims=True)]
                for p, g, m, v in zip(self.layers, slopes, slow, square):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return (np.tanh(self._scaled(x) @ w1 + b1) @ w2 + b2).astype(float)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


class Constant:
    """Stands in where there is nothing to learn."""

    def __init__(self, value: float):
        self.value = value

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: CRC-32 of the doc_id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network | Constant]:
    """Word vectors of ``docs`` and the classifier of ``labels.quality``.

    Word vectors cover all texts. Labels come from rows that are not held out; a
    doc_id labelled more than once counts with the majority, ties as 1. About
    ``train_rows`` of them, drawn by a hash of doc_id, are the sample. Without any
    usable label the score is 1 (nothing can be rejected), with labels of one kind
    it is their smoothed share.
    """
    vectors = word_vectors(docs)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("__label"))
    )
    drawn = known.where(draw_hash("doc_id") <= draw_limit(train_rows, known.count()))
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = pooled(frame["text"].tolist(), sent.value)
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "label": frame["label"], "x": [r.tobytes() for r in rows]}
            )

    # The sample has a fixed size, so it may be sent to every task.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = (
        texts.join(F.broadcast(drawn), "doc_id")
        .select("doc_id", F.col("__label").alias("label"), "text")
        .mapInPandas(features, "doc_id long, label int, x binary")
        .toPandas()
    )
    sample = sample.sort_values(["doc_id", "x"], ignore_index=True)
    y = sample["label"].to_numpy()
    if not len(y):
        return vectors, Constant(1.0)
    if len(set(y.tolist())) == 1 or len(y) < 10:
        return vectors, Constant(float((y.sum() + 1) / (len(y) + 2)))
    x = np.stack([np.frombuffer(b, np.float32) for b in sample["x"]])
    return vectors, Network(x, y)


def with_score(docs: DataFrame, labels: DataFrame, name: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` and the probability of label 1 as column ``name``; the text is its only input."""
    model = fit(docs, labels, train_rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        vectors, network = sent.value
        return pd.Series(network.probability(pooled(texts.tolist(), vectors)))

    return docs.withColumn(name, F.pandas_udf(score, "double")("text"))


def score_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Missing and empty texts pool to zeros and are scored like any other; repeated
    rows are scored alike; an empty table gives no rows.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = with_score(slim, labels, "score", train_rows)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``KEEP_FROM``, with the columns of ``docs``."""
    return (
        with_score(docs, labels, "__score", train_rows)
        .where(F.col("__score") >= KEEP_FROM)
        .select(*docs.columns)
    )
