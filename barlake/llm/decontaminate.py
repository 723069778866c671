"""Benchmark passages in documents, by greedy string tiling.

Words of both sides are hashed (A-Z in lower case). A document is a candidate for
an item if they share a run of ``MATCH_WORDS`` words. For a candidate the longest
common run of unmarked words is marked as a tile, again and again, down to runs of
``MATCH_WORDS`` words; runs of a length are found by rolling hashes (running
Karp-Rabin) and checked word by word. The share of the item's words under tiles is
its coverage, whatever order the passages stand in.

Items of ``LEAST_ITEM`` words or more that are shorter than ``MATCH_WORDS`` are found where
they stand in a document as they are.

The benchmark is the query side: it is read in blocks of at most ``BLOCK_WORDS``
words, and each block meets every document in one pass without a shuffle. Of several
blocks each one's result is written before the next is sent.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.scratch import written
from barlake.llm.common import (
    BASE,
    INVERSE,
    LOWER,
    as_bytes,
    gram_hashes,
    powers,
    slices,
    span_hashes,
    word_spans,
)

MATCH_WORDS = 5
#: Fewest words of an item; a single word is no passage.
LEAST_ITEM = 2
#: Share of an item's words under tiles from which a document counts as contaminated.
COVERAGE = 0.5
#: Words of the benchmark that one pass over the documents carries (bounds what is sent to tasks).
BLOCK_WORDS = 1_000_000
_SLICE_BYTES = 1 << 20


def word_hashes(text: str | None) -> np.ndarray:
    data = LOWER[as_bytes(text)]
    return span_hashes(data, *word_spans(data))


def tile(doc: np.ndarray, item: np.ndarray, least: int = MATCH_WORDS) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in doc, start in item, words), longest first, none overlapping.

    Among equally long ones the first in the item, then in the document, is taken.
    """
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    length = _longest(doc, item, free_doc, free_item, least)
    while length >= least:
        doc_runs, item_runs = _free_runs(doc, free_doc, length), _free_runs(item, free_item, length)
        at = defaultdict(list)
        for j in doc_runs[0][np.isin(doc_runs[1], item_runs[1])].tolist():
            at[_run_key(doc, j, length)].append(j)
        for i in item_runs[0].tolist():
            if not free_item[i : i + length].all():
                continue
            for j in at.get(_run_key(item, i, length), ()):
                if free_doc[j : j + length].all() and np.array_equal(doc[j : j + length], item[i : i + length]):
                    free_doc[j : j + length] = False
                    free_item[i : i + length] = False
                    tiles.append((j, i, length))
                    break
        length = _longest(doc, item, free_doc, free_item, least, length)
    return tiles


def _run_key(words: np.ndarray, at: int, length: int) -> bytes:
    """Exact key of a run: its words."""
    return words[at : at + length].tobytes()


def _free_runs(words: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and rolling hashes of the runs of ``length`` words that are all unmarked."""
    if len(words) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    marked = np.concatenate([[0], np.cumsum(~free)])
    starts = np.flatnonzero(marked[length:] == marked[:-length])
    return starts, _rolling(words, length)[starts]


def _rolling(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` words, as differences of one running sum."""
    n = len(words)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * powers(BASE, n), out=total[1:])
    return (total[length:] - total[:-length]) * powers(INVERSE, n)[: n - length + 1]


def _longest(doc, item, free_doc, free_item, least: int, most: int | None = None) -> int:
    """Length of the longest common run of unmarked words, 0 if shorter than ``least``.

    Common runs of a length contain common runs of every smaller one, so it is
    found by halving.
    """
    low, high = 0, min(len(doc), len(item), most or len(item))
    at_least = least
    while at_least <= high:
        middle = (at_least + high + 1) // 2 if low else at_least
        a, b = _free_runs(doc, free_doc, middle)[1], _free_runs(item, free_item, middle)[1]
        if _shared(a, b):
            low = at_least = middle
            if low == high:
                break
        elif not low:
            return 0
        else:
            high = middle - 1
            if high == low:
                break
    return low


def _shared(a: np.ndarray, b: np.ndarray) -> bool:
    return bool(len(a) and len(b) and np.isin(a, b).any())


class Block:
    """A bounded part of the benchmark: word hashes of its items and an index of their seeds."""

    def __init__(self, items: list[tuple[int, np.ndarray]], seed_words: int):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.seed_words = seed_words
        seeds = [gram_hashes(w, seed_words) for w in self.words]
        # Short items by their number of words: (hash of the whole, position), sorted by hash.
        self.short = {}
        for n in sorted({len(w) for w in self.words if len(w) < seed_words}):
            own = [k for k, w in enumerate(self.words) if len(w) == n]
            whole = np.array([gram_hashes(self.words[k], n)[0] for k in own], np.uint64)
            order = np.argsort(whole, kind="stable")
            self.short[n] = whole[order], np.array(own)[order]
        owner = np.repeat(np.arange(len(items)), [len(s) for s in seeds])
        joined = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        pairs = np.unique(np.stack([joined, owner.astype(np.uint64)], axis=1), axis=0)
        self.seeds, self.owner = pairs[:, 0].copy(), pairs[:, 1].astype(np.int64)

    def candidates(self, grams: np.ndarray) -> np.ndarray:
        """Positions of the items that share a seed with these gram hashes."""
        low = np.searchsorted(self.seeds, grams, "left")
        hit = np.flatnonzero((low < len(self.seeds)) & (self.seeds[np.minimum(low, len(self.seeds) - 1)] == grams)) if len(self.seeds) else []
        if not len(hit):
            return np.zeros(0, np.int64)
        found = np.unique(grams[hit])
        first, last = np.searchsorted(self.seeds, found, "left"), np.searchsorted(self.seeds, found, "right")
        return np.unique(np.concatenate([self.owner[a:b] for a, b in zip(first, last)]))

    def coverages(self, doc: np.ndarray, grams: np.ndarray) -> list[tuple[int, int, int]]:
        """(item_id, words of the item under tiles, words of the item) of every candidate."""
        out = []
        for n, (whole, own) in self.short.items():
            here = np.isin(whole, gram_hashes(doc, n))
            out += [(self.ids[k], n, n) for k in own[here].tolist()]
        for k in self.candidates(grams).tolist():
            tiles = tile(doc, self.words[k], self.seed_words)
            if tiles:
                out.append((self.ids[k], sum(t[2] for t in tiles), len(self.words[k])))
        return out


def blocks_of(benchmark: DataFrame, least: int = MATCH_WORDS, most: int = BLOCK_WORDS) -> Iterator[Block]:
    """The benchmark in blocks; the driver holds one block at a time.

    Items without text or with fewer than ``LEAST_ITEM`` words are left out.
    """
    items: list[tuple[int, np.ndarray]] = []
    held = 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        words = word_hashes(row["text"])
        if len(words) < min(LEAST_ITEM, least):
            continue
        items.append((row["item_id"], words))
        held += len(words)
        if held >= most:
            yield Block(items, least)
            items, held = [], 0
    if items:
        yield Block(items, least)


def matches_of(texts: list[str | None], block: Block) -> list[list[tuple[int, int, int]]]:
    """The coverages of many texts: words and seeds are found for a slice of texts at once."""
    out: list[list[tuple[int, int, int]]] = []
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for first, last in slices([len(r) + 1 for r in raw], _SLICE_BYTES):
        part = raw[first:last]
        data = LOWER[np.frombuffer(b" ".join(part), np.uint8)]
        starts, ends = word_spans(data)
        words = span_hashes(data, starts, ends)
        edges = np.cumsum([0] + [len(r) + 1 for r in part])
        cut = np.searchsorted(starts, edges)
        grams = gram_hashes(words, block.seed_words)
        if len(block.seeds) and len(grams):
            low = np.minimum(np.searchsorted(block.seeds, grams), len(block.seeds) - 1)
            hit = np.flatnonzero(block.seeds[low] == grams)
        else:
            hit = np.zeros(0, np.int64)
        hits = [hit]
        for n, (whole, _) in block.short.items():
            runs = gram_hashes(words, n)
            hits.append(np.flatnonzero(np.isin(runs, whole)))
        touched = set((np.searchsorted(cut, np.concatenate(hits), "right") - 1).tolist())
        for k in range(last - first):
            if k not in touched:
                out.append([])
                continue
            own = words[cut[k] : cut[k + 1]]
            out.append(block.coverages(own, gram_hashes(own, block.seed_words)))
    return out


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = MATCH_WORDS, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """doc_id, item_id, covered_words, item_words, coverage of every contaminated pair.

    A pair counts if tiles cover at least ``coverage`` of the item's words. Missing,
    empty and short texts have no pairs; repeated rows are reported once each; an
    empty table on either side gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession

    def part(sent: Broadcast, so_far: DataFrame | None) -> DataFrame:
        pairs = F.pandas_udf(_pairs_by(sent, coverage), _PAIRS)("text")
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(pairs))
        return found if so_far is None else so_far.unionByName(found)

    out = _block_by_block(spark, blocks_of(benchmark, least, block_words), part, None)
    if out is None:
        out = spark.createDataFrame([], "doc_id long, item_id long, covered_words long, item_words long")
    return out.withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def _block_by_block(
    spark: SparkSession, blocks: Iterator[Block], step: Callable, result: DataFrame | None
) -> DataFrame | None:
    """``result`` after ``step`` with each block; only one block is sent at a time.

    A single block stays part of the plan. Of several, what a step gives is written and its
    block released before the next one is read.
    """
    sent = None
    for block in blocks:
        if sent is not None:
            result = written(result, "decontaminated")
            sent.unpersist()
        sent = spark.sparkContext.broadcast(block)
        result = step(sent, result)
    return result


_PAIRS = "array<struct<item_id: bigint, covered_words: bigint, item_words: bigint>>"


def _pairs_by(sent: Broadcast, coverage: float) -> Callable[[pd.Series], pd.Series]:
    def pairs(texts: pd.Series) -> pd.Series:
        out = [
            [
                {"item_id": item, "covered_words": covered, "item_words": words}
                for item, covered, words in found
                if covered >= coverage * words
            ]
            for found in matches_of(texts.tolist(), sent.value)
        ]
        return pd.Series(out, dtype=object)

    return pairs


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = MATCH_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without the rows that :func:`find_leaks` reports, one pass a block, no shuffle."""

    def step(sent: Broadcast, kept: DataFrame) -> DataFrame:
        return kept.where(F.pandas_udf(_clean_by(sent, coverage), "boolean")("text"))

    return _block_by_block(docs.sparkSession, blocks_of(benchmark, least, block_words), step, docs)


def _clean_by(sent: Broadcast, coverage: float) -> Callable[[pd.Series], pd.Series]:
    def clean(texts: pd.Series) -> pd.Series:
        found = matches_of(texts.tolist(), sent.value)
        return pd.Series([not any(p[1] >= coverage * p[2] for p in pairs) for pairs in found], dtype=bool)

    return clean
