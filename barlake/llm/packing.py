"""Token sequences of a fixed size, packed by cutting-stock column generation.

Every document is tokenised once; whole sequences are cut off its front and the
remainder, rounded up to a length class, becomes an item. The histogram of the
classes (a few hundred numbers, whatever the size of the corpus) is the demand of
a cutting-stock problem: a linear program over patterns (how many items of each
class share a sequence), whose columns are priced by a knapsack dynamic program
over the classes. Rounded-down patterns cover nearly all items; the rest, at most
a few hundred sequences, is packed best-fit from the histogram. Items are ranked
within their class, and rank intervals say which pattern copy an item belongs to,
so the assignment is a lookup in a table bounded by the classes.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.scratch import written
from barlake.llm.common import row_numbers

SEQUENCE = 4096
#: Tokens a length class spans; 4096 / 8 = 512 classes.
CLASS_TOKENS = 8
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Words a Python worker keeps the ids of, before it starts over.
CACHE_WORDS = 400_000
#: Columns the linear program may add; the patterns found so far are feasible at any point.
MAX_COLUMNS = 4000
#: Share above a lower bound (all sequences full, or the dual bound) at which the program counts as solved.
GAP = 5e-4


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The splitting rule of the standard tokenizer file, and its normaliser's steps. For files with
#: other ones texts are encoded whole.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_STEPS = ["NFC", "Replace", "Lowercase"]
#: Latin letters, whose small forms do not depend on their neighbours; controls are left out.
_PLAIN = regex.compile(r"[!-~\u00a1-\u024f]*")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else 256 + n."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class _Learnt(dict):
    """A dictionary that works out what it is first asked for."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        self[key] = value = self.make(key)
        return value


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, end id included.

    The standard tokenizer drops white space and never joins words across it, so the
    ids of a text are those of its words one after another. Words are split once
    into the parts its rule makes, and the model encodes a part once; both are kept
    up to ``cache_words`` of them. Words beyond plain Latin take the whole tokenizer.
    """

    def __init__(self, path: str, end_id: int = END_ID, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = int(end_id).to_bytes(4, "little")
        self.cache_words = cache_words
        self.model = self.tokenizer.model
        self.words = _Learnt(self.word)
        self.words[""] = b""
        self.parts = _Learnt(self.part)
        self.letters = _byte_letters()
        self.split = regex.compile(_PATTERN)
        rules = json.loads(self.tokenizer.to_str())
        steps = (rules.get("normalizer") or {}).get("normalizers", [])
        cuts = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            [x["type"] for x in steps] == _STEPS
            and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": _PATTERN}
        )

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def part(self, part: str) -> bytes:
        spelled = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
        ids = [token.id for token in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            if not _PLAIN.fullmatch(word) or not unicodedata.is_normalized("NFC", word):
                return self.whole(word)
        if "<|" in word:
            return self.whole(word)
        word = word.lower()
        if word.isalpha():
            return self.parts[word]
        return b"".join(map(self.parts.__getitem__, self.split.findall(word)))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            if not self.by_word:
                yield self.whole(text or "") + self.end
                continue
            if len(self.words) > self.cache_words:
                self.words.clear()
                self.words[""] = b""
            if len(self.parts) > self.cache_words:
                self.parts.clear()
            words = (text or "").replace("\n", " ").split(" ")
            yield b"".join([*map(self.words.__getitem__, words), self.end])


@cache
def encoder_of(path: str, end_id: int) -> Encoder:
    """One encoder a Python worker: what it has learnt serves the worker's later tasks too."""
    return Encoder(path, end_id)


_PIECES = "array<struct<start: bigint, length: bigint, ids_crc32: bigint, doc_tokens: bigint>>"


def cut_pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document: whole sequences from its front, then the remainder.

    Columns doc_id, doc_key, start, length, ids_crc32, doc_tokens. Missing and empty
    texts are the end id alone. ``doc_key`` tells rows that repeat a doc_id apart
    by a hash of the text. One pass, no shuffle.
    """

    def pieces(texts: pd.Series) -> pd.Series:
        out = []
        for ids in encoder_of(path, end_id).encode(texts.tolist()):
            tokens = len(ids) // 4
            cuts = [(at, ids[4 * at : 4 * (at + sequence)]) for at in range(0, tokens, sequence)]
            out.append(
                [
                    {"start": at, "length": len(x) // 4, "ids_crc32": zlib.crc32(x), "doc_tokens": tokens}
                    for at, x in cuts
                ]
            )
        return pd.Series(out, dtype=object)

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("doc_key"),
        F.inline(F.pandas_udf(pieces, _PIECES)("text")),
    )


# ---- the cutting-stock problem, on the driver: its size depends on the classes alone -----


def _best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of the largest total value within the capacity."""
    worth = np.full(capacity + 1, 0.0)
    worth[sizes] = np.maximum(values, 0.0)
    best = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    item_at = np.full(capacity + 1, -1)
    item_at[sizes] = np.arange(len(sizes))
    for room in range(1, capacity + 1):
        totals = worth[1 : room + 1] + best[room - 1 :: -1][:room]
        size = int(np.argmax(totals)) + 1
        best[room], choice[room] = totals[size - 1], size
    pattern = np.zeros(len(sizes), np.int64)
    room = capacity
    while room > 0:
        size = int(choice[room])
        if worth[size] > 0 and item_at[size] >= 0:
            pattern[item_at[size]] += 1
        room -= size
    return float(best[capacity]), pattern


def solve_patterns(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, max_columns: int = MAX_COLUMNS
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used in an optimal basis of the linear program.

    Revised simplex with the inverse of the basis; it starts from patterns of one
    class each. Stops at optimality, within ``GAP`` of full sequences, or after
    ``max_columns`` columns.
    """
    m = len(sizes)
    basis = np.diag(np.maximum(1, np.minimum(capacity // sizes, counts))).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    use = inverse @ counts.astype(float)
    bound = float(sizes @ counts) / capacity * (1 + GAP)
    for _ in range(max_columns):
        if use.sum() <= bound:
            break
        value, pattern = _best_pattern(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + GAP:
            break
        direction = inverse @ pattern
        candidates = np.flatnonzero(direction > 1e-9)
        if not len(candidates):
            break
        ratios = use[candidates] / direction[candidates]
        leave = candidates[int(np.argmin(ratios))]
        step = max(0.0, float(ratios.min()))
        use -= step * direction
        use[leave] = step
        basis[:, leave] = pattern
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
    return basis.T.astype(np.int64), np.maximum(use, 0.0)


def plan_sequences(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(copies, {class: items}) that cover the histogram exactly; no pattern exceeds the capacity.

    Rounded-down patterns of the linear program first, then best fit of what is
    left, largest class first.
    """
    if not histogram:
        return []
    sizes = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(s)] for s in sizes], np.int64)
    patterns, use = solve_patterns(sizes, counts, capacity)
    left = counts.copy()
    plan: list[tuple[int, dict[int, int]]] = []
    for pattern, amount in zip(patterns, use):
        copies = int(amount + 1e-6)
        taken = pattern > 0
        if taken.any():
            copies = min(copies, int((left[taken] // pattern[taken]).min()))
        if copies > 0 and taken.any():
            left -= copies * pattern
            plan.append((copies, {int(s): int(n) for s, n in zip(sizes[taken], pattern[taken])}))
    while left.any():
        room, pattern = capacity, {}
        at = len(sizes) - 1
        while at >= 0:
            fit = min(int(left[at]), room // int(sizes[at])) if sizes[at] <= room else 0
            if fit:
                pattern[int(sizes[at])] = fit
                room -= fit * int(sizes[at])
            at -= 1
        copies = min(int(left[np.searchsorted(sizes, s)]) // n for s, n in pattern.items())
        for s, n in pattern.items():
            left[np.searchsorted(sizes, s)] -= copies * n
        plan.append((copies, pattern))
    return plan


def _slots(plan: list[tuple[int, dict[int, int]]], first_id: int) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, ranks, items a copy, first sequence) of every class of every pattern."""
    taken: dict[int, int] = {}
    rows, sequence = [], first_id
    for copies, pattern in plan:
        for size, items in pattern.items():
            start = taken.get(size, 0)
            rows.append((size, start, copies * items, items, sequence))
            taken[size] = start + copies * items
        sequence += copies
    return rows


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    sequence: int = SEQUENCE,
    class_tokens: int = CLASS_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    Every row of ``docs`` is packed: missing and empty texts as their end id alone,
    repeated rows once each, very long texts as whole sequences and a remainder. An
    empty table gives no rows; other columns are not read. ``tokenizer`` is the path
    of a tokenizer file that every executor has.
    """
    spark = docs.sparkSession
    path = tokenizer or tokenizer_path()
    pieces = written(cut_pieces(docs, path, sequence, end_id), "pieces")
    pieces = pieces.withColumn(
        "__class", F.ceil(F.col("length") / F.lit(class_tokens)).cast("int")
    )
    histogram = {r["__class"]: r["count"] for r in pieces.groupBy("__class").count().collect()}
    plan = plan_sequences(histogram, sequence // class_tokens)
    slots = spark.createDataFrame(
        _slots(plan, 0), "__class int, __first long, __ranks long, __items long, __sequence long"
    )
    # Ranks in a class are cut into stretches of one pattern; the stretch of a rank is found
    # in the sorted starts of its class, so that the lookup is an equi-join.
    starts = slots.groupBy("__class").agg(
        F.sort_array(F.collect_list(F.struct("__first", "__items", "__sequence"))).alias("__stretches")
    )
    order = [F.col("doc_id"), F.col("doc_key"), F.col("start")]
    ranked = row_numbers(pieces, ["__class"], order, sum(histogram.values()), "__rank")
    found = ranked.join(F.broadcast(starts), "__class").withColumn(
        "__s", F.expr("element_at(filter(__stretches, s -> s.__first <= __rank), -1)")
    )
    placed = found.select(
        "doc_id",
        "doc_key",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("__s.__sequence") + F.expr("(__rank - __s.__first) div __s.__items")).alias("sequence_id"),
        "__class",
        "__rank",
    )
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.col("__class").desc(), "__rank")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop(
        "__class", "__rank"
    )


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids: the token arrays of the plan of :func:`pack` for the same ``docs``.

    Padded to ``sequence``, except where the tokens already number a power of two.
    A sequence holds ``sequence`` tokens at most, so no group is larger than that.
    """
    path = tokenizer or tokenizer_path()

    def tokens(texts: pd.Series) -> pd.Series:
        found = encoder_of(path, end_id).encode(texts.tolist())
        return pd.Series([np.frombuffer(x, "<u4").astype("int32") for x in found], dtype=object)

    encoded = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("doc_key"),
        F.pandas_udf(tokens, "array<int>")("text").alias("ids"),
    ).dropDuplicates(["doc_id", "doc_key"])
    e, p = encoded.alias("e"), packed.alias("p")
    met = p.join(e, F.col("p.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("p.doc_key") == F.col("e.doc_key")))
    part = met.select(
        "p.sequence_id",
        "p.offset",
        F.slice("e.ids", (F.col("p.start") + 1).cast("int"), F.col("p.length").cast("int")).alias("ids"),
    )
    joined = part.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids")
    )
    n = F.size("ids")
    padding = F.when(n.bitwiseAND(n - 1) == 0, F.lit(0)).otherwise(F.lit(sequence) - n)
    return joined.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("ids"))
