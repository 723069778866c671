"""Repeated windows of bytes, found by a depth-limited radix sort of suffixes.

A byte goes if it lies in a window of ``WINDOW`` bytes that also starts in a document
with a smaller doc_id. Suffixes matter only through their first ``WINDOW`` bytes, so
equal groups after that depth are exactly the repeated windows.

The first digit of the sort deals the work out. It is the smallest hash of the
window's ``GRAM``-byte pieces: equal windows have equal digits, and windows that follow
one another mostly share theirs, so that a run of windows travels as one stretch of
bytes. Steps, on chunks of whole documents:

1. every chunk reports its distinct digits; digits in one document only drop out;
2. runs of windows with a repeated digit travel to the task of their digit, which
   orders them by most-significant-digit passes of 8 bytes, dropping single windows
   after every pass, and answers with the stretches to remove;
3. chunks cut the stretches out.

Digits report once a chunk. Those of more than ``HOT_RUNS`` runs are dealt by the whole
window instead, which a chunk sends once with the least doc_id it has, so no passage,
however common, meets in one task. Answers join the chunks on their number; the
chunk table is stored in buckets of that number, so texts are not shuffled.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.scratch import shared_dir
from barlake.llm.common import BASE, INVERSE, mix, powers, span_hashes

WINDOW, GRAM = 50, 24
#: Bytes of text in a chunk (or one document), and behind a part of the digits and of the runs.
CHUNK_BYTES, DIGIT_BYTES, RUN_BYTES, BUCKET_BYTES = 1 << 20, 8 << 20, 4 << 20, 16 << 20
#: Runs of one digit that may meet in one task.
HOT_RUNS = 4096
_DIGIT_BITS = 48
#: Spark allows 100,000 buckets; beyond, each holds more chunks.
MOST_BUCKETS = 50_000
#: Stands for a missing doc_id: no document counts as smaller because of it.
_LAST = np.iinfo(np.int64).max


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole documents in chunks: doc_ids, sizes and bytes one after another."""
    part = TaskContext.get().partitionId()
    ids: list[int | None] = []
    raw: list[bytes] = []
    held = count = 0

    def chunk() -> pd.DataFrame:
        order = np.array([_LAST if i is None else i for i in ids], np.int64)
        missing = np.array([i is None for i in ids], np.uint8)
        sizes = np.array([len(r) for r in raw], np.int64)
        return pd.DataFrame(
            {
                "chunk": [(part << 32) + count],
                "n_bytes": [int(sizes.sum())],
                "ids": [order.tobytes()],
                "missing": [missing.tobytes()],
                "sizes": [sizes.tobytes()],
                "data": [b"".join(raw)],
            }
        )

    for frame in frames:
        for doc_id, text in zip(frame["doc_id"].tolist(), frame["text"].tolist()):
            ids.append(None if doc_id is None else int(doc_id))
            raw.append((text or "").encode("utf-8", "surrogatepass"))
            held += len(raw[-1])
            if held >= CHUNK_BYTES:
                yield chunk()
                ids, raw, held, count = [], [], 0, count + 1
    if ids:
        yield chunk()


class Runs:
    """Runs of consecutive windows of a chunk that share a digit."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, window: int = WINDOW, gram: int = GRAM):
        n = len(data)
        none = np.zeros(0, np.int64)
        self.first = self.last = self.doc = none
        self.digit = np.zeros(0, np.uint64)
        if n < window:
            return
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
        least = mix((total[gram:] - total[:-gram]) * powers(INVERSE, n)[: n - gram + 1])
        del total
        width, reach = window - gram + 1, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if width > reach:
            least = np.minimum(least[: reach - width], least[width - reach :])
        ends = np.cumsum(sizes)
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, np.maximum(ends - sizes, ends - window + 1), 1)
        np.add.at(edge, ends, -1)
        at = np.flatnonzero(np.cumsum(edge)[: n - window + 1] == 0)
        if not len(at):
            return
        value = least[at]
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (np.diff(at) != 1)])
        starts = np.flatnonzero(new)
        self.first = at[starts]
        self.last = at[np.concatenate([starts[1:] - 1, [len(at) - 1]])]
        self.digit = mix(value[starts]) >> np.uint64(64 - _DIGIT_BITS)
        self.doc = np.searchsorted(ends, self.first, "right")


def _parts(sorted_digits: np.ndarray, parts: int) -> dict[int, tuple[int, int]]:
    """Where the parts of equal digit range that occur begin and end in sorted digits."""
    half = np.uint64(_DIGIT_BITS // 2)
    many = np.uint64(parts)
    # digit * parts >> 48 in two halves, as the product has more than 64 bits.
    low = (sorted_digits & np.uint64((1 << _DIGIT_BITS // 2) - 1)) * many >> half
    part = ((sorted_digits >> half) * many + low) >> half
    found, first = np.unique(part, return_index=True)
    return dict(zip(found.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(part)])))


def _packed(digits: np.ndarray) -> bytes:
    return digits.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _DIGIT_BITS // 8].tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) * 8 // _DIGIT_BITS, 8), np.uint8)
    out[:, : _DIGIT_BITS // 8] = np.frombuffer(blob, np.uint8).reshape(-1, _DIGIT_BITS // 8)
    return out.view("<u8").ravel()


def _opened(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (
        np.frombuffer(row.data, np.uint8),
        np.frombuffer(row.sizes, np.int64),
        np.frombuffer(row.ids, np.int64),
    )


def _reports(parts: int):
    """Distinct digits of every chunk by part, and the run counts above one."""

    def report(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                data, sizes, _ = _opened(row)
                digits, counts = np.unique(Runs(data, sizes).digit, return_counts=True)
                rows = []
                for part, (a, b) in _parts(digits, parts).items():
                    own = slice(a, b)
                    more = np.flatnonzero(counts[own] > 1)
                    extra = np.stack([more, counts[own][more] - 1], axis=1).astype("<u4")
                    rows.append((part, row.chunk, _packed(digits[own]), extra.tobytes()))
                yield pd.DataFrame(rows, columns=["part", "chunk", "digits", "more"])

    return report


def _answer_digits(rows: pd.DataFrame) -> pd.DataFrame:
    """Which digits of each report other chunks have too, and which are hot."""
    digits = [_unpacked(b) for b in rows["digits"]]
    known, inverse, counts = np.unique(np.concatenate(digits), return_inverse=True, return_counts=True)
    runs = counts.astype(np.int64)
    edges = np.cumsum([0] + [len(d) for d in digits])
    for k, blob in enumerate(rows["more"]):
        extra = np.frombuffer(blob, "<u4").reshape(-1, 2).astype(np.int64)
        np.add.at(runs, inverse[edges[k] + extra[:, 0]], extra[:, 1])
    flags = np.stack([counts > 1, runs > HOT_RUNS])[:, inverse]
    return pd.DataFrame(
        {
            "chunk": rows["chunk"],
            "part": rows["part"],
            "flags": [np.packbits(flags[:, a:b], axis=1).tobytes() for a, b in zip(edges, edges[1:])],
        }
    )


def _stretches(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the ranges [first, first + size)."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def _sent_runs(digit_parts: int, run_parts: int):
    """The runs of repeated digits of every chunk, by part."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                data, sizes, ids = _opened(row)
                runs = Runs(data, sizes)
                digits, place = np.unique(runs.digit, return_inverse=True)
                edges = _parts(digits, digit_parts)
                repeated, hot = np.zeros(len(digits), bool), np.zeros(len(digits), bool)
                for answer in row.answers if row.answers is not None else ():
                    a, b = edges[answer["part"]]
                    bits = np.frombuffer(answer["flags"], np.uint8).reshape(2, -1)
                    repeated[a:b], hot[a:b] = np.unpackbits(bits, axis=1)[:, : b - a]
                # Digits that two documents of this very chunk share.
                lowest = np.full(len(digits), _LAST)
                highest = np.full(len(digits), -1)
                np.minimum.at(lowest, place, runs.doc)
                np.maximum.at(highest, place, runs.doc)
                repeated |= highest > lowest
                plain = np.flatnonzero((repeated & ~hot)[place])
                first, windows = runs.first[plain], runs.last[plain] - runs.first[plain] + 1
                owner, digit = ids[runs.doc[plain]], runs.digit[plain]
                gone = np.zeros(0, np.int64)
                common = np.flatnonzero((repeated & hot)[place])
                if len(common):
                    amount = runs.last[common] - runs.first[common] + 1
                    at = _stretches(runs.first[common], amount)
                    who = ids[np.repeat(runs.doc[common], amount)]
                    views = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at]
                    _, same = np.unique(
                        np.ascontiguousarray(views).view(f"V{WINDOW}").ravel(), return_inverse=True
                    )
                    least = np.full(same.max() + 1, _LAST)
                    np.minimum.at(least, same, who)
                    mine = who == least[same]
                    gone, at, who = at[~mine], at[mine], who[mine]
                    key = span_hashes(data, at, at + WINDOW) >> np.uint64(64 - _DIGIT_BITS)
                    first = np.concatenate([first, at])
                    windows = np.concatenate([windows, np.ones(len(at), np.int64)])
                    owner, digit = np.concatenate([owner, who]), np.concatenate([digit, key])
                order = np.argsort(digit, kind="stable")
                rows = []
                for part, (a, b) in _parts(digit[order], run_parts).items():
                    own = order[a:b]
                    bytes_at = _stretches(first[own], windows[own] + WINDOW - 1)
                    # What this chunk has settled itself rides along with its first part.
                    settled = gone if not rows else gone[:0]
                    rows.append(
                        (
                            part,
                            row.chunk,
                            first[own].astype("<u4").tobytes(),
                            windows[own].astype("<u4").tobytes(),
                            owner[own].astype("<i8").tobytes(),
                            zstandard.compress(data[bytes_at].tobytes(), 3),
                            settled.astype("<u4").tobytes(),
                        )
                    )
                yield pd.DataFrame(
                    rows, columns=["part", "chunk", "first", "windows", "owner", "bytes", "settled"]
                )

    return send


def later_windows(data: np.ndarray, at: np.ndarray, owner: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether an equal window stands in a document with a smaller id, for windows at ``at``.

    Most-significant-digit passes of 8 bytes: ``group`` numbers the windows equal so
    far, single ones drop out after every pass.
    """
    later = np.zeros(len(at), bool)
    alive = np.arange(len(at))
    group = np.zeros(len(at), np.int64)
    for depth in range(0, window, 8):
        width = min(8, window - depth)
        word = np.zeros((len(alive), 8), np.uint8)
        word[:, :width] = np.lib.stride_tricks.sliding_window_view(data, width)[at[alive] + depth]
        word = word.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((word, group))
        group, word, alive = group[order], word[order], alive[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (word[1:] != word[:-1])])
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        group, alive = group[several], alive[several]
        if not len(alive):
            return later
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    least = np.minimum.reduceat(owner[alive], starts)
    sizes = np.diff(np.concatenate([starts, [len(alive)]]))
    later[alive] = owner[alive] > np.repeat(least, sizes)
    return later


def _answer_runs(rows: pd.DataFrame) -> pd.DataFrame:
    """Stretches [start, end) of each chunk that lie in repeated windows."""
    first = [np.frombuffer(b, "<u4").astype(np.int64) for b in rows["first"]]
    windows = [np.frombuffer(b, "<u4").astype(np.int64) for b in rows["windows"]]
    owner = np.concatenate([np.frombuffer(b, "<i8") for b in rows["owner"]])
    data = np.frombuffer(b"".join(map(zstandard.decompress, rows["bytes"])), np.uint8)
    amount = np.concatenate(windows)
    # Equal runs need their windows sorted once; those of later documents go as a whole.
    raw, known = data.tobytes(), {}
    ends = np.cumsum(amount + WINDOW - 1)
    starts = ends - (amount + WINDOW - 1)
    same = np.fromiter(
        (known.setdefault(raw[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist())),
        np.int64,
        len(amount),
    )
    least = np.full(len(known), _LAST)
    np.minimum.at(least, same, owner)
    _, once = np.unique(same, return_index=True)
    verdict = later_windows(
        data, _stretches(starts[once], amount[once]), np.repeat(least, amount[once])
    )
    at = np.cumsum(amount[once]) - amount[once]
    later = verdict[_stretches(at[same], amount)] | np.repeat(owner > least[same], amount)
    place = _stretches(np.concatenate(first), amount)
    edges = np.cumsum([0] + [int(w.sum()) for w in windows])
    out = []
    for k, settled in enumerate(rows["settled"]):
        starts = place[edges[k] : edges[k + 1]][later[edges[k] : edges[k + 1]]]
        starts = np.sort(np.concatenate([starts, np.frombuffer(settled, "<u4")]))
        new = np.flatnonzero(np.concatenate([[True], np.diff(starts) > WINDOW])) if len(starts) else []
        ends = np.concatenate([starts[np.asarray(new[1:], int) - 1], starts[-1:]]) + WINDOW if len(starts) else starts
        begins = starts[new] if len(starts) else starts
        out.append(np.stack([begins, ends], axis=1).astype("<u4").tobytes())
    return pd.DataFrame({"chunk": rows["chunk"], "stretches": out})


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row a document: sizes, removed bytes and runs, kept bytes and their hash."""
    for frame in frames:
        for row in frame.itertuples():
            data, sizes, ids = _opened(row)
            missing = np.frombuffer(row.missing, np.uint8)
            edge = np.zeros(len(data) + 1, np.int32)
            for blob in row.stretches if row.stretches is not None else ():
                ends = np.frombuffer(blob, "<u4").reshape(-1, 2)
                np.add.at(edge, ends[:, 0], 1)
                np.add.at(edge, ends[:, 1], -1)
            gone = np.cumsum(edge)[:-1] > 0
            rows, start = [], 0
            for k, size in enumerate(sizes.tolist()):
                own = gone[start : start + size]
                kept = data[start : start + size][~own].tobytes()
                spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
                rows.append((None if missing[k] else int(ids[k]), size, size - len(kept), spans, kept))
                start += size
            out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["kept_sha256"] = [hashlib.sha256(kept).hexdigest() for kept in out["kept"]]
            yield out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes) of every row.

    Missing text counts as empty and keeps nothing; texts below ``WINDOW`` bytes
    lose nothing. Rows that share a doc_id do not count as smaller than one
    another, nor do rows without doc_id, which count as last. Removal is by bytes
    and may split a character, so ``kept`` is binary. A text must fit in a task's
    memory some 60 times over. An empty table gives no rows.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Int64 with missing values would become floating point in pandas.
    slim = slim.withColumn("doc_id", F.col("doc_id").cast("string"))
    schema = "chunk long, n_bytes long, ids binary, missing binary, sizes binary, data binary"
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def parts(each: int) -> int:
        return max(1, math.ceil(total / each))

    name = f"barlake_chunks_{uuid.uuid4().hex}"
    (
        slim.mapInPandas(_chunks, schema)
        .write.format("parquet")
        .option("path", f"{shared_dir(spark)}/barlake/{name}")
        .option("compression", "zstd")
        # Fewer buckets than shuffle partitions would be shuffled after all.
        .bucketBy(min(max(parts(BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions"))), MOST_BUCKETS), "chunk")
        .saveAsTable(name)
    )
    chunks = spark.table(name)
    # The plan holds the files; the catalogue need not keep their name.
    spark.sql(f"DROP TABLE {name}")
    digit_parts, run_parts = parts(DIGIT_BYTES), parts(RUN_BYTES)
    answers = (
        chunks.select("chunk", "ids", "sizes", "data")
        .mapInPandas(_reports(digit_parts), "part int, chunk long, digits binary, more binary")
        .groupBy("part")
        .applyInPandas(_answer_digits, "chunk long, part int, flags binary")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("part", "flags")).alias("answers"))
    )
    stretches = (
        chunks.join(answers, "chunk", "left")
        .select("chunk", "ids", "sizes", "data", "answers")
        .mapInPandas(
            _sent_runs(digit_parts, run_parts),
            "part int, chunk long, first binary, windows binary, owner binary, bytes binary, settled binary",
        )
        .groupBy("part")
        .applyInPandas(_answer_runs, "chunk long, stretches binary")
        .groupBy("chunk")
        .agg(F.collect_list("stretches").alias("stretches"))
    )
    return (
        chunks.join(stretches, "chunk", "left")
        .select("ids", "missing", "sizes", "data", "stretches")
        .mapInPandas(
            _cut,
            "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
        )
    )
