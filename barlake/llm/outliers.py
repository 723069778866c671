"""Quality rules: plain counts, then robust multivariate outliers per language and source.

The counts of a document give a vector of transformed statistics. Location and
scatter of each group are minimum-covariance-determinant estimates over all its
rows: concentration steps refit mean and covariance on the three quarters of the rows
that are closest, until nothing moves by more than ``STILL`` (at most ``STEPS`` times).
They start from medians and quartiles, and again from the plain mean and covariance; of
the two ends that with the smaller determinant counts. A step is one aggregation: rows
are counted and summed by group and distance bin (map-side combined, so a hot
group costs tasks * bins rows), and a small table decides how many bins make up
the share. The parameters (a row a group) go to the rows by broadcast, so rows are never
dealt by group. A document is rejected if its Mahalanobis distance is beyond ``CUT``.

Quartiles are approximate and sums floating: verdicts of rows within rounding of the cut
may depend on partitions.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.scratch import written
from barlake.llm.common import SPACE, gram_hashes, slices, span_hashes, word_spans

#: Share of the rows a concentration step keeps, and the factor that makes its scatter
#: that of a normal distribution of ``len(FLOORS)`` dimensions: 0.75 / P(chi2(7) <= 6.63).
SHARE, CONSISTENT = 0.75, 1.41
STEPS, STILL = 12, 1e-3
#: Groups whose parameters are broadcast; more are joined by salted keys.
BROADCAST_GROUPS, _SALTS = 100_000, 64
#: Groups with fewer rows share the estimate of their language, then of all such rows.
LEAST_ROWS = 50
#: Smallest standard deviations (log mean word length, then square roots of the shares of
#: symbols, repeated lines, repeated words and capitals): statistics that are nearly
#: constant in a group must not make every deviation an outlier.
FLOORS = (0.10, 0.06, 0.15, 0.12, 0.08)
#: Squared distance from which a row is an outlier: the 0.999 quantile of chi-square of 5 degrees.
CUT = 20.515
LEAST_WORDS, MOST_REPEATED = 50, 50
_BINS = 256
_SLICE_BYTES = 1 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals")


def _dup_lines(raw: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def _repeat_words(words: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more."""
    windows = gram_hashes(words, 3)
    if not len(windows):
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(hit)] |= hit
    return int(covered.sum())


def counts_of(texts: list[str | None]) -> np.ndarray:
    """The ``COUNTS`` of every text; missing texts have none."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    for first, last in slices([len(r) + 1 for r in raw], _SLICE_BYTES):
        part = raw[first:last]
        data = np.frombuffer(b"\n".join([*part, b""]), np.uint8)
        starts, ends = word_spans(data)
        hashes = span_hashes(data, starts, ends)
        edges = np.cumsum([0] + [len(r) + 1 for r in part])
        cut = np.searchsorted(starts, edges)

        def per_text(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mask)])
            return total[edges[1:]] - total[edges[:-1]]

        characters = ~SPACE[data] & ((data & 0xC0) != 0x80)
        rows = out[first:last]
        rows[:, 0] = np.diff(cut)
        rows[:, 1] = per_text(characters)
        rows[:, 2] = per_text(_SYMBOL[data])
        rows[:, 6] = per_text(_CAPITAL[data])
        for k, text in enumerate(part):
            rows[k, 3], rows[k, 4] = _dup_lines(text)
            rows[k, 5] = _repeat_words(hashes[cut[k] : cut[k + 1]])
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the ``COUNTS`` of every row, in one pass."""

    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(counts_of(texts.tolist()), columns=list(COUNTS))

    schema = ", ".join(f"{n} long" for n in COUNTS)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.pandas_udf(count, schema)("text").alias("__counts"),
    ).select("doc_id", "lang", "source", "__counts.*")


def vector() -> list[Column]:
    """The transformed statistics of a row of counts."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return [
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / words),
        F.sqrt(F.col("n_capitals") / chars),
    ]


_P = len(FLOORS)
_X = [f"x{i}" for i in range(_P)]
_CENTRE = [f"m{i}" for i in range(_P)]
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_PRECISION = [f"w{i}{j}" for i, j in _PAIRS]
_PARAMETERS = ", ".join(["grp string", *[f"{n} double" for n in ("det", *_CENTRE, *_PRECISION)]])


def distance() -> Column:
    """Squared Mahalanobis distance of a row joined with the parameters of its group."""
    away = [F.col(x) - F.col(m) for x, m in zip(_X, _CENTRE)]
    terms = [F.col(f"w{i}{j}") * away[i] * away[j] * (1 if i == j else 2) for i, j in _PAIRS]
    return F.greatest(sum(terms[1:], terms[0]), F.lit(0.0))


def _grouped(rows: DataFrame, least_rows: int) -> DataFrame:
    """Add ``grp``: lang and source, or lang, or all, the first with enough rows."""
    lang, source = F.coalesce("lang", F.lit("\x00")), F.coalesce("source", F.lit("\x00"))
    rows = rows.withColumns({"__lang": lang, "__pair": F.concat_ws("\x01", lang, source)})
    pairs = rows.groupBy("__lang", "__pair").agg(F.count(F.lit(1)).alias("__n"))
    small = pairs.where(F.col("__n") < least_rows)
    langs = small.groupBy("__lang").agg(F.sum("__n").alias("__small"))
    names = pairs.join(langs, "__lang", "left").select(
        "__pair",
        F.when(F.col("__n") >= least_rows, F.concat(F.lit("pair\x01"), "__pair"))
        .when(F.col("__small") >= least_rows, F.concat(F.lit("lang\x01"), "__lang"))
        .otherwise("all")
        .alias("grp"),
    )
    return _with_groups(rows, written(names, "groups"), "__pair").drop("__lang", "__pair")


def _with_groups(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of a written table of one row a ``key``; no key's rows meet in one task."""
    if table.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(table), key)
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    dealt = rows.withColumn("__salt", F.pmod(F.xxhash64("doc_id", *_X), F.lit(_SALTS)).cast("int"))
    return dealt.join(salted, [key, "__salt"]).drop("__salt")


def _first_parameters(rows: DataFrame) -> DataFrame:
    """Medians, and quartile distances as independent standard deviations."""
    quartiles = rows.groupBy("grp").agg(
        *[F.percentile_approx(x, [0.25, 0.5, 0.75], 1000).alias(x) for x in _X]
    )
    spread = [
        F.greatest((F.col(x)[2] - F.col(x)[0]) / 1.349, F.lit(floor)) for x, floor in zip(_X, FLOORS)
    ]
    return quartiles.select(
        "grp",
        F.lit(0.0).alias("det"),
        *[F.col(x)[1].alias(m) for x, m in zip(_X, _CENTRE)],
        *[
            (1 / (spread[i] * spread[i]) if i == j else F.lit(0.0)).alias(f"w{i}{j}")
            for i, j in _PAIRS
        ],
    )


def _refit(bins: pd.DataFrame) -> pd.DataFrame:
    """Parameters of one group from its sums by distance bin (``_BINS`` rows at most)."""
    bins = bins.sort_values("bin")
    n = bins["n"].to_numpy()
    inside = slice(0, int(np.searchsorted(np.cumsum(n), SHARE * n.sum())) + 1)
    total = n[inside].sum()
    mean = np.array([bins[f"s{i}"].to_numpy()[inside].sum() / total for i in range(_P)])
    cov = np.zeros((_P, _P))
    for i, j in _PAIRS:
        cov[i, j] = cov[j, i] = bins[f"s{i}{j}"].to_numpy()[inside].sum() / total - mean[i] * mean[j]
    cov *= CONSISTENT
    lift = np.maximum(np.square(FLOORS) - np.diag(cov), 0)
    scatter = cov + np.diag(lift) + 1e-9 * np.eye(_P)
    precision = np.linalg.inv(scatter)
    row = {"grp": bins["grp"].iloc[0], "det": np.linalg.slogdet(scatter)[1]}
    row |= {m: mean[i] for i, m in enumerate(_CENTRE)}
    row |= {f"w{i}{j}": precision[i, j] for i, j in _PAIRS}
    return pd.DataFrame([row])


def _concentrate(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    at = F.least(F.floor(F.log2(1 + 16 * F.col("__d")) * 16), F.lit(_BINS - 1)).cast("int")
    sums = (
        _with_groups(rows, parameters, "grp")
        .withColumn("__d", distance())
        .groupBy("grp", at.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)],
            *[F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"s{i}{j}") for i, j in _PAIRS],
        )
    )
    return written(sums.groupBy("grp").applyInPandas(_refit, _PARAMETERS), "scatter")


def _settled(rows: DataFrame, parameters: DataFrame) -> DataFrame:
    """Concentration steps until no centre moves by ``STILL`` of its least deviation and no determinant by ``STILL``."""
    for _ in range(STEPS):
        before, parameters = parameters, _concentrate(rows, parameters)
        old = before.select("grp", *[F.col(n).alias(f"__{n}") for n in ("det", *_CENTRE)])
        moves = [F.abs(F.col(m) - F.col(f"__{m}")) / floor for m, floor in zip(_CENTRE, FLOORS)]
        moved = F.greatest(F.abs(F.col("det") - F.col("__det")), *moves)
        if not (parameters.join(old, "grp").agg(F.max(moved)).first()[0] or 0.0) > STILL:
            break
    return parameters


def judge(docs: DataFrame, least_rows: int = LEAST_ROWS, cut: float = CUT) -> DataFrame:
    """doc_id, counts, base_failed, distance and kept of every row of ``docs``.

    Missing lang or source is a group of its own kind. Missing, empty and short
    texts fail the base rule; rows that fail it neither count for the estimates nor
    have a distance. Repeated rows are judged alike; an empty table gives no rows.
    """
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)
    counted = written(
        statistics(docs).withColumn("base_failed", failed).withColumns(dict(zip(_X, vector()))),
        "statistics",
    )
    judged = counted.where("not base_failed")
    rows = written(_grouped(judged, least_rows), "judged")
    robust = _settled(rows, written(_first_parameters(rows), "scatter"))
    # With precision 0 every row is near: the first step gives the plain mean and covariance.
    flat = rows.select("grp").distinct().select(
        "grp", *[F.lit(0.0).alias(n) for n in ("det", *_CENTRE, *_PRECISION)]
    )
    plain = _settled(rows, written(flat, "scatter"))
    both = robust.withColumn("__start", F.lit(0)).unionByName(plain.withColumn("__start", F.lit(1)))
    names = [c for c in robust.columns if c != "grp"]
    parameters = both.groupBy("grp").agg(F.min(F.struct("det", "__start", *names[1:])).alias("p")).select("grp", *[f"p.{n}" for n in names])
    columns = ["doc_id", *COUNTS, "base_failed"]
    near = _with_groups(rows, written(parameters, "scatter"), "grp").select(*columns, distance().alias("distance"))
    short = counted.where("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"))
    return near.unionByName(short).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(False))
    )
