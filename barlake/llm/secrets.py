"""Secrets in texts: keyword automaton, anchored patterns near its hits, checksums.

An Aho-Corasick automaton finds all keywords of a text in one pass; a pattern is
tried only where its keyword stands, anchored there. Kinds whose tokens carry a
checksum count only if it holds: CRC-32 in base-62 digits, Base58Check of extended keys,
Bech32 of encryption identities. Key blocks are opened and closed by two lines; both are
found by the automaton and paired once from left to right. Runs of hex digits have no
keyword; the pattern engine finds them directly.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Digits of the base-62 checksums, in order of value.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_holds(token: str) -> bool:
    """Whether the last six base-62 digits are the CRC-32 of the 30 characters before them."""
    body, digits = token[-36:-6], token[-6:]
    value = 0
    for c in digits:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body.encode("ascii"))


#: Digits of Base58 and of Bech32, in order of value.
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"


def base58_holds(token: str) -> bool:
    """Whether the last four bytes are the start of the double SHA-256 of those before (82 bytes)."""
    value = 0
    for c in token:
        value = value * 58 + BASE58.index(c)
    if value >> (82 * 8):
        return False
    data = value.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(data[:-4]).digest()).digest()[:4] == data[-4:]


def bech32_sum(prefix: str, values: list[int]) -> int:
    """The checksum polynomial over the prefix and the digits; 1 if it holds."""
    check = 1
    for v in [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *values]:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            check ^= g if top >> i & 1 else 0
    return check


def bech32_holds(token: str) -> bool:
    prefix, _, digits = token.lower().rpartition("1")
    return bech32_sum(prefix, [BECH32.index(c) for c in digits]) == 1


@dataclass(frozen=True)
class Kind:
    """One kind of secret.

    ``keywords`` are in lower case; the pattern is matched at each of them. A match
    counts if ``least`` characters stand in group ``group`` and ``check`` holds; a
    match that does not count still uses up its characters. With a ``closing`` pattern
    (which needs the keyword ``closing_keyword``) the match goes on to the end of the first
    one behind it, if all characters in between are of ``between``.
    """

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    group: int = 0
    least: int = 1
    check: Callable[[str], bool] | None = None
    closing_keyword: str = ""
    closing: re.Pattern | None = None
    between: re.Pattern | None = None


ASSIGN = Kind(
    "assign",
    ("password", "passwd", "secret", "token", "api_key", "apikey"),
    re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
    ),
    group=2,
    least=12,
)
ACCESS = Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), least=18)
HEX = Kind("hex", (), re.compile(r"[0-9a-f]{16,}"))
GITHUB = Kind(
    "github",
    ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    check=crc_holds,
)
NPM = Kind("npm", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), check=crc_holds)
PEM = Kind(
    "pem",
    ("-----begin",),
    re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    closing_keyword="-----end",
    closing=re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    between=re.compile(r"[A-Za-z0-9+/=\s:,-]*"),
)
XPRV = Kind(
    "xprv",
    ("xprv", "tprv"),
    re.compile(r"[xt]prv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
    check=base58_holds,
)
AGE = Kind(
    "age",
    ("age-secret-key-1",),
    re.compile(r"AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}(?![A-Z0-9])"),
    check=bech32_holds,
)
#: In the order in which spans that start together are listed.
KINDS = (ASSIGN, ACCESS, HEX, GITHUB, NPM, PEM, XPRV, AGE)
BASE_KINDS = ("assign", "access", "hex")


@cache
def _automaton(kinds: tuple[Kind, ...]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for i, kind in enumerate(kinds):
        for word in kind.keywords:
            automaton.add_word(word, (i, len(word)))
        if kind.closing_keyword:
            automaton.add_word(kind.closing_keyword, (~i, len(kind.closing_keyword)))
    automaton.make_automaton()
    return automaton


def _lower(text: str) -> str:
    """ASCII letters in lower case; every character keeps its place."""
    if text.isascii():
        return text.lower()
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _closings(text: str, hits: list[tuple[int, int]], kinds: tuple[Kind, ...]) -> dict[int, list[tuple[int, int]]]:
    """(start, end) of the closing patterns of each kind, in order."""
    out: dict[int, list[tuple[int, int]]] = {}
    for start, i in sorted(hits):
        if m := kinds[i].closing.match(text, start):
            out.setdefault(i, []).append((start, m.end()))
    return out


class _Blocks:
    """Where blocks that open at increasing places end; the text is walked once."""

    def __init__(self, text: str, kind: Kind, ends: list[tuple[int, int]]):
        self.text, self.between, self.ends = text, kind.between, ends
        self.starts = [start for start, _ in ends]
        self.stop = -1

    def end(self, at: int) -> int | None:
        """End of the first closing pattern behind ``at`` that only characters of a block part from it."""
        k = bisect_left(self.starts, at)
        if k == len(self.ends):
            return None
        if at > self.stop:
            # Up to here nothing else stands between, for every opening from ``at`` on.
            self.stop = self.between.match(self.text, at).end()
        start, end = self.ends[k]
        return end if start <= self.stop else None


def find_spans(text: str | None, kinds: tuple[Kind, ...] = KINDS) -> list[tuple[int, int, int]]:
    """(start, position of the kind in ``kinds``, end) of every secret, in order.

    Leftmost and not overlapping within a kind; different kinds may overlap.
    Missing and empty text has none. Positions are code points, end exclusive.
    """
    if not text:
        return []
    spans = []
    free = [0] * len(kinds)
    hits = [(end - size + 1, i) for end, (i, size) in _automaton(kinds).iter(_lower(text))]
    closings = _closings(text, [(start, ~i) for start, i in hits if i < 0], kinds)
    blocks = {i: _Blocks(text, kinds[i], ends) for i, ends in closings.items()}
    for start, i in sorted(h for h in hits if h[1] >= 0):
        if start < free[i]:
            continue
        kind = kinds[i]
        if m := kind.pattern.match(text, start):
            if kind.closing is not None:
                end = blocks[i].end(m.end()) if i in blocks else None
                if end is not None:
                    free[i] = end
                    spans.append((start, i, end))
                continue
            free[i] = m.end()
            counts = m.end(kind.group) - m.start(kind.group) >= kind.least
            if counts and (kind.check is None or kind.check(m.group())):
                spans.append((start, i, m.end()))
    for i, kind in enumerate(kinds):
        if not kind.keywords:
            spans += [(m.start(), i, m.end()) for m in kind.pattern.finditer(text)]
    return sorted(spans)


def spelled(spans: list[tuple[int, int, int]], kinds: tuple[Kind, ...] = KINDS) -> str:
    return ",".join(f"{kinds[i].name}:{start}:{end}" for start, i, end in spans)


def redacted(text: str | None, kinds: tuple[Kind, ...] = KINDS) -> str | None:
    """The text with every stretch of overlapping spans replaced by ``<kind>`` of its first span."""
    spans = find_spans(text, kinds)
    if not spans:
        return text
    out, done, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"<{kinds[kind].name}>"]
        done = end
    return "".join([*out, text[done:]])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, spans (all kinds) and base_spans of every row, as ``kind:start:end`` lists.

    One row out for every row in; missing and empty texts have no spans. The scan
    is one pass without a shuffle, so hot keys and repeated rows do not matter.
    """

    @F.pandas_udf("spans string, base_spans string")
    def spans_of(texts: pd.Series) -> pd.DataFrame:
        found = [find_spans(t) for t in texts]
        base = [[s for s in spans if KINDS[s[1]].name in BASE_KINDS] for spans in found]
        return pd.DataFrame({"spans": [spelled(s) for s in found], "base_spans": [spelled(s) for s in base]})

    return docs.select("doc_id", spans_of("text").alias("__found")).select("doc_id", "__found.*")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` (if there) brought in line.

    No row is dropped. Texts without secrets, empty and missing ones stay as they are.
    """

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted(t) for t in texts], dtype=object)

    out = docs.withColumn("__clean", clean("text"))
    if "n_chars" in docs.columns:
        changed = ~F.col("__clean").eqNullSafe(F.col("text"))
        out = out.withColumn(
            "n_chars",
            F.when(changed, F.length("__clean").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")),
        )
    return out.withColumn("text", F.col("__clean")).select(*docs.columns)
