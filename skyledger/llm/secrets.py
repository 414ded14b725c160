"""Secrets in whole texts.

One pass of an Aho-Corasick automaton over the text, A to Z in lower case, finds the
keywords; a kind's expression is tried only where one of its keywords starts. Runs of hex
digits have no keyword and are found by their length. Kinds whose secrets carry a checksum
are reported only if it is right.
"""

from __future__ import annotations

import binascii
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import texts

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def crc32_base62(body: str) -> str:
    """The checksum at the end of prefixed access tokens: six digits of base 62."""
    value, digits = binascii.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0")


def _ends_in_crc(m: re.Match) -> bool:
    return crc32_base62(m[1][:-6]) == m[1][-6:]


def _base58check(m: re.Match) -> bool:
    value = 0
    for c in m[0]:
        value = value * 58 + BASE58.index(c)
    raw = value.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


@dataclass(frozen=True)
class Kind:
    """``pattern`` starts with one of ``keywords`` (lower case); failing matches are dropped but used up."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]
    base: bool = False


# The expressions of the base kinds and of tokens with a checksum, in the order
# in which spans that start together are listed.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
        lambda m: len(m[2]) >= 8,
        base=True,
    ),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16, base=True),
    Kind("hex", (), re.compile(r"[0-9a-f]{32,}"), lambda m: True, base=True),
    Kind(
        "github",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
        _ends_in_crc,
    ),
    Kind("npm", ("npm_",), re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"), _ends_in_crc),
    Kind("wallet", ("xprv",), re.compile(rf"xprv[{BASE58}]{{107}}(?![{BASE58}])"), _base58check),
)

Span = tuple[int, int, int]  # start, place in KINDS, end


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for k, kind in enumerate(KINDS):
        for word in kind.keywords:
            automaton.add_word(word, (k, len(word)))
    automaton.make_automaton()
    return automaton


def spans(text: str) -> list[Span]:
    """All secrets by start, then kind, in code points; for each kind leftmost and without overlap."""
    hits: dict[int, list[int]] = {}
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # ASCII letters only
    for end, (k, size) in _automaton().iter(lowered):
        hits.setdefault(k, []).append(end - size + 1)
    found: list[Span] = []
    for k, starts in hits.items():
        used, kind = 0, KINDS[k]
        for start in sorted(starts):
            if start >= used and (m := kind.pattern.match(text, start)):
                used = m.end()
                if kind.valid(m):
                    found.append((start, k, used))
    for k, kind in enumerate(KINDS):
        if not kind.keywords:
            found.extend((m.start(), k, m.end()) for m in kind.pattern.finditer(text) if kind.valid(m))
    return sorted(found)


def listed(found: list[Span]) -> str:
    return ",".join(f"{KINDS[k].name}:{start}:{end}" for start, k, end in found)


def redacted(text: str, found: list[Span], mask: str = "[REDACTED]") -> str:
    """The text with each secret replaced; overlapping ones by one mask."""
    out, at = [], 0
    for start, _, end in found:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(df: DataFrame) -> DataFrame:
    """The secrets of each row's whole ``text``: counts of the base kinds, a digest of their spans, all spans.

    A null text is empty and has none (the digest is that of the empty string). Null and
    repeated ids are kept as they are; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.sliced(batch):
                found = [spans(t) for t in texts.filled(part.column("text")).to_pylist()]
                base = [[s for s in f if KINDS[s[1]].base] for f in found]
                counts = [pa.array([sum(s[1] == k for s in f) for f in base], pa.int64()) for k in range(3)]
                digests = [hashlib.sha256(listed(f).encode()).hexdigest() for f in base]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array(map(listed, found), pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return df.select(df.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(run, SCANNED)


def redact(df: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """The rows with every secret in ``text`` masked, and with ``n_chars``, if there is one, of the new text.

    A null text stays null and its n_chars as it was; rows without secrets stay as they are.
    """
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.sliced(batch):
                old = part.column("text").to_pylist()
                found = [spans(t) if t else [] for t in old]
                new = [redacted(t, f, mask) if f else t for t, f in zip(old, found, strict=True)]
                arrays = dict(zip(columns, part.columns, strict=True))
                arrays["text"] = pa.array(new, pa.string())
                if "n_chars" in arrays:
                    sizes = part.column("n_chars")
                    kept = [len(n) if f else s for n, f, s in zip(new, found, sizes.to_pylist(), strict=True)]
                    arrays["n_chars"] = pa.array(kept, sizes.type)
                yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return df.mapInArrow(run, df.schema)
