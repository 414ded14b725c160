"""Document fingerprints by consistent weighted sampling.

A text's terms are its words, A to Z in lower case, weighted by how often they occur. For
each of the fingerprint's samples a term draws, from its own hash alone, two gamma and one
uniform variate (r, c of shape 2, beta) and with its weight S gets

    t = floor(ln S / r + beta),   ln a = ln c - r (t - beta) - r;

the sample is (term, t) of the least a. Two texts have the same sample with a chance equal
to their generalised Jaccard similarity, the sum of the lesser over the sum of the greater
weights, so the share of equal samples estimates it: with a standard error of at most 0.0625
for 64 samples. A fingerprint is written as eight hexadecimal digits for each sample.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import blocks, texts

SAMPLES = 64
#: Terms whose variates are drawn at once, and terms sampled at once.
DRAWN, SAMPLED = 4096, 1 << 15
#: The sample of a text without words.
NOTHING = np.uint32(0xFFFFFFFF)
SLICE = 4 << 20


def _scores(hashes: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """For each weighted term and sample: ln a in the upper, the identity of (term, t) in the lower 32 bits."""
    place = np.arange(1, samples + 1, dtype=np.uint64)
    half = np.float64(2.0**-32)
    out = np.empty((len(hashes), samples), dtype=np.uint64)
    for at in range(0, len(hashes), DRAWN):
        own = hashes[at : at + DRAWN, None]
        log_weight = np.log(weights[at : at + DRAWN, None].astype(np.float64))

        def drawn(stream: int, own: np.ndarray = own) -> np.ndarray:
            return texts.mixed(own + (place + np.uint64(stream * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15))

        def gamma(bits: np.ndarray) -> np.ndarray:
            high = ((bits >> np.uint64(32)).astype(np.float64) + 0.5) * half
            low = ((bits & np.uint64(0xFFFFFFFF)).astype(np.float64) + 0.5) * half
            return -np.log(high * low)

        r = gamma(drawn(1))
        beta = (drawn(3) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        t = np.floor(log_weight / r + beta)
        log_a = np.log(gamma(drawn(2))) - r * (t - beta) - r
        # Floats in the order of unsigned integers.
        bits = log_a.astype(np.float32).view(np.uint32)
        ordered = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        identity = texts.mixed(drawn(4) + t.astype(np.int64).view(np.uint64)) >> np.uint64(32)
        out[at : at + DRAWN] = ordered << np.uint64(32) | np.minimum(identity, np.uint64(0xFFFFFFFE))
    return out


def fingerprints(column: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """A row of 32-bit samples for each whole text; null is empty."""
    words = texts.split_words(column)
    count, size = len(column), max(1, len(words.vocabulary))
    out = np.full((count, samples), NOTHING, dtype=np.uint32)
    terms, weights = np.unique(words.owners() * size + words.codes, return_counts=True)
    if not len(terms):
        return out
    owner, term = terms // size, terms % size
    # Each different (term, weight) of the slice is scored once.
    most = int(weights.max()) + 1
    pairs, place = np.unique(term * most + weights, return_inverse=True)
    scores = _scores(words.hashes()[pairs // most], pairs % most, samples)
    firsts = np.searchsorted(owner, np.arange(count + 1))
    best = np.full((count, samples), np.iinfo(np.uint64).max)
    for at in range(0, len(terms), SAMPLED):
        part = owner[at : at + SAMPLED]
        whose = np.unique(part)
        starts = np.maximum(firsts[whose] - at, 0)
        least = np.minimum.reduceat(scores[place[at : at + SAMPLED]], starts, axis=0)
        best[whose] = np.minimum(best[whose], least)
    return np.where(np.diff(firsts)[:, None] > 0, best.astype(np.uint32), out)


def written(samples: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in samples.astype(">u4")]


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The share of equal samples; 1 for two texts without words."""
    return (one == other).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as many first code points of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_edits(df: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each row's whole ``text`` and of the text with its last quarter edited.

    The edit takes from the next document: the next greater doc_id, after the last the
    first (a single document follows itself). Rows with the same id follow one another in
    the order of their texts; null ids come first; a null text is empty. Other columns are
    ignored. ``near_edited`` and ``near_next`` are the shares of samples in common with the
    edited text and with the next document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, str, np.ndarray] | None = None
        ended = False
        for batch in batches:
            for part in texts.sliced(batch, limit=SLICE):
                if ended:
                    break
                heads = part.column("head").to_numpy(zero_copy_only=False)
                if heads.any():  # of the rows that start the next block the first is the one that follows
                    part, ended = part.slice(0, int(heads.argmax()) + 1), True
                column = texts.filled(part.column("text"))
                strings, ids = column.to_pylist(), part.column("doc_id").to_pylist()
                if held is not None:
                    ids, strings = [held[0], *ids], [held[1], *strings]
                changed = [edited(a, b) for a, b in zip(strings[:-1], strings[1:], strict=True)]
                # Together, as most terms of an edited text have the weights they have in the text.
                both = fingerprints(pa.concat_arrays([column, pa.array(changed, column.type)]), samples)
                own, theirs = both[: len(column)], both[len(column) :]
                if held is not None:
                    own = np.concatenate([held[2], own])
                held = (ids[-1], strings[-1], own[-1:])
                if len(ids) == 1:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[:-1], pa.int64()),
                        pa.array([len(t) for t in strings[:-1]], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                        pa.array(written(own[:-1])),
                        pa.array(written(theirs)),
                        pa.array(likeness(own[:-1], theirs)),
                        pa.array(likeness(own[:-1], own[1:])),
                    ],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    rows = df.select("doc_id", "text")
    placed = blocks.in_blocks(rows, blocks.bounds(rows), heads=True)
    return placed.select(placed.doc_id.cast("long").alias("doc_id"), "text", "head").mapInArrow(run, EDITED)
