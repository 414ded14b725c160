"""Arrow helpers shared by the operators: slices of batches, words, tokens of whole texts.

A word is a maximal run of characters other than the space and U+0009 to U+000D.
Every helper takes a null text as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code units in a slice; a longer text is a slice of its own.
SLICE = 4 << 20


def sliced(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch whose texts together have about ``limit`` bytes."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    # Workers outlive their tasks; what Arrow keeps for later adds up beside the JVM's heap.
    pa.default_memory_pool().release_unused()


def filled(texts: pa.Array) -> pa.Array:
    return pc.fill_null(texts, "")


@dataclass
class Words:
    """Words of consecutive texts: text i has ``codes[offsets[i]:offsets[i + 1]]``, places in ``vocabulary``."""

    offsets: np.ndarray
    codes: np.ndarray
    vocabulary: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owners(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each entry of the vocabulary."""
        entries = self.vocabulary.cast(pa.binary()).to_pylist()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, entries), dtype=np.uint64, count=len(entries))


def split_words(texts: pa.Array, lower: bool = True) -> Words:
    """The words of each text, with A to Z in lower case unless ``lower`` is false."""
    texts = filled(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    vocabulary = encoded.dictionary
    empty = pc.index(vocabulary, pa.scalar("", vocabulary.type)).as_py()
    if empty >= 0:
        kept = codes != empty
        offsets = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])[offsets]
        codes = codes[kept]
    return Words(offsets, codes, vocabulary)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (the finalizer of the SplitMix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_count(text: Column) -> Column:
    """Number of words of a text, null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; null: -1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(-1))


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
