"""Compression of vectors to codes: nearest codebook entries by integer Walsh-Hadamard transform.

A vector of integers is cut into equal parts, and each position has a codebook of its own.
Part and entry are padded with zeros to a power of two, D, and transformed: sums and
differences alone. The transform keeps squared distances but for the factor D, so squared
differences of the coefficients, added in the order of their sequency, reach D times the
distance. A vector's parts are smooth or not, but most of what tells entries apart is often in a
few coefficients; an entry goes as soon as its sum exceeds the distance to an entry already
measured in full. All of it is in 64-bit integers, so every distance is exact.

A codebook is fitted by rounds of assignment over all rows. Tasks add up their rows for each
position and entry; Spark adds up the tasks. Only codebooks, which have the size of
``entries`` vectors, pass through the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.sources.paths import Staging

#: Rows that are compared at once.
TOGETHER = 2048


def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of ``size``, a power of two, by their number of sign changes."""
    signs = transformed(np.eye(size, dtype=np.int64))
    return np.argsort((np.diff(signs, axis=0) != 0).sum(axis=0), kind="stable")


def transformed(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, whose length is a power of two, in natural order."""
    out, half = rows.astype(np.int64), 1
    while half < out.shape[1]:
        pairs = out.reshape(len(out), -1, 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), -1)
        half *= 2
    return out


def in_sequency(rows: np.ndarray) -> np.ndarray:
    """Rows of any length, padded with zeros and transformed, by sequency."""
    size = 1 << max(0, rows.shape[1] - 1).bit_length()
    padded = np.zeros((len(rows), size), dtype=np.int64)
    padded[:, : rows.shape[1]] = rows
    return transformed(padded)[:, sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part the nearest entry, ties to the lower index, and its exact squared distance."""
    x, e = in_sequency(parts), in_sequency(entries)
    size = x.shape[1]
    sums = (x[:, :1] - e[:, 0]) ** 2
    # The best after one coefficient is measured in full: no farther entry can win.
    bound = ((x - e[sums.argmin(axis=1)]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for j in range(1, size):
        sums += (x[row, j] - e[entry, j]) ** 2
        left = sums <= bound[row]
        row, entry, sums = row[left], entry[left], sums[left]
    # Rows ascend and entries ascend within; every row still has the entry of its bound.
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(sums, starts) if len(starts) else sums
    first = np.flatnonzero(sums == np.repeat(least, np.diff(np.append(starts, len(row)))))
    first = first[np.diff(row[first], prepend=-1) != 0]
    return entry[first], sums[first] // size


def greatest(length: int) -> int:
    """The greatest component, by amount, whose scaled distances in parts of this length surely fit in 64 bits."""
    size = 1 << max(0, length - 1).bit_length()
    return math.isqrt((1 << 61) // size**3)


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]`` are the entries of position p, one a row."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def vectors(self, lists: pa.Array) -> np.ndarray:
        """Lists of integers as rows, with zeros after shorter ones."""
        out, limit = _matrix(lists, self.width), greatest(self.entries.shape[2])
        if out.size and max(out.max(), -out.min()) > limit:
            raise ValueError(f"a component exceeds {limit}: distances would not be exact")
        return out

    def cut(self, vectors: np.ndarray) -> np.ndarray:
        """Position, row, place within the part."""
        return vectors.reshape(len(vectors), self.entries.shape[0], -1).transpose(1, 0, 2)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector (row) the index for each position, and the sum of squared distances."""
        found = [nearest(p, e) for p, e in zip(self.cut(vectors), self.entries, strict=True)]
        return np.stack([index for index, _ in found], axis=1), np.sum([d for _, d in found], axis=0)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of ``width``, shorter ones followed by zeros."""
    ends = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)] = values
    return out


def _slices(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            part = batch.slice(at, TOGETHER)
            yield part, books.vectors(part.column("vector"))


def start(rows: DataFrame, parts: int = 16, entries: int = 64) -> Codebooks | None:
    """The vectors of the ``entries`` least vec_ids as entries, ascending; fewer if there are no more rows.

    None if there are no rows. Ties go to the lesser vector; rows without an id come last.
    """
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return None
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).toArrow()
    width = max(1, -(-longest // parts)) * parts
    vectors = _matrix(first.column("vector").combine_chunks(), width)
    return Codebooks(vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2).copy())


def refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry becomes the floor of the mean of the parts nearest to it; an unused one stays."""
    parts, entries, length = books.entries.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, length + 1), dtype=np.int64)
        for _, vectors in _slices(batches, books):
            index, _ = books.encode(vectors)
            for p, cut in enumerate(books.cut(vectors)):
                np.add.at(sums[p, :, :length], index[:, p], cut)
                sums[p, :, length] += np.bincount(index[:, p], minlength=entries)
        used = np.flatnonzero(sums[:, :, length])
        flat = sums.reshape(-1, length + 1)[used]
        columns = [pa.array(used, pa.int32()), pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * (length + 1), flat.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["entry", "sums"])

    each = rows.select("vector").mapInArrow(add_up, "entry int, sums array<bigint>")
    totals = each.groupBy("entry").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(length + 1)]).alias("sums"))
    out = books.entries.reshape(-1, length).copy()
    for r in totals.toLocalIterator():  # parts times entries rows at most
        out[r["entry"]] = [s // r["sums"][length] for s in r["sums"][:length]]
    return Codebooks(out.reshape(books.entries.shape))


def train(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks | None:
    books = start(rows, parts, entries)
    for _ in range(rounds if books else 0):
        books = refined(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, code (an index for each part, two hexadecimal digits each), error (squared distance), label."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, vectors in _slices(batches, books):
            index, error = books.encode(vectors)
            codes = pa.array([bytes(c).hex() for c in index.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), codes, pa.array(error), batch.column("label")], names=["vec_id", "code", "error", "label"]
            )

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "vector", "label").mapInArrow(coded, f"vec_id long, code string, error long, label {label}")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error of all rows with the same label, nulls together.

    A label that holds more than a share of one in the shuffle partitions is one of less than
    as many; these few are broadcast. The rows of all others meet their sums by shuffle.
    """
    spark = coded.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = coded.groupBy(F.col("label").alias("sum_label")).agg(F.sum("error").alias("label_error"), F.count("*").alias("rows"))
    rows = coded.agg(F.count("*")).first()[0]
    hot = F.broadcast(sums.where(F.col("rows") * parts > rows).drop("rows"))
    others = sums.where(F.col("rows") * parts <= rows).drop("rows")
    same = F.col("label").eqNullSafe(F.col("sum_label"))
    of_hot = coded.join(hot, same)
    of_others = coded.join(hot, same, "left_anti").join(others, same)
    return of_hot.unionByName(of_others).drop("sum_label")


def compress(df: DataFrame, vector: Column, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of all rows whose ``vector`` is an array of integers.

    ``df`` has vec_id and label; a row whose vector is null takes no part. Shorter vectors
    are followed by zeros, as are all if the longest cannot be cut into ``parts``; an
    empty one is all zeros. A component beyond ``greatest`` (2**27 in parts of four) is an error. A row without an id is coded like any other and is an entry at
    first only if too few have one; rows that repeat an id are rows of their own. Other columns
    are ignored, whatever their names. Without rows the result is empty. Up to 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries: 1 to 256")
    spark = df.sparkSession
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<bigint>").alias("vector"), "label")
    rows = rows.where("vector is not null")
    books = train(rows, parts, entries, rounds)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = Staging(spark)(encode(rows, books), "coded")
    out = with_label_error(coded).withColumn("codebooks_sha256", F.lit(books.sha256()))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
