"""Token alignment of two vocabularies over whole texts, in Arrow tables.

Both tokenizers give bytes that join to a space and the text. Where a token of either ends,
the text is cut; the groups between are the least stretches that both spell in whole tokens.
Documents are handled in slices of some megabytes, as Arrow tables throughout:

* token lists are flattened, with the number of the document as parent index, and the
  lengths of their bytes are summed up within each document;
* an Acero hash join on (document, end) finds the cuts, and one on groups the linked ids where
  a group has several;
* ``Table.group_by`` counts a slice's pairs of ids, and Spark adds up the slices.

The counts come back to a slice in a shuffle, once for each of its different pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.bpe import ByteLevel
from skyledger.sources.paths import Staging

#: Bytes of text that are aligned together; a longer text is a slice of its own.
SLICE = 2 << 20

# How the second vocabulary writes a space and single bytes.
SPACE = "▁"


@dataclass
class Tokens:
    """Token lists of consecutive documents, flattened: ``parent`` is the number of the document."""

    parent: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, lists: list) -> Tokens:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = [np.asarray(x, np.int32) for x in lists]
        return cls(np.repeat(np.arange(len(lists)), sizes), np.concatenate([np.empty(0, np.int32), *flat]))

    def counts(self, documents: int) -> np.ndarray:
        return np.bincount(self.parent, minlength=documents)

    def ends(self, lengths: np.ndarray) -> np.ndarray:
        """Where each token ends in the bytes of its document: a sum within each segment."""
        total = np.cumsum(lengths[self.ids], dtype=np.int64)
        first = np.flatnonzero(np.diff(self.parent, prepend=-1))
        before = total[first] - lengths[self.ids[first]]
        return total - np.repeat(before, np.diff(np.append(first, len(self.ids))))

    def where(self, kept: np.ndarray) -> Tokens:
        """Those of the documents marked in ``kept``."""
        there = kept[self.parent]
        return Tokens(self.parent[there], self.ids[there])


class Tokenizer:
    """Ids of texts, and the bytes that each id stands for."""

    def __init__(self, written: list[bytes]):
        self.written = pa.array(written, pa.binary())
        self.lengths = np.fromiter(map(len, written), np.int64, len(written))

    def spells(self, tokens: Tokens, given: pa.Array) -> np.ndarray:
        """Whether the bytes of each document's tokens join to those ``given``."""
        parts = self.written.take(pa.array(tokens.ids))
        sizes = np.bincount(tokens.parent, self.lengths[tokens.ids], len(given))
        if (sizes == pc.binary_length(given).to_numpy()).all() and _bytes(parts) == _bytes(given):
            return np.ones(len(given), dtype=bool)
        offsets = np.concatenate([[0], np.cumsum(tokens.counts(len(given)))]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, parts), pa.scalar(b"", pa.binary()))
        return pc.equal(joined, given).to_numpy(zero_copy_only=False)


def _bytes(values: pa.Array) -> memoryview:
    """The bytes of all values, one after the other."""
    data = values.buffers()[2]
    ends = np.frombuffer(values.buffers()[1], np.int32)[[values.offset, values.offset + len(values)]].tolist()
    return memoryview(data if data is not None else b"")[slice(*ends)]


class ByteTokens(Tokenizer):
    """A byte-level vocabulary of the ``tokenizers`` library; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.bpe = ByteLevel(path)
        self.bpe.library.encode_special_tokens = True
        self.bpe.special = []
        letters = {letter: byte for byte, letter in self.bpe._letters.items()}
        entries = [self.bpe.library.id_to_token(i) or "" for i in range(self.bpe.library.get_vocab_size())]
        super().__init__([bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries])

    def encode(self, spaced: pa.Array) -> Tokens:
        return Tokens.of(self.bpe.encode(spaced))


class PieceTokens(Tokenizer):
    """A vocabulary of pieces, some of which are single bytes, of the ``sentencepiece`` library."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

        def written(i: int) -> bytes:
            piece = self.library.id_to_piece(i)
            return bytes([int(piece[3:-1], 16)]) if self.library.is_byte(i) else piece.replace(SPACE, " ").encode()

        super().__init__([written(i) for i in range(self.library.get_piece_size())])

    def encode(self, plain: pa.Array) -> Tokens:
        return Tokens.of(self.library.encode(plain.to_pylist(), num_threads=1) if len(plain) else [])


@lru_cache(maxsize=2)
def tokenizers(bytes_path: str, pieces_path: str) -> tuple[ByteTokens, PieceTokens]:
    """One pair for each process."""
    return ByteTokens(bytes_path), PieceTokens(pieces_path)


def _id_lists(offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    """For each group its ids as text, joined by commas."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids).cast(pa.string())), ",")


def _grouped(offsets: np.ndarray, ids: np.ndarray, wanted: np.ndarray, name: str, times: str) -> pa.Table:
    """The ids of the ``wanted`` groups, once each, with how often they are there."""
    sizes = np.diff(offsets)
    group = np.repeat(np.arange(len(sizes)), sizes)
    there = wanted[group]
    counted = pa.table({"group": group[there], name: ids[there]}).group_by(["group", name], use_threads=False)
    return counted.aggregate([([], "count_all")]).rename_columns(["group", name, times])


@dataclass
class Aligned:
    """Documents of a slice: a row each in ``documents``, their linked pairs of ids in ``links``
    (parent, place of the pair, occurrences), and the slice's different pairs in ``pairs``
    (a, b, docs: documents that hold it linked)."""

    documents: pa.Table
    links: pa.Table
    pairs: pa.Table


def align(plain: pa.Array, first: ByteTokens, second: PieceTokens) -> Aligned:
    plain = texts.filled(plain)
    n = len(plain)
    spaced = pc.binary_join_element_wise(pa.scalar(" "), plain, "")
    a, b = first.encode(spaced), second.encode(plain)
    given = spaced.cast(pa.binary())
    sound = first.spells(a, given) & second.spells(b, given) & pc.not_equal(plain, "").to_numpy(zero_copy_only=False)
    a, b = a.where(sound), b.where(sound)

    # Cuts: where tokens of both end. Each row has the places of the two tokens.
    of_a = pa.table({"parent": a.parent, "end": a.ends(first.lengths), "at_a": np.arange(len(a.ids))})
    of_b = pa.table({"parent": b.parent, "end": b.ends(second.lengths), "at_b": np.arange(len(b.ids))})
    cuts = of_a.join(of_b, ["parent", "end"], join_type="inner", use_threads=False)
    at_a, at_b = (np.sort(cuts.column(c).to_numpy()) for c in ("at_a", "at_b"))
    a_offsets, b_offsets = np.append(0, at_a + 1), np.append(0, at_b + 1)
    owner = a.parent[at_a]

    # Most groups are a token each. In others ids are counted, so that the join meets every pair of ids of a group once.
    single = (np.diff(a_offsets) == 1) & (np.diff(b_offsets) == 1)
    several = _grouped(a_offsets, a.ids, ~single, "a", "times_a")
    met = several.join(_grouped(b_offsets, b.ids, ~single, "b", "times_b"), "group", join_type="inner", use_threads=False)
    group = np.concatenate([np.flatnonzero(single), met.column("group").to_numpy()])
    id_a = np.concatenate([a.ids[at_a[single]], met.column("a").to_numpy()])
    id_b = np.concatenate([b.ids[at_b[single]], met.column("b").to_numpy()])
    times = met.column("times_a").to_numpy() * met.column("times_b").to_numpy()
    occurrences = np.concatenate([np.ones(len(group) - len(times), np.int64), times])
    linked = pa.table({"parent": owner[group], "pair": np.left_shift(id_a.astype(np.int64), 32) | id_b, "n": occurrences})
    links = linked.group_by(["parent", "pair"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["parent", "pair", "n"])
    counted = links.group_by("pair", use_threads=False).aggregate([([], "count_all")])
    place = pc.index_in(links.column("pair"), value_set=counted.column("pair").combine_chunks())
    found = counted.column("pair").to_numpy()
    pairs = pa.table(
        {
            "a": (found >> 32).astype(np.int32),
            "b": (found & 0xFFFFFFFF).astype(np.int32),
            "docs": counted.column("count_all"),
        }
    )

    spelled = pc.binary_join_element_wise(_id_lists(a_offsets, a.ids), _id_lists(b_offsets, b.ids), "|")
    bounds = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    whole = pc.binary_join(pa.ListArray.from_arrays(bounds, spelled), ";").cast(pa.binary()).to_pylist()
    per_document = np.zeros(n, np.int64)
    np.add.at(per_document, links.column("parent").to_numpy(), links.column("n").to_numpy())
    documents = pa.table(
        {
            "n_a": a.counts(n),
            "n_b": b.counts(n),
            "n_groups": np.diff(bounds).astype(np.int64),
            "n_links": per_document,
            "groups_sha256": [hashlib.sha256(w).hexdigest() if w else "" for w in whole],
        }
    )
    return Aligned(documents, pa.table({"parent": links.column("parent"), "place": place, "n": links.column("n")}), pairs)


DOCUMENTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places array<int>, times array<bigint>"
ALIGNED = f"slice long, {DOCUMENTS}, pair_a array<int>, pair_b array<int>, pair_docs array<bigint>"


def _slice_rows(doc_ids: pa.Array, aligned: Aligned) -> pa.Table:
    """Rows of ``ALIGNED`` but for the slice: one for each document, and a last one that holds the pairs."""
    n, pairs = len(doc_ids), aligned.pairs
    links = aligned.links.sort_by("parent")
    offsets = np.searchsorted(links.column("parent").to_numpy(), np.arange(n + 1)).astype(np.int32)

    def listed(table: pa.Table, name: str) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, table.column(name).combine_chunks())

    def last(column: pa.ChunkedArray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([*[None] * n, 0, len(column)], pa.int32()), column.combine_chunks())

    columns = {"doc_id": doc_ids, **{c: aligned.documents.column(c) for c in aligned.documents.column_names}}
    columns |= {"places": listed(links, "place"), "times": listed(links, "n")}
    rows = pa.table({name: pa.chunked_array([*(c.chunks if isinstance(c, pa.ChunkedArray) else [c]), pa.nulls(1, c.type)]) for name, c in columns.items()})
    for name in pairs.column_names:
        rows = rows.append_column(f"pair_{name}", last(pairs.column(name)))
    return rows


def _align_slices(bytes_path: str, pieces_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tokenizers(bytes_path, pieces_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in texts.sliced(batch, limit=SLICE):
                rows = _slice_rows(part.column("doc_id"), align(part.column("text"), first, second))
                rows = rows.add_column(0, "slice", pa.array(np.full(len(rows), number)))
                number += 1
                yield from rows.combine_chunks().to_batches()

    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, count (documents of all slices that hold the pair linked), best (no pair of its a has a higher count)."""
    pairs = _pairs(aligned).groupBy("a", "b").agg(F.sum("docs").alias("count"))
    # An id of the first vocabulary has at most as many pairs as the second has ids.
    highest = F.max("count").over(Window.partitionBy("a"))
    return pairs.withColumn("best", F.col("count") == highest)


def _pairs(aligned: DataFrame) -> DataFrame:
    zipped = F.arrays_zip("pair_a", "pair_b", "pair_docs")
    pairs = aligned.where("pair_a is not null").select("slice", F.posexplode(zipped).alias("place", "pair"))
    return pairs.select("slice", "place", F.col("pair.pair_a").alias("a"), F.col("pair.pair_b").alias("b"), F.col("pair.pair_docs").alias("docs"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _summed(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one slice with the counts of its pairs."""
    place = counts.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = counts.column("count").to_numpy(), counts.column("best").to_numpy()
    places = documents.column("places").combine_chunks()
    parent, at = pc.list_parent_indices(places), pc.list_flatten(places).to_numpy()
    times = pc.list_flatten(documents.column("times").combine_chunks()).to_numpy()
    links = pa.table({"parent": parent, "best": times * best[at], "sum": times * count[at]})
    sums = links.group_by("parent", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
    n_best, count_sum = np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)
    where = sums.column("parent").to_numpy()
    n_best[where], count_sum[where] = sums.column("best_sum").to_numpy(), sums.column("sum_sum").to_numpy()
    out = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    out = out.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))
    return out.append_column("groups_sha256", documents.column("groups_sha256"))


def with_counts(aligned: DataFrame) -> DataFrame:
    """One row for each document, in ``RESULT``."""
    counts = _pairs(aligned).drop("docs").join(pair_counts(aligned), ["a", "b"]).select("slice", "place", "count", "best")
    documents = aligned.where("pair_a is null").drop("pair_a", "pair_b", "pair_docs").withColumnRenamed("slice", "of_slice")
    return documents.groupBy("of_slice").cogroup(counts.groupBy("slice")).applyInArrow(_summed, RESULT)


def alignment(df: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row's whole ``text``.

    The paths are those of a byte-level vocabulary and one of pieces, on every executor. The
    first encodes a space and the text, the second the text, before which it puts a space. A
    text that is null or empty, or that either writes in other bytes, has no tokens: zeros and
    an empty string. Rows that repeat an id, or have none, are documents of their own; other
    columns are ignored, whatever their names. Without rows the result is empty.

    A task holds a slice: some megabytes of text, or one longer text.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = rows.mapInArrow(_align_slices(bytes_path, pieces_path), ALIGNED)
    return with_counts(Staging(df.sparkSession)(aligned, "aligned"))
