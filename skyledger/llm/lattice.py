"""Language-model scores by subword lattices.

The units are the pieces of an existing vocabulary, written with a mark before each word.
Every way to segment a word into pieces (or into the bytes of characters) is a path of its
lattice; a path weighs the product of its pieces' probabilities and a word the sum over
all its paths, by a forward recursion in log space. Words follow one another independently,
so a text's log-probability is the sum over its words and one end.

The vocabulary's own scores set the pieces' first probabilities. One expectation step over
all training words, weighted by how often they occur, turns them into expected counts, and
these plus the first probabilities times ``prior`` give the probabilities that score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.sources.paths import Staging

MARK = "▁"
#: Words scored together, and characters of these.
TOGETHER, CELLS = 4096, 1 << 16
#: Pseudo-tokens by which the vocabulary's own scores count.
PRIOR = 10_000.0
#: Words that occur most are looked up in the tasks; so many at most are sent to them, of so many bytes in
#: all, each word with its numbers, and none of more than so many bytes.
FREQUENT, FREQUENT_BYTES, LONGEST = 1 << 18, 16 << 20, 1 << 10


@dataclass
class Pieces:
    """Pieces of a vocabulary as a table of all their beginnings, by hash in ascending order."""

    hashes: np.ndarray
    places: np.ndarray  # of the piece that a beginning is, among the probabilities; -1 if it is none
    prior: np.ndarray  # probabilities: pieces, then bytes, then the end

    @property
    def byte(self) -> int:
        return len(self.prior) - 257


def _points(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def _next(hashes: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = (hashes ^ (points + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def vocabulary(path: str) -> Pieces:
    """Reads a sentencepiece model. Pieces rank by score; of rank r weighs 1 / (r + 10), bytes like the last."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = np.array([model.get_score(i) for i in ids])
    rank = np.empty(len(ids))
    rank[np.argsort(-scores, kind="stable")] = np.arange(len(ids))
    weights = np.concatenate([1 / (rank + 10), np.full(257, 1 / (len(ids) + 10))])
    table: dict[int, int] = {}
    for place, i in enumerate(ids):
        h = np.zeros(1, dtype=np.uint64)
        for point in _points(model.id_to_piece(i)):
            h = _next(h, point)
            table.setdefault(int(h[0]), -1)
        table[int(h[0])] = place
    hashes = np.array(sorted(table), dtype=np.uint64)
    return Pieces(hashes, np.array([table[int(h)] for h in hashes]), weights / weights.sum())


@dataclass
class Edges:
    """Pieces of one length in the words of a block, by start: those from ``bounds[r]`` to ``bounds[r + 1]`` start at r."""

    words: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    logs: np.ndarray
    bounds: np.ndarray


class Lattice:
    """Scores words; can also gather the expected counts of pieces."""

    def __init__(self, pieces: Pieces, probabilities: np.ndarray):
        self.pieces = pieces
        self.logs = np.log(probabilities)

    def _edges(self, points: np.ndarray, lengths: np.ndarray) -> list[Edges]:
        """For each length from one: beginnings that are in no piece are not followed further."""
        most, count = points.shape
        starts = np.repeat(np.arange(most), count)
        words = np.tile(np.arange(count), most)
        left = lengths[words] - starts
        hashes = np.zeros(len(starts), dtype=np.uint64)
        out, size = [], 0
        while True:
            size += 1
            alive = left >= size
            starts, words, left, hashes = starts[alive], words[alive], left[alive], hashes[alive]
            if not len(starts):
                return out
            hashes = _next(hashes, points[starts + size - 1, words])
            at = np.minimum(np.searchsorted(self.pieces.hashes, hashes), len(self.pieces.hashes) - 1)
            alive = self.pieces.hashes[at] == hashes
            starts, words, left, hashes = starts[alive], words[alive], left[alive], hashes[alive]
            places = self.pieces.places[at[alive]]
            ends = places >= 0
            own = starts[ends]
            out.append(Edges(words[ends], own, places[ends], self.logs[places[ends]], np.searchsorted(own, np.arange(most + 1))))

    def _bytes(self, points: np.ndarray) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
        """Bytes of each different character, its number at each position, and its log-probability by bytes."""
        different, place = np.unique(points, return_inverse=True)
        spelled = [list(chr(int(c)).encode("utf-8", "surrogatepass")) for c in different]
        logs = np.array([self.logs[self.pieces.byte + np.array(s)].sum() for s in spelled])
        place = place.reshape(points.shape)
        return spelled, place, logs[place]

    def block(self, points: np.ndarray, lengths: np.ndarray, weights: np.ndarray | None = None, gathered: np.ndarray | None = None) -> np.ndarray:
        """Log-probabilities of words given as columns of code points; expected counts are added to ``gathered``."""
        most, count = points.shape
        edges = self._edges(points, lengths)
        spelled, character, by_bytes = self._bytes(points)
        forward = np.full((most + 1, count), -np.inf)
        forward[0] = 0
        for end in range(1, most + 1):
            into = forward[end - 1] + by_bytes[end - 1]
            for size, e in enumerate(edges[:end], 1):
                some = slice(e.bounds[end - size], e.bounds[end - size + 1])
                words = e.words[some]
                into[words] = np.logaddexp(into[words], forward[end - size, words] + e.logs[some])
            forward[end] = into
        total = forward[lengths, np.arange(count)]
        if gathered is None:
            return total
        backward = np.full((most + 1, count), -np.inf)
        backward[lengths, np.arange(count)] = 0
        for start in range(most - 1, -1, -1):
            out = backward[start + 1] + by_bytes[start]
            for size, e in enumerate(edges[: most - start], 1):
                some = slice(e.bounds[start], e.bounds[start + 1])
                words = e.words[some]
                out[words] = np.logaddexp(out[words], backward[start + size, words] + e.logs[some])
            backward[start] = np.where(lengths > start, out, backward[start])
        for size, e in enumerate(edges, 1):
            logs = forward[e.starts, e.words] + e.logs + backward[e.starts + size, e.words] - total[e.words]
            gathered += np.bincount(e.places, weights=weights[e.words] * np.exp(logs), minlength=len(gathered))
        inside = np.arange(most)[:, None] < lengths
        shares = weights * np.exp(np.where(inside, forward[:-1] + by_bytes + backward[1:] - total, -np.inf))
        characters = np.bincount(character.ravel(), weights=shares.ravel(), minlength=len(spelled))
        for own, n in zip(spelled, characters, strict=True):
            for b in own:
                gathered[self.pieces.byte + b] += n
        return total

    def words(self, words: list[str], weights: np.ndarray | None = None, gathered: np.ndarray | None = None) -> np.ndarray:
        """Natural log-probabilities of words, each with the mark before it; in blocks of about the same length."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        out = np.empty(len(words))
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            some = order[at : at + TOGETHER]
            most = max(1, CELLS // int(lengths[some[0]]))
            some = some[:most][lengths[some[:most]] <= lengths[some[0]] + 2]
            own = lengths[some]
            points = np.zeros((int(own[-1]), len(some)), dtype=np.uint64)
            row = np.repeat(np.arange(len(some)), own)
            column = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
            points[column, row] = _points("".join([MARK + words[i] for i in some.tolist()]))
            out[some] = self.block(points, own, None if weights is None else weights[some], gathered)
            at += len(some)
        return out


def _word_counts(df: DataFrame) -> DataFrame:
    """(word, n): how often each word of all rows occurs in the training rows; 0 if only in others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.sliced(batch, limit=16 << 20):
                words = texts.split_words(part.column("text"))
                train = ~part.column("held_out").to_numpy(zero_copy_only=False)
                counts = np.bincount(words.codes[np.repeat(train, words.counts)], minlength=len(words.vocabulary))
                there = np.zeros(len(counts), dtype=bool)
                there[words.codes] = True
                yield pa.RecordBatch.from_arrays([words.vocabulary.filter(pa.array(there)), pa.array(counts[there].astype(np.int64))], names=["word", "n"])

    return df.select("text", "held_out").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _expected(counts: DataFrame, pieces: Pieces, stage: Staging) -> np.ndarray:
    """Expected counts of the pieces over all training words; at most one number for each piece reaches the driver."""
    shared = counts.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value, shared.value.prior)
        gathered = np.zeros(len(lattice.logs))
        for batch in batches:
            if batch.num_rows:
                lattice.words(batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(np.float64), gathered)
        at = np.flatnonzero(gathered)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(gathered[at])], names=["piece", "n"])

    found = counts.where("n > 0").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(pieces.prior))
    out[found["piece"].to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    return out


def _frequent(table: DataFrame, most: int, most_bytes: int = FREQUENT_BYTES, longest: int = LONGEST) -> DataFrame:
    """The words that occur most: all of up to ``longest`` bytes whose count has at least so many binary digits that
    they are no more than ``most`` and with their numbers take no more than ``most_bytes``.

    A text without white space is one long word; it stays with Spark, like all others that are left out here.
    """
    digits, size = F.length(F.bin("n")), F.octet_length("word")
    short = table.where((F.col("n") > 0) & (size <= longest))
    sizes = short.groupBy(digits.alias("digits")).agg(F.count("*").alias("words"), F.sum(size + 24).alias("bytes")).collect()  # 64 rows at most
    least, words, taken = 65, 0, 0
    for row in sorted(sizes, key=lambda r: -r["digits"]):
        words, taken = words + row["words"], taken + row["bytes"]
        if words > most or taken > most_bytes:
            break
        least = row["digits"]
    return short.where(digits >= least)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(df: DataFrame, held_out: Column, vocabulary_path: str, prior: float = PRIOR, frequent: int = FREQUENT) -> DataFrame:
    """Scores of each row's whole ``text``, learned from the rows that are not ``held_out``.

    n_tokens: words and one end; n_known: those that occur in training rows; train_tokens:
    all of the training rows; base_score: the sum of log10((c + 1) / (train_tokens + V + 1))
    over the tokens, c being a token's count and V the number of different ones in training
    rows; score: log10 of the text's probability by the lattice model. A null text is empty:
    its only token is the end. Null and repeated ids are kept, each row is scored. Other
    columns are ignored.

    Words that are not among the ``frequent`` ones, and all long ones, meet their counts in a join by word.
    """
    spark = df.sparkSession
    stage = Staging(spark)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    pieces = vocabulary(vocabulary_path)
    counts = stage(_word_counts(rows), "counts")
    ends = rows.where("not held_out").count()
    seen = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    train_tokens, different = seen["n"] + ends, seen["v"] + (ends > 0)
    expected = _expected(counts, pieces, stage)
    expected[-1] = ends
    probabilities = (expected + prior * pieces.prior) / (expected.sum() + prior)
    model = spark.sparkContext.broadcast((pieces, probabilities))
    to_log10 = 1 / np.log(10)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*model.value)
        for batch in batches:
            if batch.num_rows:
                logs = lattice.words(batch.column("word").to_pylist()) * to_log10
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(logs)], names=["word", "n", "log_p"])

    table = stage(counts.mapInArrow(scored, "word string, n long, log_p double"), "words")
    common = _frequent(table, frequent).toArrow()
    common = spark.sparkContext.broadcast((common.column("word").combine_chunks(), common.column("n").to_numpy(), common.column("log_p").to_numpy()))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, log_p = common.value
        logs = np.append(np.log10(n + 1.0), 0.0)
        log_p = np.append(log_p, 0.0)
        for batch in batches:
            for part in texts.sliced(batch, limit=16 << 20):
                words = texts.split_words(part.column("text"))
                places = pc.index_in(words.vocabulary, value_set=known).fill_null(len(known)).to_numpy(zero_copy_only=False)
                place = places[words.codes]
                missing = place == len(known)

                owners = words.owners()

                def sums(values: np.ndarray, owners: np.ndarray = owners, rows: int = part.num_rows) -> np.ndarray:
                    return np.bincount(owners, weights=values, minlength=rows).astype(np.float64)

                size = max(1, len(words.vocabulary))
                rest, times = np.unique(owners[missing] * size + words.codes[missing], return_counts=True)
                owner = rest // size
                cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=part.num_rows))]).astype(np.int32)
                rare = pa.StructArray.from_arrays([words.vocabulary.take(pa.array(rest % size)), pa.array(times.astype(np.int32))], names=["word", "times"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(_checksums(part.column("text")), pa.int64()),
                        pa.array(words.counts.astype(np.int64)),
                        pa.array(sums(~missing).astype(np.int64)),
                        pa.array(sums(logs[place]), pa.float64()),
                        pa.array(sums(log_p[place]), pa.float64()),
                        pa.ListArray.from_arrays(pa.array(cuts), rare),
                    ],
                    names=["doc_id", "held_out", "text_hash", "words", "known", "logs", "log_p", "rare"],
                )

    shape = "doc_id long, held_out boolean, text_hash long, words long, known long, logs double, log_p double, rare array<struct<word:string,times:int>>"
    heads = stage(rows.mapInArrow(looked_up, shape), "heads")
    key = ["doc_id", "text_hash"]
    rest = heads.select(*key, F.explode("rare").alias("rare")).select(*key, "rare.word", "rare.times")
    rest = rest.join(table, "word").groupBy(*key).agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"),
        F.sum(F.col("times") * F.col("log_p")).alias("more_log_p"),
    )
    # Rows that repeat id and text have the same sums: one row of each, with the number of them.
    own = heads.groupBy(*key, "held_out", "words", "known").agg(F.max("logs").alias("logs"), F.max("log_p").alias("log_p"), F.count("*").alias("rows"))
    more = rest.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "more_known", "more_logs", "more_log_p")
    joined = own.join(more, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    joined = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    per = F.col("rows")
    n_tokens = F.col("words") + 1
    base = F.col("logs") + F.coalesce(F.col("more_logs") / per, F.lit(0.0)) + F.log10(F.lit(ends + 1.0))
    end = float(np.log(probabilities[-1]) * to_log10)
    return joined.select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce(F.col("more_known") / per, F.lit(0)).cast("long") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (base - n_tokens * F.log10(F.lit(float(train_tokens + different + 1)))).alias("base_score"),
        (F.col("log_p") + F.coalesce(F.col("more_log_p") / per, F.lit(0.0)) + F.lit(end)).alias("score"),
    )


def _checksums(column: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text."""
    entries = texts.filled(column).cast(pa.binary()).to_pylist()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, entries), dtype=np.uint64, count=len(entries)).view(np.int64)
