"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are runs of one to three letters and word ends, in lower case, hashed to a fixed
number of places, weighted by ``(1 + ln tf) * idf`` and scaled to length one. The document
frequencies behind idf are counted over all training rows. The weights are fitted with
follow-the-regularised-leader steps and an elastic-net penalty, so most are zero, on a
sample of the training rows of a bounded size; a part of the sample that is not fitted on
sets the temperature that calibrates the scores. Only so many languages are learned, so that
the model has a bounded size too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``sample``: rows fitted and calibrated on, about, dealt evenly over the languages. ``languages``: those with most
    training rows, so many at most, are learned; a model takes ``places`` times as many numbers."""

    languages: int = 200
    places: int = 1 << 16
    longest: int = 3
    sample: int = 4000
    calibration: float = 0.25
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1e-4


DEFAULT = Settings()


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def features(text: str, settings: Settings = DEFAULT) -> tuple[np.ndarray, np.ndarray]:
    """Places of the whole text's n-grams and how often each occurs; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    # Letters, with one mark between words and at both ends.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    marked = np.where(letter, points, 32)[kept].astype(np.uint32)
    marked = np.concatenate([np.array([32], np.uint32)[: 1 if marked[0] != 32 else 0], marked, np.array([32], np.uint32)[: 1 if marked[-1] != 32 else 0]])
    shift = np.uint32(32 - int(math.log2(settings.places)))
    grams = np.zeros(len(marked), dtype=np.uint32)
    hashed = []
    for n in range(1, settings.longest + 1):
        if len(marked) < n:
            break
        grams = grams[: len(marked) - n + 1] * np.uint32(0x01000193) + marked[n - 1 :] * np.uint32(0x9E3779B1) + np.uint32(n)
        mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        hashed.append((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> shift)
    counts = np.bincount(np.concatenate(hashed), minlength=settings.places)
    places = np.flatnonzero(counts)
    return places, counts[places]


def weighted(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[places]
    length = np.sqrt((values * values).sum())
    return values / length if length else values


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, settings: Settings) -> np.ndarray:
    """Weights (places + 1, classes); the last row is the intercept. ``rows``: places and values."""
    s = settings
    z = np.zeros((s.places + 1, classes))
    squares = np.zeros((s.places + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        over = np.sign(z[at]) * np.maximum(np.abs(z[at]) - s.l1, 0)
        return -over / ((s.beta + np.sqrt(squares[at])) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for (places, values), label in zip(rows, labels, strict=True):
            at, x = np.append(places, s.places), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1
            gradient = np.outer(x, error)
            grown = squares[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / s.alpha * w
            squares[at] = grown
    return weights(np.arange(s.places + 1))


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """What the scores are divided by so that the labels' likelihood is greatest."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(scores / math.exp(log_t))[np.arange(len(labels)), labels]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = -4.0, 4.0, (math.sqrt(5) - 1) / 2
    for _ in range(50):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, right) if loss(left) < loss(right) else (left, high)
    return math.exp((low + high) / 2)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    settings: Settings

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of each text, ``und`` without a letter, and its calibrated probability (``und``: 0)."""
        names, scores = [], np.zeros(len(column))
        for i, text in enumerate(texts.filled(column).to_pylist()):
            places, counts = features(text, self.settings)
            if not len(places) or not self.languages:
                names.append(UNKNOWN)
                continue
            values = weighted(places, counts, self.idf)
            p = _softmax((values @ self.weights[places] + self.weights[-1]) / self.temperature)
            best = int(p.argmax())
            names.append(self.languages[best])
            scores[i] = min(1.0, float(p[best]))
        return names, scores


def _counted(rows: DataFrame, settings: Settings) -> np.ndarray:
    """In how many rows each place occurs; last, the number of rows. At most ``places`` + 1 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(settings.places + 1, dtype=np.int64)
        for batch in batches:
            for text in texts.filled(batch.column("text")).to_pylist():
                places, _ = features(text, settings)
                total[places] += 1
                total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "n"])

    found = rows.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(settings.places + 1, dtype=np.int64)
    out[found["place"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def train(df: DataFrame, usable: Column | None = None, key: str = "doc_id", settings: Settings = DEFAULT) -> Model:
    """Learns from ``text`` and ``lang`` of the rows that are ``usable`` and whose lang is not null.

    ``key`` only picks the sample; where it is null or repeated the text tells rows apart, and equal
    rows are drawn together. A null text is empty and has no features. Without rows of a language the
    model answers ``und`` to all. The rows that calibrate are drawn from each language apart, and one row
    of each is fitted in any case. Document frequencies count all of these rows, whatever their
    language. Other columns are ignored.
    """
    rows = df.where(F.col("lang").isNotNull())
    rows = (rows if usable is None else rows.where(usable)).select(F.col(key).alias("key"), "text", "lang")
    most = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(settings.languages)
    sizes = {r["lang"]: r["n"] for r in most.collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 0)), 1.0, settings)
    frequency = _counted(rows, settings)
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    quota = settings.sample / len(languages)
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, quota / sizes[name])])[F.col("lang")]
    chance = texts.unit(F.struct("key", F.xxhash64("text")), 17)
    sample = rows.where(chance < share).select("lang", chance.alias("chance"), (texts.unit(F.struct("key", F.xxhash64("text")), 18) < settings.calibration).alias("apart"), "text")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, settings) for t in texts.filled(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("lang", "chance", "apart")),
                    pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                    pa.array([f[1].astype(np.int32) for f in found], pa.list_(pa.int32())),
                ],
                names=["lang", "chance", "apart", "places", "counts"],
            )

    def fitted(table: pa.Table) -> pa.Table:
        order = np.lexsort((np.array(table.column("lang").to_pylist()), table.column("chance").to_numpy()))
        labels = np.array([languages.index(x) for x in table.column("lang").to_pylist()])
        rows = []
        for places, counts in zip(table.column("places"), table.column("counts"), strict=True):
            places, counts = places.values.to_numpy().astype(np.int64), counts.values.to_numpy()
            rows.append((places, weighted(places, counts, idf)))
        apart = table.column("apart").to_numpy(zero_copy_only=False).copy()
        for language in range(len(languages)):
            own = order[labels[order] == language]
            if len(own) and apart[own].all():
                apart[own[0]] = False
        learn, calibrate = (order[apart[order] == x] for x in (False, True))
        weights = fit([rows[i] for i in learn], labels[learn], len(languages), settings)
        scores = [rows[i][1] @ weights[rows[i][0]] + weights[-1] for i in calibrate]
        t = temperature(np.array(scores).reshape(-1, len(languages)), labels[calibrate])
        return pa.table({"weights": pa.array([weights.astype("<f4").tobytes()], pa.binary()), "temperature": [t]})

    shape = "lang string, chance double, apart boolean, places array<int>, counts array<int>"
    found = sample.mapInArrow(sparse, shape).groupBy(F.lit(0).alias("all")).applyInArrow(lambda t: fitted(t), "weights binary, temperature double").collect()
    if not found:
        return Model([], np.zeros(0), np.zeros((0, 0)), 1.0, settings)
    weights = np.frombuffer(found[0]["weights"], dtype="<f4").reshape(-1, len(languages))
    return Model(languages, idf.astype(np.float32), weights, found[0]["temperature"], settings)


def identify(df: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row's whole ``text``.

    A null text is empty; without a letter the language is ``und`` and the score 0. Null and repeated ids
    are kept, equal texts are answered alike, and without rows the result is empty. Other columns are
    ignored, whatever their names.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # places x languages numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.sliced(batch):
                names, scores = shared.value.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def accepted(df: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows, with all their columns, whose text has a language of probability ``least`` or more.

    Rows whose text is null or has no letter are not among them; rows that repeat stay or go together.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.sliced(batch):
                names, scores = shared.value.predict(part.column("text"))
                yield part.filter(pa.array([n != UNKNOWN and s >= least for n, s in zip(names, scores.tolist(), strict=True)], pa.bool_()))

    return df.mapInArrow(run, df.schema)
