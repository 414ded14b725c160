"""Lattice scores against sums over all segmentations, and what reaches the driver."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skyledger.llm import lattice, queries, texts
from tests.llm import plain

MODEL = sentencepiece.SentencePieceProcessor(model_file=queries.SUBWORDS)


def first_probabilities():
    """Of pieces and bytes and of the end, by rank."""
    ids = [i for i in range(MODEL.vocab_size()) if not (MODEL.is_control(i) or MODEL.is_unknown(i) or MODEL.is_byte(i) or MODEL.is_unused(i))]
    order = sorted(ids, key=lambda i: -MODEL.get_score(i))
    weight = {MODEL.id_to_piece(i): 1 / (r + 10) for r, i in enumerate(order)}
    weight |= {b: 1 / (len(ids) + 10) for b in range(257)}
    total = sum(weight.values())
    return {k: w / total for k, w in weight.items()}


LONGEST = max(len(MODEL.id_to_piece(i)) for i in range(MODEL.vocab_size()))


def edges(word, end):
    """(start, units) of all ways to reach ``end`` by one piece, or by the bytes of one character."""
    yield end - 1, tuple(word[end - 1].encode())
    for start in range(max(0, end - LONGEST), end):
        yield start, (word[start:end],)


def forward(word, p):
    out = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        out[end] = sum(out[start] * math.prod(p.get(u, 0.0) for u in units) for start, units in edges(word, end))
    return out


def expected_counts(words, p):
    found = defaultdict(float)
    for word, times in words.items():
        before = forward(word, p)
        after = [0.0] * len(word) + [1.0]
        for end in range(len(word), 0, -1):
            for start, units in edges(word, end):
                after[start] += after[end] * math.prod(p.get(u, 0.0) for u in units)
        for end in range(1, len(word) + 1):
            for start, units in edges(word, end):
                share = before[start] * math.prod(p.get(u, 0.0) for u in units) * after[end] / before[-1]
                for u in units:
                    found[u] += times * share
    return found


def brute(rows, prior=lattice.PRIOR):
    """score by doc_id."""
    train = [plain.words(t) for i, t in rows if plain.remainder(i, 7) != 2]
    p = first_probabilities()
    counts = expected_counts(Counter("▁" + w for words in train for w in words), p)
    counts[256] = len(train)
    total = sum(counts.values()) + prior
    p = {k: (counts.get(k, 0.0) + prior * x) / total for k, x in p.items()}
    return {i: sum(math.log10(forward("▁" + w, p)[-1]) for w in plain.words(t)) + math.log10(p[256]) for i, t in rows}


TEXTS = [
    "the quick brown fox jumps over the lazy dog", "the lazy dog sleeps", "", None, "İstanbul ça va ▁ odd🎉", "aaaaaaaaaa aaaa aa the",
    "日本語のテキスト", "the the THE", "x", "un deux trois", "12 345 6789", "fox fox jumps",
]


def scored(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r for r in lattice.score(df, texts.remainder(F.col("doc_id"), 7) == 2, queries.SUBWORDS, **options).collect()}


def test_score_is_the_sum_over_all_segmentations(spark):
    rows = list(enumerate(TEXTS))
    found, expected = scored(spark, rows), brute(rows)
    assert {i: r["score"] for i, r in found.items()} == pytest.approx(expected, abs=1e-8)


def test_words_looked_up_and_words_joined_score_alike(spark):
    rows = list(enumerate([*TEXTS, "ab" * 25_000, "ab" * 25_000 + " fox", "c" * 1024 + " " + "c" * 1025]))
    looked_up, joined = scored(spark, rows), scored(spark, rows, frequent=0)
    for i, r in looked_up.items():
        assert (r["n_known"], r["n_tokens"]) == (joined[i]["n_known"], joined[i]["n_tokens"])
        assert np.allclose([r["score"], r["base_score"]], [joined[i]["score"], joined[i]["base_score"]], rtol=1e-9)


def test_the_frequent_words_are_bounded_in_bytes(spark):
    long = [("文" * 5000 + str(i), 9) for i in range(500)]
    short = [(f"w{i}", 1 + i % 5) for i in range(1000)]
    table = spark.createDataFrame([*long, *short, ("none", 0)], "word string, n long")
    assert lattice._frequent(table, 1 << 18).count() == 1000
    few = lattice._frequent(table, 1 << 18, most_bytes=20_000).collect()
    assert 0 < sum(len(r["word"]) + 24 for r in few) <= 20_000 and min(r["n"] for r in few) == 4
    assert lattice._frequent(table, 1 << 18, most_bytes=100).count() == 0 and lattice._frequent(table, 10).count() == 0
