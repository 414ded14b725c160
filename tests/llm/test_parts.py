"""Parts of the operators against plain definitions."""

import itertools
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from skyledger.llm import bpe, langid, lattice, mixing, packing, secrets, setsketch, texts, topk, weighted, wordtokens
from tests.llm import plain

ALPHABET = " ab'sS\n\t\x0b\x1c\x1f\x85é1,.İΣ́ß日　"


def random_texts(seed, count=1500, alphabet=ALPHABET):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(count)]


ODD = ["", " ", "x<|endoftext|>y  <|endoftext|> z", "<|startoftext|>", "don't it's  'LL", "\n\n a", "a \n b", "tab\tx y\n\nz", "A_B a_b", "`` ''"]


def test_words_are_split_as_defined():
    given = [*random_texts(1), None]
    words = texts.split_words(pa.array(given))
    entries = words.vocabulary.to_pylist()
    for i, text in enumerate(given):
        assert [entries[c] for c in words.codes[words.offsets[i] : words.offsets[i + 1]]] == plain.words(text)


def test_ids_are_the_librarys():
    own = bpe.byte_level(public_tokenizers.path("byte_bpe_50k.json"))
    given = [*ODD, *random_texts(2), None]
    for text, ids in zip(given, own.encode(pa.array(given)), strict=True):
        assert ids.tolist() == own.whole(text or "").tolist(), repr(text)


def test_counts_are_the_librarys():
    own = wordtokens.word_tokens(public_tokenizers.path("word_bpe_49k.json"))
    assert own.by_word and len(own.single) > 20_000
    given = [*ODD, *random_texts(3), None]
    for text, count in zip(given, own.count(pa.array(given)).tolist(), strict=True):
        assert count == own.whole(text or ""), repr(text)


def test_collisions_estimate_generalised_jaccard():
    rng = random.Random(4)
    pairs = []
    for share in np.linspace(0, 1, 60):
        a = [f"w{rng.randint(0, 80)}" for _ in range(200)]
        b = [w if rng.random() < share else f"v{rng.randint(0, 80)}" for w in a]
        pairs.append((" ".join(a), " ".join(b)))
    one, other = (weighted.fingerprints(pa.array([p[i] for p in pairs]), samples=256) for i in (0, 1))
    errors = weighted.likeness(one, other) - np.array([plain.jaccard(a.split(), b.split()) for a, b in pairs])
    assert abs(errors.mean()) < 0.01 and errors.std() < 0.045


def test_fingerprints_do_not_depend_on_neighbours():
    given = ["a b c a", "x y", "", "a b c a"]
    together = weighted.fingerprints(pa.array(given))
    alone = np.concatenate([weighted.fingerprints(pa.array([t])) for t in given])
    assert (together == alone).all()


def test_sketches_merge_and_estimate():
    sketch, rng = setsketch.DEFAULT, np.random.default_rng(5)
    members = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = members[:2000], members[400:]
    assert (sketch.merged(sketch.of(a), sketch.of(b)) == sketch.of(members)).all()
    estimate = sketch.similarity(sketch.of(a)[None], sketch.of(b)[None], np.array([2000.0]), np.array([2600.0]))[0]
    assert abs(estimate - 1600 / 3000) < 0.15
    assert (setsketch.Sketch().seeds == sketch.seeds).all()


def variants(rng, count, most, words=120):
    base = [f"b{i}" for i in range(words)]
    out = []
    for i in range(count):
        share = rng.uniform(0, most)
        out.append(" ".join(w if rng.random() > share else f"x{i}n{rng.randint(0, 10**6)}" for w in base))
    return out


def test_groups_that_hang_together_in_many_ways(spark, monkeypatch):
    """Near and less near variants, chains, short texts; small blocks, so that clusters are cut."""
    monkeypatch.setattr(setsketch, "APART", 16)
    monkeypatch.setattr(setsketch, "ALL", 24)
    monkeypatch.setattr(setsketch, "TOGETHER", 2000)
    rng = random.Random(6)
    given = variants(rng, 150, 0.12)
    chain = [f"c{i}" for i in range(150)]
    given += [" ".join(chain[i : i + 80]) for i in range(0, 70, 5)]
    given += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    rng.shuffle(given)
    rows = [(10 * i + 3, t) for i, t in enumerate(given)]
    found = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).rows.collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == plain.components(dict(rows))


def test_a_word_weighs_the_sum_over_its_segmentations():
    pieces = lattice.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    scorer = lattice.Lattice(pieces, pieces.prior)
    known = {h: p for h, p in zip(pieces.hashes.tolist(), pieces.places.tolist(), strict=True) if p >= 0}

    def chance(string):
        h = np.zeros(1, dtype=np.uint64)
        for point in lattice._points(string):
            h = lattice._next(h, point)
        total = pieces.prior[known[int(h[0])]] if int(h[0]) in known else 0.0
        return total + (np.prod([pieces.prior[pieces.byte + b] for b in string.encode()]) if len(string) == 1 else 0.0)

    words = ["the", "cat", "é", "日", "xq", "a", "token"]
    for word, log_p in zip(words, scorer.words(words), strict=True):
        marked, total = lattice.MARK + word, 0.0
        for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(marked)]
            total += np.prod([chance(marked[a:b]) for a, b in itertools.pairwise(at)])
        assert np.exp(log_p) == pytest.approx(total)
    gathered = np.zeros(len(pieces.prior))
    scorer.words(["the", "the", "cat"], np.array([2.0, 1.0, 5.0]), gathered)
    assert gathered.sum() >= 8 and gathered.min() >= 0
    assert abs(pieces.prior.sum() - 1) < 1e-9


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(7)
    sizes = np.sort(rng.integers(0, 5000, 2000))[::-1]
    chances = np.full(2000, 0.3)
    flown = mixing.flight(sizes, chances, rng.random(2000), apart=5)
    undecided = (flown > 0) & (flown < 1)
    assert undecided.sum() <= 7
    assert flown.sum() == pytest.approx(chances.sum()) and flown @ sizes == pytest.approx(chances @ sizes)
    landed = mixing.landing(sizes, flown)
    assert set(landed) <= {0.0, 1.0} and abs(landed @ sizes - chances @ sizes) < 0.002 * (chances @ sizes)


def test_flight_is_fair():
    rng = np.random.default_rng(8)
    sizes, chances = np.array([9, 7, 7, 5, 4, 3, 2, 1, 1, 0]), np.full(10, 0.4)
    taken = np.mean([mixing.flight(sizes, chances, rng.random(10), apart=0) for _ in range(4000)], axis=0)
    assert np.abs(taken - chances).max() < 0.03


def test_several_blocks_fly_apart_and_land_together(spark):
    rng = random.Random(9)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", rng.randint(0, 900)) for i in range(3000)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long"), block=100).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(3000))
    for source in {s for _, s, _ in rows}:
        own = [r for r in found if r["source"] == source]
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.002)


def test_local_search_raises_fills_and_empties_bins():
    rng = np.random.default_rng(10)
    worst = 0
    for _ in range(8):
        lengths = rng.integers(200, 1300, 400)
        first = packing.best_fit(lengths, 2048)
        better = packing.local_search(lengths, first, 2048, tried=200)
        fills = [np.bincount(b, weights=lengths) for b in (first, better)]
        assert max(f.max() for f in fills) <= 2048
        assert (fills[1] ** 2).sum() >= (fills[0] ** 2).sum()
        used = [(f > 0).sum() for f in fills]
        assert used[1] <= used[0]
        worst = max(worst, used[1] - -(-lengths.sum() // 2048))
    assert worst <= 16


def test_one_exchange_step():
    lengths = np.array([900, 700, 1000, 1000, 600, 500])
    bins = np.array([0, 0, 1, 1, 2, 2])
    fills = np.bincount(bins, weights=lengths).astype(np.int64)
    before = (fills**2).sum()
    assert packing._improve(lengths, bins, fills, 2, 2048)
    assert (fills**2).sum() > before and (np.bincount(bins, weights=lengths) == fills).all()


def test_language_model_is_sparse_and_calibrated():
    rng = random.Random(11)
    settings = langid.Settings(places=1 << 12, epochs=3)
    sounds = {"x": "ka to mi ra ne", "y": "bru gla stro fen", "z": "oo aa ee iu uo"}
    given = [(k, " ".join(rng.choice(v.split()) + rng.choice(["", "n"]) for _ in range(rng.randint(1, 6)))) for k in sounds for v in [sounds[k]] for _ in range(200)]
    names = sorted(sounds)
    found = [langid.features(t, settings) for _, t in given]
    idf = np.ones(settings.places)
    rows = [(p, langid.weighted(p, c, idf)) for p, c in found]
    labels = np.array([names.index(k) for k, _ in given])
    weights = langid.fit(rows[::2], labels[::2], 3, settings)
    scores = np.array([v @ weights[p] + weights[-1] for p, v in rows[1::2]])
    assert (scores.argmax(axis=1) == labels[1::2]).mean() > 0.95
    assert (weights == 0).mean() > 0.9
    noisy = np.where(np.arange(len(labels[1::2])) % 8 == 0, (labels[1::2] + 1) % 3, labels[1::2])
    assert langid.temperature(scores * 7, noisy) == pytest.approx(7 * langid.temperature(scores, noisy), rel=0.01)


def test_tokens_with_a_checksum():
    body = "aB3dE5gH7jK9mN1pQ3sT5vW7yZ9bC1"
    good = f"ghp_{body}{secrets.crc32_base62(body)}"
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    text = f"İé {good} and {bad} npm_{body}{secrets.crc32_base62(body)}"
    found = secrets.spans(text)
    assert [(secrets.KINDS[k].name, text[a:b]) for a, k, b in found] == [("github", good), ("npm", text.split()[-1])]
    assert secrets.redacted(text, found) == f"İé [REDACTED] and {bad} [REDACTED]"


def test_base_secrets_equal_plain_expressions():
    rng = random.Random(12)
    bits = ["password", "PassWd", "ſecret", "secret", "toKen", "toKen", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abcdefgh", "AKIA", "ABCDEFGH1234", "0123456789abcdef" * 2, "f", "\n", "é", "/+."]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        assert [s for s in secrets.spans(text) if secrets.KINDS[s[1]].base] == plain.secrets(text), repr(text)


def test_best_of_a_block_with_ties():
    rng = np.random.default_rng(13)
    for _ in range(200):
        scores, ids = rng.integers(-3, 4, 30), np.arange(30) * 2
        own = int(rng.integers(0, 60))
        expected = sorted((i for i in range(30) if ids[i] != own), key=lambda i: (-scores[i], ids[i]))[:5]
        assert topk.best(scores, ids, ids, own, 5).tolist() == expected
