"""Alignment of two vocabularies against a walk over the tokens of each document."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from skyledger.llm import alignment, bpe, queries

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

FIRST = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = {letter: byte for byte, letter in bpe._byte_letters().items()}


def spelled(text):
    """Tokens of either vocabulary as (id, bytes)."""
    a = [(i, bytes(LETTERS[c] for c in FIRST.id_to_token(i))) for i in FIRST.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in SECOND.encode(text):
        piece = SECOND.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if SECOND.is_byte(i) else piece.replace("▁", " ").encode()))
    given = (" " + text).encode()
    joined = [b"".join(x for _, x in t) for t in (a, b)]
    return (a, b) if text and joined == [given, given] else ([], [])


def groups(a, b):
    """Lists of ids that end together."""
    out, at, ends = [], [0, 0], [0, 0]
    i = j = 0
    while i < len(a) or j < len(b):
        if ends[0] <= ends[1]:
            ends[0] += len(a[i][1])
            i += 1
        else:
            ends[1] += len(b[j][1])
            j += 1
        if ends[0] == ends[1]:
            out.append(([x for x, _ in a[at[0] : i]], [x for x, _ in b[at[1] : j]]))
            at = [i, j]
    return out


def brute(rows):
    tokens = [spelled(text or "") for _, text in rows]
    cut = [groups(*t) for t in tokens]
    linked = [Counter((x, y) for g in c for x in g[0] for y in g[1]) for c in cut]
    count = Counter(pair for links in linked for pair in links)
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    out = []
    for (doc_id, _), (a, b), c, links in zip(rows, tokens, cut, linked, strict=True):
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in c)
        best = sum(n for p, n in links.items() if count[p] == highest[p[0]])
        total = sum(n * count[p] for p, n in links.items())
        sha = hashlib.sha256(written.encode()).hexdigest() if c else ""
        out.append((doc_id, len(a), len(b), len(c), sum(links.values()), best, total, sha))
    return out


def same(df, rows):
    assert sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str) == sorted(brute(rows), key=str)


def aligned(df):
    return alignment.alignment(df, queries.BYTES, queries.SUBWORDS)


def test_query_equals_brute_force(spark, small, table):
    same(queries.op12_alignment(spark, small), [(d, t) for d, t, *_ in table])


def test_odd_rows(spark, odd):
    same(aligned(odd), [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()])


def test_odd_texts(spark):
    texts = [
        "<|endoftext|> and <s> </s> <unk> <0x41>", "▁under▁lined", "日本語のテキスト🎉🎉", "tabs\tand\n\nlines  with   blanks ", " ", "\x00\x01",
        "ﬁne ½ İ", "a" * 5000, "é" * 999, "<|endoftext|>", None, "", "same text", "same text", "é ‍ x y", "\U0010ffff�",
    ]
    rows = list(enumerate(texts))
    same(aligned(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_slices_do_not_change_results(spark, monkeypatch, small, table):
    monkeypatch.setattr(alignment, "SLICE", 2000)
    rows = [(d, t) for d, t, *_ in table[:60]]
    same(aligned(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_no_rows(spark, none):
    assert aligned(none).collect() == []


def test_a_text_of_other_bytes_has_no_tokens(spark):
    found = aligned(spark.createDataFrame([(1, "▁"), (2, "plain")], "doc_id long, text string")).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert tuple(by_id[1])[1:] == (0, 0, 0, 0, 0, 0, "") and by_id[2]["n_groups"] > 0
