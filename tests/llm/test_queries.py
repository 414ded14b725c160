"""Each registered query over the whole smallest tables, against a plain version."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from skyledger.llm import queries
from tests.llm import plain

BYTES = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def rows(spark, small, name):
    return queries.queries()[name](spark, small).collect()


def by_id(found):
    return {r["doc_id"]: r for r in found}


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))


def test_fingerprints(spark, small, table):
    found = by_id(rows(spark, small, "op1_fingerprints"))
    assert len(found) == len(table)
    errors = []
    for i, (doc_id, text, *_) in enumerate(table):
        text, following = text or "", table[(i + 1) % len(table)][1] or ""
        quarter, r = len(text) // 4, found[doc_id]
        edited = text[: len(text) - quarter] + following[:quarter]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        errors.append((r["near_edited"] - plain.jaccard(plain.words(text), plain.words(edited))))
        errors.append((r["near_next"] - plain.jaccard(plain.words(text), plain.words(following))))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.07
    same = defaultdict(set)
    for doc_id, text, *_ in table:
        same[text].add(found[doc_id]["fingerprint"])
    assert all(len(s) == 1 for s in same.values())


def test_mixing(spark, small, table):
    found = rows(spark, small, "op2_mixing")
    size = {d: len(plain.words(t)) for d, t, *_ in table}
    assert {r["doc_id"]: r["size"] for r in found} == size
    source = {d: s for d, _, _, s, _ in table}
    totals = defaultdict(int)
    for d, s in source.items():
        totals[s] += size[d]
    goal = plain.targets(totals)
    taken = defaultdict(int)
    for r in found:
        s = source[r["doc_id"]]
        assert r["source_size"] == totals[s] and r["target"] == pytest.approx(goal[s])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 0.03 * goal[s] + 1 for s in goal)
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, rows(spark, small, "op2_mixing")), key=str)


def test_language_id(spark, small, table):
    found = rows(spark, small, "op3_language_id")
    lang = {d: x for d, _, x, *_ in table}
    assert all(r["held_out"] == (plain.remainder(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in found)
    held_out = [r["lang_pred"] == lang[r["doc_id"]] for r in found if r["held_out"]]
    assert len(found) == len(table) and np.mean(held_out) > 0.97


def test_secrets(spark, small, table):
    found = by_id(rows(spark, small, "op4_secrets"))
    assert len(found) == len(table)
    for doc_id, text, *_ in table:
        spans, r = plain.secrets(text), found[doc_id]
        listed = ",".join(f"{plain.BASE[k][0]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_token_counts(spark, small, table):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {d: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, *_ in table}
    found = rows(spark, small, "op5_token_counts")
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in found} == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in found)


def test_token_files(spark, small, table):
    expected, start = {}, 0
    for d, t, *_ in table:
        ids = BYTES.encode(t or "", add_special_tokens=False).ids + [0]
        expected[d] = (start, len(ids), plain.crc32(ids))
        start += len(ids)
    found = rows(spark, small, "op6_token_files")
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in found} == expected


def test_top_k(spark, small):
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
        expected = db.sql(queries.TOP_K).fetchall()
    assert sorted(map(tuple, rows(spark, small, "op7_top_k"))) == sorted(expected)


def test_lattice_scores(spark, small, table):
    found = by_id(rows(spark, small, "op8_lattice_scores"))
    expected, total = plain.base_scores([(d, t) for d, t, *_ in table])
    for d, (n_tokens, n_known, base) in expected.items():
        r = found[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6) and r["score"] < 0
        assert r["held_out"] == (plain.remainder(d, 7) == 2)


def packing_is_right(found, texts):
    """Pieces of each text as they must be cut, side by side in their sequences; returns the number of sequences."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = defaultdict(list)
    for doc_id, text in texts:
        ids = BYTES.encode(text or "", add_special_tokens=False).ids + [0]
        cut = plain.pieces(ids, 2048)
        expected[doc_id] += [(i, a, n, plain.crc32(ids[a : a + n])) for i, (a, n) in enumerate(cut)]
    assert {d: sorted(x) for d, x in pieces.items()} == {d: sorted(x) for d, x in expected.items()}
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places), -(-sum(n for x in expected.values() for _, _, n, _ in x) // 2048)


def test_packing(spark, small, table):
    used, least = packing_is_right(rows(spark, small, "op9_packing"), [(d, t) for d, t, *_ in table])
    assert used <= 1.02 * least + 1


def test_near_duplicates(spark, small, table):
    expected = plain.components({d: t for d, t, *_ in table})
    found = by_id(rows(spark, small, "op10_near_duplicates"))
    assert {d: r["component_id"] for d, r in found.items()} == expected
    for d, t, *_ in table:
        assert (found[d]["n_shingles"], found[d]["kept"]) == (len(plain.shingles(t)), expected[d] == d)


def test_near_duplicates_by_sql(spark, small, table):
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
        found = db.sql(queries.NEAR_DUPLICATES).fetchall()
    expected = plain.components({d: t for d, t, *_ in table})
    assert {r[0]: r[2] for r in found} == expected


def test_pipeline(spark, small, table):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, {d: t for d, t, *_ in table}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{name}"
        stage(spark, docs, small).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        assert docs.columns == columns
        texts = {r["doc_id"]: r["text"] for r in before}
        if name == "language_id":
            assert {r["doc_id"] for r in after} == {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
        if name == "near_duplicates":
            expected = plain.components(texts)
            assert {r["doc_id"] for r in after} == {d for d in texts if expected[d] == d}
        if name == "secrets":
            assert len(after) == len(before)
            for r in after:
                spans = plain.secrets(texts[r["doc_id"]])
                assert (r["text"] == texts[r["doc_id"]]) == (not spans) and not plain.secrets(r["text"])
                assert r["n_chars"] == len(r["text"])
        if name == "mixing":
            sizes, totals, taken = {d: len(plain.words(t)) for d, t in texts.items()}, defaultdict(int), defaultdict(int)
            for r in before:
                totals[r["source"]] += sizes[r["doc_id"]]
            for r in after:
                taken[r["source"]] += sizes[r["doc_id"]]
                assert r["text"] == texts[r["doc_id"]]
            goal = plain.targets(totals)
            assert all(abs(taken[s] - goal[s]) <= 0.05 * goal[s] + 1 for s in goal)
    kept = [(r["doc_id"], r["text"]) for r in docs.collect()]
    packing_is_right(corpus_pipeline.STAGES[-1][1](spark, docs, small).collect(), kept)
