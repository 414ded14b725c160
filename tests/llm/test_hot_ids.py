"""A third of all rows without an id, or with the same one: dealt over several tasks, with results in order."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import blocks, mixing, queries, spread, tokenfiles, weighted
from skyledger.sources.paths import Staging


def many(hot, count=3000, seed=1):
    """(id, text): a third have the id ``hot``."""
    draw = random.Random(seed)
    text = lambda: " ".join(draw.choice("abcdefghijk") + str(draw.randrange(50)) for _ in range(draw.randrange(1, 9)))
    return [(hot if i % 3 == 0 else i, text()) for i in range(count)]


def key(row):
    return (blocks.LEAST if row[0] is None else row[0], row[1])


@pytest.mark.parametrize("hot", [None, 1500, 5000])
def test_blocks_of_a_hot_id(spark, hot):
    rows = many(hot)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    starts = blocks.bounds(df)
    placed = blocks.in_blocks(df, starts, heads=True)
    found = placed.select(F.spark_partition_id().alias("part"), "block", "head", "doc_id", "text").collect()
    own = [r for r in found if not r["head"]]
    sizes = np.bincount([r["part"] for r in own])
    assert sizes.max() <= 2 * np.median(sizes) and len(sizes) >= 8
    assert sorted(((r["doc_id"], r["text"]) for r in own), key=key) == sorted(rows, key=key)
    in_order = [(r["doc_id"], r["text"]) for r in sorted(own, key=lambda r: r["block"])]  # rows of a partition come in order
    assert in_order == sorted(rows, key=key)
    firsts = {}
    for r in own:
        firsts.setdefault(r["block"], key((r["doc_id"], r["text"])))
    heads = {r["block"]: key((r["doc_id"], r["text"])) for r in found if r["head"]}
    count = len(starts)
    assert heads == {b: firsts[(b + 1) % count] for b in range(count)} and sum(r["head"] for r in found) == count


@pytest.mark.parametrize("hot", [None, 1500])
def test_fingerprints_of_a_hot_id_follow_one_another(spark, hot):
    rows = sorted(many(hot, 600), key=key)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    edits = {}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        edits.setdefault(i, []).append(weighted.edited(text, following))
    found = {}
    for r in weighted.with_edits(df).collect():
        found.setdefault(r["doc_id"], []).append(r["edited_sha256"])
    import hashlib

    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {i: sorted(x) for i, x in found.items()} == {i: sorted(map(digest, x)) for i, x in edits.items()}


def test_token_files_of_a_hot_id(spark):
    rows = many(None, 600)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = Staging(spark).folder
    manifest = tokenfiles.write(df, folder, queries.BYTES)
    found = tokenfiles.read(spark, folder, tokenfiles.ids_crc32, "ids_crc32").collect()
    starts = sorted((r["start"], r["n_tokens"], key((r["doc_id"], ""))[0]) for r in found)
    assert len(found) == 600 and [s[2] for s in starts] == sorted(s[2] for s in starts)
    assert all(a[0] + a[1] == b[0] for a, b in zip(starts[:-1], starts[1:])) and manifest.agg(F.max("documents")).first()[0] < 200


class Recording(Staging):
    frames: dict = {}

    def __call__(self, df, name):
        return self.frames.setdefault(name, super().__call__(df, name))


def test_mixing_spreads_rows_alike(spark, monkeypatch):
    rows = [(None, "a", 5 + i % 2) for i in range(4000)] + [(i, "a", 3 + i % 11) for i in range(2000)] + [(i, "b", 40) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    again = mixing.mix(df, block=500).collect()
    monkeypatch.setattr(mixing, "Staging", Recording)
    found = mixing.mix(df, block=500).collect()
    assert len(found) == len(rows) and sorted(map(str, found)) == sorted(map(str, again))
    blocks_held = Recording.frames["round-1"].groupBy("source", "block").count().collect()
    assert max(r["count"] for r in blocks_held) < 1.5 * 500
    goal = {r["source"]: r["target"] for r in found}
    for source, longest in (("a", 13), ("b", 40)):
        assert abs(sum(r["taken"] for r in found if r["source"] == source) - goal[source]) <= longest / 2


def test_rows_without_an_id_are_mixed_by_row(spark):
    rows = [(None, f"text number {i} of {'x ' * (i % 5)}", "s", "en") for i in range(300)] + [(7, f"more {i}", "t", "en") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = corpus_pipeline.mixed(spark, docs, "").collect()
    texts = [r["text"] for r in found]
    assert set(texts) <= {r[1] for r in rows} and max(texts.count(t) for t in set(texts)) <= 2 and len(set(texts)) > 300


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_counted_is_a_join(spark, how):
    rows = spark.createDataFrame([(None if i % 50 == 0 else i % 3 if i % 2 else i, i) for i in range(400)], "k long, v long")
    table = spark.createDataFrame([(0, 60, "a"), (1, 70, "b"), (8, 1, "c"), (999, 1, "d")], "k long, n long, name string")
    expected = sorted(map(str, rows.join(table, "k", how).select("k", "v", "n", "name").collect()))
    assert sorted(map(str, spread.join_counted(rows, table, "k", "n", how).select("k", "v", "n", "name").collect())) == expected
