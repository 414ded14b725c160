"""Rows without an id, or with one that repeats, are decided on by their own texts."""

import corpus_pipeline
from skyledger.llm import setsketch

FOX, SHIP, TREE, RIVER = (
    "the quick brown fox jumps over the lazy dog by the door",
    "a small ship sails along the coast in the early morning light",
    "an old tree stands alone upon the hill above our quiet village",
    "the wide river carries ice and timber down to the northern sea",
)
SHAPE = "doc_id long, text string"


def found(spark, rows):
    out = setsketch.near_duplicates(spark.createDataFrame(rows, SHAPE)).rows.collect()
    return sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in out), key=str)


def stays(spark, rows):
    return sorted((tuple(r) for r in corpus_pipeline.deduplicated(spark, spark.createDataFrame(rows, SHAPE), "").collect()), key=str)


def test_unrelated_rows_without_an_id_are_not_linked(spark):
    rows = [(1, FOX), (None, FOX + " today"), (None, SHIP), (None, TREE), (None, TREE), (None, "")]
    expected = [(1, 1, True), (None, 1, False), (None, None, True), (None, None, True), (None, None, False), (None, None, True)]
    assert found(spark, rows) == sorted(expected, key=str)


def test_unrelated_rows_of_an_id_are_not_linked(spark):
    rows = [(1, FOX), (2, FOX + " today"), (2, SHIP), (3, SHIP + " today"), (4, TREE)]
    assert found(spark, rows) == [(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (4, 4, True)]


def test_many_different_texts_without_an_id(spark):
    rows = [(None, " ".join(f"w{i}x{j}" for j in range(8))) for i in range(300)] + [(7, SHIP)]
    assert [k for *_, k in found(spark, rows)] == [True] * 301


def test_stage_removes_rows_and_not_ids(spark):
    rows = [(1, FOX), (None, FOX + " today"), (None, SHIP), (None, TREE), (None, TREE)]
    assert stays(spark, rows) == sorted([(1, FOX), (None, SHIP), (None, TREE)], key=str)


def test_a_copy_does_not_take_the_other_texts_of_its_id(spark):
    rows = [(1, FOX), (2, FOX), (2, RIVER), (3, SHIP), (3, SHIP), (4, ""), (4, "")]
    assert stays(spark, rows) == [(1, FOX), (2, RIVER), (3, SHIP), (4, "")]
