"""Pages of one template: near one another, and near-duplicates only where their own words are alike too."""

import random

import pytest

from skyledger.llm import setsketch
from skyledger.sources.paths import Staging
from tests.llm import plain


def pages(count, draw, shared=85, own=25, near=0):
    """Texts that share ``shared`` words; every ``near``-th repeats the page before but for one word at its end."""
    common = " ".join(f"t{i}" for i in range(shared))
    out = []
    for i in range(count):
        if near and i % near == near - 1:
            out.append(out[-1] + f" e{i}")
        else:
            size = own if isinstance(own, int) else draw.randint(*own)
            out.append(common + " " + " ".join(f"w{draw.randrange(10**9)}" for _ in range(size)))
    return out


def found(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in setsketch.near_duplicates(df).rows.collect()}


@pytest.mark.parametrize("block", [setsketch.ALL, 8])  # of clusters that fit in a block, and of larger ones
@pytest.mark.parametrize("shared,own", [(85, 25), (85, (5, 60)), (60, (0, 18)), (100, (10, 12))])
def test_components_of_templates_are_exact(spark, monkeypatch, block, shared, own):
    monkeypatch.setattr(setsketch, "ALL", block)
    draw = random.Random(shared)
    rows = pages(60, draw, shared, own, near=5) + pages(30, draw, shared, own)
    draw.shuffle(rows)
    assert found(spark, rows) == plain.components(dict(enumerate(rows)))


@pytest.mark.parametrize("block", [setsketch.ALL, 8])
def test_chains_of_edits_are_exact(spark, monkeypatch, block):
    """Each text is near the one before and far from the first."""
    monkeypatch.setattr(setsketch, "ALL", block)
    draw, rows = random.Random(4), []
    for start in range(3):
        words = [f"c{start}x{i}" for i in range(120)]
        for _ in range(40):
            at = draw.randrange(0, 116)
            words[at : at + 2] = [f"n{draw.randrange(10**9)}" for _ in range(2)]
            rows.append(" ".join(words))
    draw.shuffle(rows)
    assert found(spark, rows) == plain.components(dict(enumerate(rows)))


def met(spark, rows):
    """How many of these texts, each in a component of its own, meet others."""
    members = [(i, i, len(plain.shingles(t)), t) for i, t in enumerate(rows)]
    open_members = spark.createDataFrame(members, "id long, component long, n_shingles long, text string")
    return setsketch._groups(open_members, setsketch.DEFAULT, 75, Staging(spark)).count()


def test_pages_of_a_template_do_not_meet(spark):
    """Whatever their number: likeness 0.6, all in the same buckets, none alike."""
    texts = pages(1200, random.Random(6))
    assert met(spark, texts[:300]) == met(spark, texts) == 0
    assert found(spark, texts) == {i: i for i in range(1200)}
    assert met(spark, [*texts[:300], texts[7] + " e"]) == 2
