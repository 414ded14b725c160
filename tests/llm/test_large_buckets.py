"""A bucket with most of all classes: its rows are dealt over all tasks, and the groups stay exact."""

from skyledger.llm import setsketch
from tests.llm import plain

PASSAGE = [f"p{i}" for i in range(80)]


def _texts() -> dict:
    """240 near copies of one passage, each with a word of its own, 40 pairs of near copies, 40 texts apart."""
    found = {i: " ".join(PASSAGE[:40] + [f"own{i}"] + PASSAGE[40:]) for i in range(240)}
    for i in range(40):
        words = [f"q{i}x{j}" for j in range(60)]
        found |= {1000 + 2 * i: " ".join(words), 1001 + 2 * i: " ".join([*words[:-1], "end"])}
        found[2000 + i] = " ".join(f"r{i}x{j}" for j in range(30))
    return found


def test_a_large_bucket_is_exact(spark):
    texts = _texts()
    rows = setsketch.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).rows.collect()
    expected = plain.components(texts)
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert len({expected[i] for i in range(240)}) == 1 and sum(r["kept"] for r in rows) == 81
