"""The search on a whole group, with the production defaults."""

import numpy as np

from skyledger.llm import packing, queries


def improves(lengths, bins, fills, source):
    """Whether a move, or an exchange of one or two pieces for a shorter one, into a bin at least as full is possible."""
    own = lengths[bins == source]
    room = np.where((fills < 2048) & (fills >= fills[source]), 2048 - fills, 0)
    room[source] = 0
    if own.min() <= room.max():
        return True
    offers = np.unique([*own, *(a + b for i, a in enumerate(own) for b in own[i + 1 :])])
    gain = offers[:, None] - lengths
    return bool(((gain > 0) & (gain <= room[bins])).any())


def test_no_sequence_of_a_whole_group_can_be_improved():
    rng = np.random.default_rng(3)
    lengths = -np.sort(-rng.integers(600, 1301, packing.GROUP))
    first = packing.best_fit(lengths, 2048)
    bins = packing.local_search(lengths, first, 2048)
    fills = np.bincount(bins, weights=lengths).astype(np.int64)
    assert fills.sum() == lengths.sum() and fills.max() <= 2048
    assert (fills > 0).sum() < (np.bincount(first) > 0).sum() - 150
    underfull = np.flatnonzero((fills > 0) & (fills < 2048))
    for source in rng.choice(underfull, min(200, len(underfull)), replace=False):
        assert not improves(lengths, bins, fills, source)


def test_many_groups_and_rounds_keep_every_piece(spark):
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(i, " a" * int(n)) for i, n in enumerate(rng.integers(600, 1301, 400))], "doc_id long, text string")
    found = packing.pack(rows, queries.BYTES, group=50).collect()
    places = {}
    for r in found:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(r["doc_id"] for r in found) == list(range(400))
    for held in places.values():
        ends = np.cumsum([n for _, n in sorted(held)])
        assert [a for a, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 2048
