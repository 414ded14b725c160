"""Near-duplicate documents by SetSketch registers of their word shingles.

A document's set is its distinct runs of five words, A to Z in lower case (with fewer
words: all of them as one). Register i of its sketch is ``floor(1 - log_b h)``, cut to
[0, q + 1], of the least of exponentially distributed hashes h of the set's members:
sketches of parts merge by the greater register, and two sets agree in a register about as
often as their Jaccard similarity.

1. Sketch every document; documents with equal sets are one class from there on.
2. Cut the sketch into bands of registers; classes that agree in a band share a bucket.
   A pair at the threshold is in no common bucket with a chance of ``(1 - 0.75**4)**40``,
   under three in ten million, and a more similar pair with less.
3. Compare every member of a bucket with one of them, the centre: the member with most
   company over all buckets. Pairs whose likelihood estimate from registers and set sizes is
   far below the threshold are left out; all others are confirmed on their full sets.
4. The members of all buckets with the same centre are a cluster. Where a cluster's members do
   not all hang together yet, those apart from its largest component are compared with all
   members of other components, by estimate and then full sets, in blocks of bounded size; a
   block returns only links that join components.
5. In a cluster of more than a block that would be the square of its size. There members are
   compared in groups instead: two similar sets share a shingle that is rare in both, so early
   that what follows it in both can still make them similar, and members joined by such
   shingles are a group. Pages of one template share buckets but no such shingle.

So members that hang together by way of their centre are not compared with one another, no
pairs of a group are listed, and no link between different components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.components import components
from skyledger.llm.spread import join_counted
from skyledger.sources.paths import Staging

#: Stands for a null id, which comes last.
NO_ID = (1 << 63) - 1

SKETCHED = "row long, id long, text_hash long, n_shingles long, set_a long, set_b long, registers binary"


@dataclass(frozen=True)
class Sketch:
    """``b``, ``a`` and ``q`` as in the literature; ``rows`` registers of 16 bits are one band."""

    bands: int = 40
    rows: int = 4
    b: float = 1.001
    a: float = 20.0
    q: int = (1 << 16) - 2
    width: int = 5
    #: Pairs estimated this far below the threshold are not confirmed: five standard errors or more.
    margin: float = 0.2
    seeds: np.ndarray = field(init=False, compare=False, repr=False)
    factors: np.ndarray = field(init=False, compare=False, repr=False)

    def __post_init__(self):
        place = np.arange(1, self.registers + 1, dtype=np.uint64)
        object.__setattr__(self, "seeds", texts.mixed(place * np.uint64(0x9E3779B97F4A7C15)))
        object.__setattr__(self, "factors", texts.mixed(place * np.uint64(0xD1342543DE82EF95)) | np.uint64(1))

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    def of(self, members: np.ndarray) -> np.ndarray:
        """The registers of a set of 64-bit hashes."""
        least = np.full(self.registers, np.iinfo(np.uint64).max)
        for at in range(0, len(members), 512):
            scattered = (members[at : at + 512, None] ^ self.seeds) * self.factors
            np.minimum(least, scattered.min(axis=0), out=least)
        # The least of exponential hashes belongs to the least of uniform ones.
        uniform = (least.astype(np.float64) + 0.5) / 2.0**64
        exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / self.a
        return np.clip(np.floor(1 - np.log(exponential) / math.log(self.b)), 0, self.q + 1).astype("<u2")

    def merged(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The registers of the union."""
        return np.maximum(one, other)

    def keys(self, registers: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band of each row of ``registers``."""
        values = np.ascontiguousarray(registers).reshape(len(registers), self.bands, self.rows).astype(np.uint64)
        key = np.zeros(values.shape[:2], dtype=np.uint64)
        for i in range(self.rows):
            key = texts.mixed(key ^ values[:, :, i] + np.uint64((i + 1) << 20))
        return texts.mixed(key + np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def similarity(self, one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray) -> np.ndarray:
        """Most likely Jaccard similarity, given how often each side's register is greater and the set sizes."""
        above = (one > other).sum(axis=1)
        below = (one < other).sum(axis=1)
        equal = one.shape[1] - above - below
        u = n_one / (n_one + n_other)
        v = 1 - u

        def chance(x: np.ndarray) -> np.ndarray:
            return -np.log1p(-np.clip(x, 0, 1) * (self.b - 1) / self.b) / math.log(self.b)

        def likelihood(j: np.ndarray) -> np.ndarray:
            p, m = chance(u - v * j), chance(v - u * j)
            rest = np.maximum(1 - p - m, 1e-12)
            return above * np.log(np.maximum(p, 1e-12)) + below * np.log(np.maximum(m, 1e-12)) + equal * np.log(rest)

        low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
        ratio = (math.sqrt(5) - 1) / 2
        for _ in range(25):  # golden section: the likelihood has one peak
            left, right = high - ratio * (high - low), low + ratio * (high - low)
            better = likelihood(left) > likelihood(right)
            low, high = np.where(better, low, left), np.where(better, right, high)
        return (low + high) / 2


DEFAULT = Sketch()


def shingle_sets(column: pa.Array, width: int = 5) -> list[np.ndarray]:
    """The set of each whole text as sorted 64-bit hashes; empty without words."""
    words = texts.split_words(column)
    hashes = words.hashes()[words.codes]
    factors = texts.mixed(np.arange(1, width + 2, dtype=np.uint64)) | np.uint64(1)
    runs = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for i in range(width):
        runs += hashes[i : i + len(runs)] * factors[i]
    runs = texts.mixed(runs)
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            whole = (hashes[a:b] * factors[: b - a]).sum(keepdims=True)
            out.append(texts.mixed(whole + factors[width : width + 1] * np.uint64(b - a)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def sketches(documents: DataFrame, sketch: Sketch = DEFAULT) -> DataFrame:
    """A row for each (row, id, text): the hash of the text, set size, two checksums of the set (equal sets: equal), the registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.sliced(batch):
                sets = shingle_sets(part.column("text"), sketch.width)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("row", "id", "text_hash")),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(texts.mixed(s).sum().view(np.int64)) for s in sets], pa.int64()),
                        pa.array([int(texts.mixed(~s).sum().view(np.int64)) for s in sets], pa.int64()),
                        pa.array([sketch.of(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["row", "id", "text_hash", "n_shingles", "set_a", "set_b", "registers"],
                )

    return documents.select("row", "id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, SKETCHED)


def _banded(classes: DataFrame, sketch: Sketch) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), dtype="<u2")
            keys = sketch.keys(registers.reshape(batch.num_rows, sketch.registers))
            ids, sizes = (np.repeat(batch.column(c).to_numpy(), sketch.bands) for c in ("id", "n_shingles"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(ids), pa.array(sizes)], names=["key", "id", "n"]
            )

    return classes.select("id", "n_shingles", "registers").mapInArrow(run, "key long, id long, n long")


def _possible(one: str, other: str, percent: int) -> Column:
    """Two sets of these sizes can be similar enough."""
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def _registers(column: pa.ChunkedArray | pa.Array, sketch: Sketch) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(-1, sketch.registers)


def _estimated(pairs: DataFrame, members: DataFrame, sketch: Sketch, percent: int) -> DataFrame:
    """The pairs (a, b) whose estimate is not far below the threshold."""
    least = percent / 100 - sketch.margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n_one, n_other = (batch.column(c).to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
            one, other = (_registers(batch.column(c), sketch) for c in ("r_a", "r_b"))
            close = sketch.similarity(one, other, n_one, n_other) >= least
            yield batch.select(["a", "b", "n_b"]).filter(pa.array(close))

    def side(name: str) -> DataFrame:
        return members.select(F.col("id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").where(_possible("n_a", "n_b", percent))
    return both.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(run, "a long, b long, n_b long")


#: Shingles of the documents that one task compares with one centre.
TOGETHER = 1 << 20
#: Documents of a block that are apart from their centre, and of a block they are compared with.
APART, ALL = 256, 512


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * shared >= percent * (len(one) + len(other) - shared)


def _with_centres(close: DataFrame, members: DataFrame, percent: int, width: int, stage: Staging) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Documents compared with the same centre ``a`` are dealt to several groups of bounded
    size, each with a copy of the centre's text.
    """
    load = close.groupBy("a").agg(F.ceil(F.sum("n_b") / TOGETHER).cast("int").alias("salts"), F.count("*").alias("pairs"))
    load = stage(load, "load")
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("one_salt")
    text = members.select("id", "text")
    ones = load.join(text.withColumnRenamed("id", "a"), "a").select(F.col("a").alias("one"), salts, F.col("text").alias("one_text"))
    others = join_counted(close, load, "a", "pairs").withColumn("salt", F.pmod(F.hash("b"), "salts"))
    others = others.join(text.withColumnRenamed("id", "b"), "b").select("a", "salt", "b", "text")

    def compare(one: pa.Table, many: pa.Table) -> pa.Table:
        a, b = [], []
        if one.num_rows and many.num_rows:
            centres = shingle_sets(one.column("one_text").combine_chunks(), width)
            for other, s in zip(many.column("b").to_pylist(), shingle_sets(many.column("text").combine_chunks(), width), strict=True):
                if any(_similar(centre, s, percent) for centre in centres):
                    a.append(one.column("one")[0].as_py())
                    b.append(other)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return ones.groupBy("one", "one_salt").cogroup(others.groupBy("a", "salt")).applyInArrow(compare, "a long, b long")


def _groups(open_members: DataFrame, sketch: Sketch, percent: int, stage: Staging) -> DataFrame:
    """(id, grouped): members (id, n_shingles, text) by the least id they are joined with by rare shingles; those alone
    are left out.

    Shingles are in one order for all sets, by the number of members that have them. If the first
    that two sets share is at place i of the n of one, they have n - i in common at most, which
    tells the greatest size of the other. Shingles of one member only come first and join nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in texts.sliced(batch):
                sets = shingle_sets(part.column("text"), sketch.width)
                sizes = [len(s) for s in sets]
                columns = [np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)]
                columns += [np.repeat(part.column(c).to_numpy(), sizes) for c in ("id", "n_shingles")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "id", "n"])

    def counted(rows: DataFrame, name: str) -> DataFrame:
        shared = rows.groupBy("shingle").agg(F.count("*").alias("members"), F.min("n").alias("least"), F.min("id").alias("first"))
        return join_counted(rows, stage(shared.where("members > 1"), name), "shingle", "members")

    every = stage(open_members.select("id", "n_shingles", "text").mapInArrow(run, "shingle long, id long, n long"), "shingles")
    # A set's shingles are one list at a time, as long as its text.
    ordered = counted(every, "shared-1").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("members", "shingle", "least"))).alias("shared"))
    placed = ordered.select("id", "n", F.size("shared").alias("size"), F.posexplode("shared").alias("at", "one"))
    left = F.col("size") - F.col("at")  # of the set from here on
    most = F.floor(left * (100 + percent) / F.lit(percent)) - F.col("n")
    early = placed.select("id", "n", F.col("one.shingle").alias("shingle"), F.col("one.least").alias("smallest"), most.alias("most"))
    early = early.where((F.col("most") >= F.col("smallest")) & (100 * F.col("most") >= percent * F.col("n")))
    # Again among those that are early: the smallest set of a shingle may itself have it too late.
    again = counted(stage(early.select("id", "n", "shingle", "most"), "early"), "shared-2").where("most >= least and first <> id")
    found = components(again.select(F.col("first").alias("a"), F.col("id").alias("b")), stage, "groups")
    stage.remove("shingles", "shared-1", "early", "shared-2")
    return found.withColumnRenamed("component", "grouped")


def _among_members(clusters: DataFrame, members: DataFrame, sketch: Sketch, percent: int, stage: Staging) -> DataFrame:
    """Links (a, b) that join different components within a cluster: rows (centre, id, component).

    Members apart from the largest component, of a cluster or a group of a large one, are dealt
    to blocks, all members to other blocks, and each of the former meets each of the latter once.
    """
    least = percent / 100 - sketch.margin
    held = clusters.groupBy("centre").agg(F.min("component").alias("one"), F.max("component").alias("other"), F.count("*").alias("members"))
    held = stage(held.where("one <> other").select("centre", "members"), "open-clusters")
    rows = stage(join_counted(clusters, held, "centre", "members"), "open")
    together = rows.where(F.col("members") <= ALL).select((2 * F.col("centre")).alias("centre"), "id", "component")
    if not held.where(F.col("members") > ALL).isEmpty():
        large = stage(rows.where(F.col("members") > ALL).select("id", "component").distinct(), "large")
        grouped = _groups(members.join(large, "id"), sketch, percent, stage)
        grouped = large.join(grouped, "id").select((2 * F.col("grouped") + 1).alias("centre"), "id", "component")
        together = stage(together.unionByName(grouped), "open-groups")
    parts = together.groupBy("centre", "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("centre").agg(F.count("*").alias("parts"), F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("main"))
    sizes = sizes.where("parts > 1").select(
        "centre",
        "members",
        F.col("main.component").alias("main"),
        F.ceil((F.col("members") - F.col("main.n")) / APART).cast("int").alias("apart_blocks"),
        F.ceil(F.col("members") / ALL).cast("int").alias("all_blocks"),
    )
    rows = join_counted(together, stage(sizes, "group-sizes"), "centre", "members").withColumn("apart", F.col("component") != F.col("main"))
    rows = rows.join(members.select("id", "n_shingles", "registers", "text"), "id")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    columns = ["id", "component", "n_shingles", "registers", "text"]
    apart = rows.where("apart").withColumn("i", F.pmod(F.hash("id"), "apart_blocks")).withColumn("j", every("all_blocks"))
    apart = apart.select(F.col("centre").alias("c"), "i", "j", *[F.col(x).alias(f"one_{x}") for x in columns])
    whole = rows.withColumn("other_j", F.pmod(F.hash("id"), "all_blocks")).withColumn("other_i", every("apart_blocks"))
    whole = whole.select("centre", "other_i", "other_j", *columns)

    def compare(one: pa.Table, other: pa.Table) -> pa.Table:
        links: list[tuple[int, int]] = []
        if one.num_rows and other.num_rows:
            sides = [[t.column(f"{p}{x}").to_numpy() for x in ("id", "component", "n_shingles")] for t, p in ((one, "one_"), (other, ""))]
            (id_a, group_a, n_a), (id_b, group_b, n_b) = sides
            registers = _registers(one.column("one_registers"), sketch), _registers(other.column("registers"), sketch)
            pairs = []
            for i in range(len(id_a)):
                sized = (100 * np.minimum(n_a[i], n_b) >= percent * np.maximum(n_a[i], n_b)) & (group_b != group_a[i])
                j = np.flatnonzero(sized)
                # Registers agree at least as often as the sets are similar: the estimate is for those that may pass.
                equal = (registers[1][j] == registers[0][i]).sum(axis=1)
                j = j[equal >= (least - 0.05) * sketch.registers]
                pairs.append(np.stack([np.full(len(j), i), j]))
            i, k = np.concatenate(pairs, axis=1)
            found = []
            for at in range(0, len(i), 1 << 14):
                x, y = i[at : at + (1 << 14)], k[at : at + (1 << 14)]
                estimate = sketch.similarity(registers[0][x], registers[1][y], n_a[x].astype(np.float64), n_b[y].astype(np.float64))
                close = estimate >= least
                found += zip(estimate[close].tolist(), x[close].tolist(), y[close].tolist(), strict=True)
            if found:
                sets_a = shingle_sets(one.column("one_text").combine_chunks(), sketch.width)
                sets_b = shingle_sets(other.column("text").combine_chunks(), sketch.width)
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while (up := parent.get(x, x)) != x:
                    x = up
                return x

            for _, i, k in sorted(found, reverse=True):
                x, y = root(int(group_a[i])), root(int(group_b[k]))
                if x != y and _similar(sets_a[i], sets_b[k], percent):
                    parent[max(x, y)] = min(x, y)
                    links.append((int(id_a[i]), int(id_b[k])))
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return apart.groupBy("c", "i", "j").cogroup(whole.groupBy("centre", "other_i", "other_j")).applyInArrow(compare, "a long, b long")


@dataclass
class NearDuplicates:
    """``rows``: a row for each document; ``links``: confirmed pairs (a, b) of class
    representatives, by row number, that give the components; ``kept``: the numbers of the rows kept."""

    rows: DataFrame
    links: DataFrame
    kept: DataFrame


def near_duplicates(df: DataFrame, percent: int = 75, sketch: Sketch = DEFAULT, row: str | None = None, one_per_id: bool = False) -> NearDuplicates:
    """Groups of documents linked by 100 * |shared| >= ``percent`` * |all| of their shingle sets.

    ``rows`` has doc_id, n_shingles, component_id (the least doc_id reachable) and kept, a
    row for each row of ``df``. Each row is a document of its own, also if it lacks an id or
    repeats one: only texts link. One row of each component is kept: that of the least id,
    null after all others, of rows that share it the one with the least hash of its text.
    Empty and null texts have no shingles and are linked with nothing. Other columns are ignored.

    ``row``: a stored column with a number of its own for each row; without it the rows are
    stored with one. With ``one_per_id`` at most one row of an id that is not null is kept:
    the one with the least hash, or, if that goes for another document's sake, the next one
    that stays. Rows with other texts of an id then represent a component only if it has no others.
    """
    stage = Staging(df.sparkSession)
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    documents = df.select(number.alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text")
    if row is None:
        documents = stage(documents, "documents")
    sketched = stage(sketches(documents, sketch), "sketches")
    later = F.lit(False).alias("later")
    if one_per_id:
        named = sketched.where(F.col("id") != NO_ID).select("row", "id", "text_hash")
        firsts = named.groupBy("id").agg(F.min("text_hash").alias("first"), F.max("text_hash").alias("last")).where("first <> last")
        others = named.join(firsts, "id").where("text_hash <> first").select("row", F.lit(True).alias("other"))
        sketched = sketched.join(stage(others, "others"), "row", "left")
        later = F.coalesce("other", F.lit(False)).alias("later")
    sketched = sketched.withColumn("head", F.struct(later, "id", "text_hash", "row"))
    sets = ["n_shingles", "set_a", "set_b"]
    classes = sketched.where("n_shingles > 0").groupBy(*sets)
    # A class is named by its first row, which also gives its text.
    classes = classes.agg(F.min("head").alias("head"), F.min("id").alias("doc_id"), F.any_value("registers").alias("registers"))
    classes = stage(classes.withColumn("id", F.col("head.row")), "classes")

    banded = _banded(classes, sketch)
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = stage(banded.join(shared, "key"), "buckets")
    company = buckets.groupBy("id").agg(F.sum(F.col("size") - 1).alias("company"))
    ranked = buckets.join(company, "id")
    centres = ranked.groupBy("key").agg(F.max_by("id", "company").alias("centre"))
    clusters = stage(buckets.join(centres, "key").select("centre", "id").distinct(), "clusters")

    # All that is compared: one row for each class with company. Their number has no bound, so they are not broadcast.
    needed = clusters.select("id").distinct().hint("merge")
    members = documents.select(F.col("row").alias("id"), "text").join(needed, "id", "left_semi").join(classes, "id")
    members = stage(members.select("id", "n_shingles", "registers", "text"), "members")

    pairs = clusters.where("centre <> id").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    close = stage(_estimated(pairs, members, sketch, percent), "close")
    first = stage(_with_centres(close, members, percent, sketch.width, stage), "links-centres")
    component = components(first, stage, "components-centres")
    named = clusters.join(component, "id", "left").select("centre", "id", F.coalesce("component", "id").alias("component"))
    second = stage(_among_members(stage(named, "named"), members, sketch, percent, stage), "links-members")
    stage.remove("buckets", "close", "load", "members", "named", "open", "large", "open-groups", "group-sizes", "open-clusters")
    links = first.unionByName(second)
    component = components(links, stage, "components")

    # Ids come in only here: the least one and the first row of each component, by class and then by row.
    grouped = classes.join(component, "id", "left").select(*sets, "head", "doc_id", F.coalesce("component", "id").alias("component"))
    grouped = stage(grouped, "grouped")
    owners = grouped.groupBy("component").agg(F.min("doc_id").alias("least"), F.min("head").alias("owner"))
    named = grouped.select(*sets, "component").join(owners, "component").select(*sets, "least", F.col("owner.row").alias("owner"))
    bare = sketched.drop("registers")
    linked = bare.where("n_shingles > 0").join(named, sets)
    alone = bare.where("n_shingles = 0").withColumn("least", F.col("id")).withColumn("owner", F.col("row"))
    found = linked.unionByName(alone).withColumn("kept", F.col("row") == F.col("owner"))
    rows = found.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"),
        "n_shingles",
        F.nullif("least", F.lit(NO_ID)).alias("component_id"),
        "kept",
    )
    kept = found.where("kept")
    if one_per_id:
        kept = stage(kept.select("head", "id", "row"), "kept")
        one = kept.where(F.col("id") != NO_ID).groupBy("id").agg(F.min("head").alias("head")).select(F.col("head.row").alias("row"))
        kept = one.unionByName(kept.where(F.col("id") == NO_ID).select("row"))
    return NearDuplicates(rows, links, kept.select("row"))
