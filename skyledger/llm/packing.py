"""Packs tokenised documents into as few sequences of a fixed length as it can.

A longer document is cut from its end, so that only its first piece is shorter than a
sequence. Full pieces are sequences by themselves. The others are dealt by a hash into
groups of bounded size; within a group they are placed best fit, longest first, and then
a swap-based local search works on the emptiest underfull sequence: it moves a piece to
another sequence, exchanges one of its pieces for a shorter one, or two for a shorter one.
Each step makes the fuller side fuller, so the sum of squared fills grows, until the
emptiest is empty or nothing helps, then on the next, until none of the group can be
improved or it has no more sequences than its tokens need. Underfull sequences (of a group
with no more than needed: the emptiest) are dealt again, all groups together, in further
rounds, as long as a round saves a sequence.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import texts
from skyledger.llm.bpe import byte_level
from skyledger.sources.paths import Staging

#: Pieces of a group, on average; a group is one task's work in memory.
GROUP = 40_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
GROUPED = f"{PIECES}, sequence_id long, `offset` long, settled boolean"


def pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int | None) -> DataFrame:
    """The pieces of each row's whole ``text``; ``salt`` is a number of its own for each, also where rows are alike."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_level(tokenizer)
        end = np.array([] if end_id is None else [end_id], dtype=bpe.dtype)
        pieces_so_far = itertools.count(TaskContext.get().partitionId() << 40)
        for batch in batches:
            for part in texts.sliced(batch):
                columns: list[list] = [[] for _ in range(6)]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), bpe.encode(part.column("text")), strict=True):
                    wide = np.concatenate([ids, end]).astype("<u4")
                    n, start, number = len(wide), 0, 0
                    stop = (n - 1) % capacity + 1
                    while start < n:
                        checksum = zlib.crc32(wide[start:stop].tobytes())
                        values = (doc_id, number, start, stop - start, checksum, next(pieces_so_far))
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                        start, stop, number = stop, stop + capacity, number + 1
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
                )

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """A bin for each piece: longest first, into the fullest bin with room."""
    bins = np.empty(len(lengths), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room
    rooms = np.zeros(capacity + 1, dtype=bool)
    count = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        room = size + int(rooms[size:].argmax())
        if rooms[room]:
            b = open_bins[room].pop()
            rooms[room] = bool(open_bins[room])
        else:
            b, room = count, capacity
            count += 1
        bins[i] = b
        left = room - size
        open_bins[left].append(b)
        rooms[left] = left > 0
    return bins


class _Search:
    """One pass over underfull bins: those that wait are offered room, by room, and pieces, by length.

    While a bin waits its room only shrinks, so the entries by length are upper bounds, put right when they are looked at.
    """

    def __init__(self, lengths: list[int], bins: list[int], fills: list[int], capacity: int):
        self.lengths, self.bins, self.fills, self.capacity = lengths, bins, fills, capacity
        self.waits = [0 < f < capacity for f in fills]
        self.held: list[list[int]] = [[] for _ in fills]
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = np.zeros(capacity + 1, dtype=np.int64)  # waiting bins by room
        self.by_length: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (-room, piece)
        self.most = np.full(capacity + 1, -1, dtype=np.int64)  # room of the first entry by length
        for b, f in enumerate(fills):
            if self.waits[b]:
                self.by_room[capacity - f].append(b)
                self.rooms[capacity - f] += 1
        for piece, b in enumerate(bins):
            if self.waits[b]:
                self.held[b].append(piece)
                self.by_length[lengths[piece]].append((fills[b] - capacity, piece))
        for length, entries in enumerate(self.by_length):
            if entries:
                heapq.heapify(entries)
                self.most[length] = -entries[0][0]

    def leave(self, b: int) -> None:
        """The bin no longer waits: it is neither given pieces nor asked for them."""
        if self.waits[b]:
            self.waits[b] = False
            self.rooms[self.capacity - self.fills[b]] -= 1

    def enter(self, b: int) -> None:
        """The bin waits again."""
        room = self.capacity - self.fills[b]
        self.waits[b] = True
        self.rooms[room] += 1
        self.by_room[room].append(b)
        for piece in self.held[b]:
            self._offer(piece, room)

    def _offer(self, piece: int, room: int) -> None:
        entries = self.by_length[self.lengths[piece]]
        heapq.heappush(entries, (-room, piece))
        self.most[self.lengths[piece]] = -entries[0][0]

    def _fill(self, b: int, gain: int) -> None:
        self.rooms[self.capacity - self.fills[b]] -= 1
        self.fills[b] += gain
        room = self.capacity - self.fills[b]
        self.rooms[room] += 1
        self.by_room[room].append(b)
        if not room:
            self.leave(b)

    def _put(self, piece: int, b: int) -> None:
        self.bins[piece] = b
        self.held[b].append(piece)
        if self.waits[b]:
            self._offer(piece, self.capacity - self.fills[b])

    def _first(self, length: int) -> bool:
        """Puts the first entry of a length right; whether it was."""
        entries, was = self.by_length[length], self.most[length]
        while entries:
            room, piece = entries[0]
            b = self.bins[piece]
            if not self.waits[b]:
                heapq.heappop(entries)
            elif self.fills[b] - self.capacity != room:
                heapq.heapreplace(entries, (self.fills[b] - self.capacity, piece))
            else:
                break
        self.most[length] = -entries[0][0] if entries else -1
        return self.most[length] == was

    def step(self, source: int) -> bool:
        """Takes tokens out of ``source``, which does not wait, into a bin that does."""
        lengths, own = self.lengths, self.held[source]
        # Move: the longest piece that fits anywhere, to the fullest bin with room.
        widest = self.rooms[1:].nonzero()[0]
        widest = int(widest[-1]) + 1 if len(widest) else 0
        fits = [p for p in own if lengths[p] <= widest]
        if fits:
            piece = max(fits, key=lengths.__getitem__)
            size = lengths[piece]
            room = size + int((self.rooms[size:] > 0).argmax())
            entries = self.by_room[room]
            while not (self.waits[entries[-1]] and self.capacity - self.fills[entries[-1]] == room):
                entries.pop()
            to = entries.pop()
            own.remove(piece)
            self.fills[source] -= size
            self._fill(to, size)
            self._put(piece, to)
            return True
        # Exchange one or two pieces for one shorter piece of a bin with room for the difference.
        offers: dict[int, tuple[int, ...]] = {}
        for a, b in itertools.combinations(own, 2):
            offers[lengths[a] + lengths[b]] = (a, b)
        for a in own:
            offers[lengths[a]] = (a,)
        offered = np.zeros(self.capacity + 1, dtype=np.int64)
        offered[list(offers)] = list(offers)
        offered = np.maximum.accumulate(offered)  # the greatest offer up to a length
        size = np.flatnonzero(self.most > 0)
        if not len(size):
            return False
        gain = offered[np.minimum(size + self.most[size], self.capacity)] - size
        while True:
            place = int(gain.argmax())
            if gain[place] <= 0:
                return False
            length = int(size[place])
            if self._first(length):
                break
            gain[place] = offered[min(length + int(self.most[length]), self.capacity)] - length if self.most[length] > 0 else 0
        won = int(gain[place])
        other = self.by_length[length][0][1]
        to = self.bins[other]
        self.held[to].remove(other)
        heapq.heappop(self.by_length[length])
        self.most[length] = -self.by_length[length][0][0] if self.by_length[length] else -1
        self.fills[source] -= won
        self._fill(to, won)
        self._put(other, source)
        for piece in offers[length + won]:
            own.remove(piece)
            self._put(piece, to)
        return True


def local_search(lengths: np.ndarray, bins: np.ndarray, capacity: int, tried: int | None = None) -> np.ndarray:
    """Empties underfull bins by moves and exchanges that raise the sum of squared fills, until none can be improved.

    ``tried``: after so many bins it stops.
    """
    sizes, held = lengths.tolist(), bins.tolist()
    fills = np.bincount(bins, weights=lengths).astype(np.int64).tolist()
    used, least = sum(f > 0 for f in fills), -(-sum(fills) // capacity)
    better, count = True, 0
    while better and used > least:  # no packing has fewer
        better = False
        search = _Search(sizes, held, fills, capacity)
        emptiest = [(f, b) for b, f in enumerate(fills) if search.waits[b]]
        heapq.heapify(emptiest)
        level, alike = 0, []  # bins given up wait on for those that are as full
        while emptiest and used > least:
            fill, source = heapq.heappop(emptiest)
            if not search.waits[source]:
                continue
            if fills[source] != fill:
                heapq.heappush(emptiest, (fills[source], source))
                continue
            if tried is not None and count >= tried:
                return np.array(held, dtype=np.int64)
            count += 1
            if fill > level:
                for b in alike:
                    search.leave(b)
                level, alike = fill, []
            search.leave(source)
            while fills[source] and search.step(source):
                better = True
            used -= not fills[source]
            if fills[source] == fill:
                search.enter(source)
                alike.append(source)
    return np.array(held, dtype=np.int64)


def _improve(lengths: np.ndarray, bins: np.ndarray, fills: np.ndarray, source: int, capacity: int) -> bool:
    """One step that takes tokens out of ``source`` into a bin at least as full."""
    search = _Search(lengths.tolist(), bins.tolist(), fills.tolist(), capacity)
    for b in np.flatnonzero(fills < fills[source]).tolist():
        search.leave(b)
    search.leave(source)
    done = search.step(source)
    bins[:], fills[:] = search.bins, search.fills
    return done


def _pack_group(capacity: int, number: int, last: bool):
    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        keys = np.lexsort((table.column("piece").to_numpy(), table.column("salt").to_numpy(), -lengths))
        lengths = lengths[keys]
        bins = np.arange(len(lengths))
        short = np.flatnonzero(lengths < capacity)
        if len(short):
            bins = np.concatenate([bins[: len(lengths) - len(short)], len(lengths) + local_search(lengths[short], best_fit(lengths[short], capacity), capacity)])
        _, bins = np.unique(bins, return_inverse=True)
        order = np.argsort(bins, kind="stable")
        sizes = lengths[order]
        ends = np.cumsum(sizes)
        starts = np.searchsorted(bins[order], bins[order], side="left")
        offset = ends - sizes - (ends - sizes)[starts]
        fill = np.bincount(bins, weights=lengths)
        settled = np.full(len(fill), True) if last else fill == capacity
        if not last and len(fill) == -(-int(lengths.sum()) // capacity):
            settled = np.arange(len(fill)) != fill.argmin()
        rows = table.take(pa.array(keys[order]))
        group = table.column("group")[0].as_py()
        return pa.table(
            {
                **{c: rows.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "salt")},
                "sequence_id": pa.array((group << 40) + bins[order] if number == 0 else -1 - ((number - 1 << 56) + (group << 32) + bins[order])),
                "offset": pa.array(offset),
                "settled": pa.array(settled[bins[order]]),
            }
        )

    return pack


def pack(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 0, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece of each row's whole ``text``.

    ``end_id`` is put after each document, so an empty or null text has one token (none,
    and no row, if ``end_id`` is None). Repeated rows are packed each; null ids are kept.
    Pieces of a sequence lie side by side from 0 and fill at most ``capacity``. Other
    columns are ignored.
    """
    spark = df.sparkSession
    stage = Staging(spark)
    left = stage(pieces(df, tokenizer, capacity, end_id), "pieces")
    done, waiting, sequences = [], None, None
    for number in itertools.count():
        groups = max(1, -(-left.count() // group))
        dealt = left.withColumn("group", F.pmod(F.xxhash64("salt", F.lit(number)), F.lit(groups)))
        packed = stage(dealt.groupBy("group").applyInArrow(_pack_group(capacity, number, groups == 1), GROUPED), f"round-{number}")
        now = packed.where("offset = 0").count()
        if sequences is not None and now >= sequences:  # nothing saved: they stay as they were
            done.append(waiting)
            break
        done.append(packed.where("settled"))
        waiting = packed.where("not settled")
        sequences = waiting.where("offset = 0").count()
        if not sequences:
            break
        left = waiting.select(*left.columns)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
