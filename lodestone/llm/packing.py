"""Best-fit packing with local search: few sequences of bounded length, documents cut only where they are longer.

Pieces of one length are interchangeable, so the packing is worked out on the histogram of lengths: at most ``capacity``
numbers, whatever the corpus' size. Bins with the same contents are one pattern with a count. Best fit, longest lengths
first, gives the start; local search then improves it: documents move or are exchanged, one for one, two for one or one
for two, from an emptier to a fuller underfull bin. Each step raises the sum of the squared fills; the search ends where
no step is left that does, or where fewer bins can't be had. What each pattern could give away is indexed, so that a look
at a bin costs the same however many there are.
The pieces then take the places of their length by rank. Ranks come from counts per shard and length, so that no group
of pieces ever meets in one task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, stored, tidy, totals_before
from .tokens import Tokenizers, encoder

PIECES = "doc_id long, piece int, start long, length long, ids binary, shard int, place long"
#: Shards up to which their counts (8 bytes for each length up to the capacity: 8 kB, so 34 MB) are broadcast; more are joined by a shuffle.
BROADCAST_SHARDS = 4_096


def cut(docs: DataFrame, tokenizer: Tokenizers, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, text) -> pieces: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), and shard, place.

    A document's ids end with ``end_id``. Only documents longer than ``capacity`` are cut, into pieces of that length,
    of which the first may be shorter. Null and empty texts are one piece, the end id. Repeated rows are packed each.
    shard and place number the pieces of one length within a task. Other columns are not looked at.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard, seen = encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        end = np.array([end_id], "<u4")
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for d, x in zip(b["doc_id"], enc.encode(b["text"]), strict=True):
                ids = np.concatenate([x.astype("<u4"), end])
                first = len(ids) % capacity or capacity
                at = 0
                for k in range(-(-len(ids) // capacity)):
                    to = first + k * capacity if len(ids) > capacity else len(ids)
                    rows.append((None if pd.isna(d) else int(d), k, at, to - at, ids[at:to].tobytes(), shard, seen[to - at]))
                    seen[to - at] += 1
                    held += to - at
                    at = to
                if held > 1 << 19:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)
            rows = []
            tidy()

    def frame(rows: list[tuple]) -> pd.DataFrame:
        ids, *rest = zip(*rows, strict=True)
        return pd.DataFrame({"doc_id": pd.array(ids, "Int64")} | dict(zip(["piece", "start", "length", "ids", "shard", "place"], rest, strict=True)))

    # pandas would turn ids beside a null into floats; as text they stay exact.
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, PIECES)


class Bins:
    """Patterns: tuples of lengths (longest first) with counts; kept by fill."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.count = capacity, Counter()

    def best_fit(self, histogram: dict[int, int]) -> None:
        """Longest lengths first, each into the fullest bin that has room; like bins are filled together."""
        by_room: dict[int, Counter] = {}
        rooms: list[int] = []

        def add(room: int, items: tuple, n: int) -> None:
            if room not in by_room:
                by_room[room] = Counter()
                rooms.insert(bisect_left(rooms, room), room)
            by_room[room][items] += n

        for length in sorted(histogram, reverse=True):
            left = histogram[length]
            while left:
                at = bisect_left(rooms, length)
                if at == len(rooms):
                    k = min(self.capacity // length, left)
                    n = left // k
                    add(self.capacity - k * length, (length,) * k, n)
                    left -= n * k
                    continue
                room = rooms[at]
                items, n = next(iter(by_room[room].items()))
                k = min(room // length, left)
                use = min(n, left // k)
                by_room[room][items] -= use
                if not by_room[room][items]:
                    del by_room[room][items]
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
                add(room - k * length, items + (length,) * k, use)
                left -= use * k
        for c in by_room.values():
            self.count.update(c)

    def _take(self, items: tuple, n: int) -> None:
        self.count[items] -= n
        if not self.count[items]:
            del self.count[items]

    @staticmethod
    def _pairs(items: tuple) -> dict[int, tuple[int, int]]:
        """Sums of two pieces of a bin, each with such a pair."""
        kinds, many = sorted(set(items)), Counter(items)
        return {x + y: (x, y) for i, x in enumerate(kinds) for y in kinds[i:] if x != y or many[x] > 1}

    def _parts(self, items: tuple) -> Iterator[tuple[int, int]]:
        """(1, length) of each kind of piece and (2, sum) of each kind of pair that a bin can give away."""
        yield from ((1, x) for x in set(items))
        yield from ((2, x) for x in self._pairs(items))

    def _offer(self, items: tuple) -> None:
        """Files an underfull pattern under everything that it can give away."""
        fill = sum(items)
        for kind, size in self._parts(items):
            heappush(self.offers.setdefault((kind, size), []), (fill, items))
            self.least[kind][size] = min(self.least[kind][size], fill)

    def _emptiest(self, kind: int, size: int, but: tuple | None = None) -> tuple | None:
        """The emptiest pattern that can give such a part, other than ``but``."""
        heap = self.offers.get((kind, size), [])
        while heap and not self.count.get(heap[0][1]):
            heappop(heap)
        if not heap or heap[0][1] != but:
            return heap[0][1] if heap else None
        own = heappop(heap)
        found = self._emptiest(kind, size, but)
        heappush(heap, own)
        return found

    def _refresh(self, items: tuple, but: tuple | None = None) -> None:
        for kind, size in self._parts(items):
            found = self._emptiest(kind, size, but)
            self.least[kind][size] = self.capacity if found is None else sum(found)

    def step(self, b: tuple) -> tuple[tuple, list[int], list[int]] | None:
        """The step that adds most to bin b: (a bin a that is no fuller, out of a, out of b), or None if no such step adds anything.

        Steps are moves, and exchanges of one for one, two for one and one for two. What b gains, a loses; as b is the fuller
        one, the sum of squares rises with any gain.
        """
        fill, alone = sum(b), self.count[b] < 2
        room = self.capacity - fill
        if alone:
            self._refresh(b, b)  # a bin gives nothing to itself
        last = {k: np.maximum.accumulate(np.where(least <= fill, np.arange(self.capacity + 1), 0)) for k, least in self.least.items()}
        singles, pairs = sorted(set(b)), self._pairs(b)
        best, found = 0, None
        for kind, back, of in ((1, [0, *singles], 1), (1, list(pairs), 2), (2, singles, 1)):
            y = np.array(back, np.int64)
            gain = last[kind][np.minimum(y + room, self.capacity)] - y
            if len(y) and gain.max() > best:
                at = int(gain.argmax())
                best, found = int(gain[at]), (kind, int(gain[at]) + back[at], back[at], of)
        step = None
        if found:
            kind, size, y, of = found
            a = self._emptiest(kind, size, b if alone else None)
            step = a, [size] if kind == 1 else list(self._pairs(a)[size]), list(pairs[y]) if of == 2 else [y] if y else []
        if alone:
            self._refresh(b)
        return step

    def search(self) -> int:
        """Makes steps until none is left that raises the squared fills, or no packing can have fewer bins; returns how many were made.

        Like bins make a step together. The fullest bins are filled first, from the emptiest that have what they want.
        The sum of the squares rises with each step and is bounded, so the search ends by itself.
        """
        self.offers: dict[tuple[int, int], list] = {}
        self.least = {k: np.full(self.capacity + 1, self.capacity, np.int64) for k in (1, 2)}
        bins, fewest, steps = sum(self.count.values()), -(-sum(sum(x) * n for x, n in self.count.items()) // self.capacity), 0
        for items in [x for x in self.count if sum(x) < self.capacity]:
            self._offer(items)
        rising = True
        while rising and bins > fewest:
            rising = False
            todo = [(-sum(x), x) for x in self.count if sum(x) < self.capacity]
            heapify(todo)
            while todo and bins > fewest:
                b = heappop(todo)[1]
                if not self.count.get(b) or not (step := self.step(b)):
                    continue
                a, out_a, out_b = step
                n = min(self.count[a], self.count[b]) if a != b else self.count[a] // 2
                left, right = list(a), list(b)
                for x in out_a:
                    left.remove(x)
                for x in out_b:
                    right.remove(x)
                for items in (a, b):
                    self._take(items, n)
                for items in {a, b}:
                    if not self.count.get(items):
                        self._refresh(items)
                for items in (left + out_b, right + out_a):
                    items = tuple(sorted(items, reverse=True))
                    if not items:
                        bins -= n
                        continue
                    new = not self.count.get(items)
                    self.count[items] += n
                    if sum(items) < self.capacity:
                        if new:
                            self._offer(items)
                        heappush(todo, (-sum(items), items))
                if self.count.get(b):
                    heappush(todo, (-sum(b), b))
                rising, steps = True, steps + 1
        return steps


def plan(histogram: dict[int, int], capacity: int = 1024) -> Counter:
    """{length: count} -> {pattern: count}: best fit, then local search."""
    bins = Bins(capacity)
    bins.best_fit(histogram)
    bins.search()
    return bins.count


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """Pieces (with any further columns) -> the same with sequence_id and offset in place of shard and place.

    Sequences are numbered from 0 and filled without gaps from offset 0. Pieces longer than ``capacity`` are refused.
    Pieces that repeat are packed each, null doc_ids like others. Further columns may be called anything; sequence_id and
    offset are replaced. An empty table gives no rows.
    """
    shard, place, length = "shard", "place", "length"
    shard_first, rank, to = fresh(pieces.columns, "firsts", "rank", "to")
    kept = stored(pieces, "pieces")
    per_shard = stored(kept.groupBy(shard, length).agg(F.count("*").alias("n")), "counts")
    histogram = {int(r["length"]): int(r["n"]) for r in per_shard.groupBy(length).agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    if max(histogram, default=0) > capacity:
        raise ValueError("a piece is longer than a sequence")
    # The places of each length, in runs of like bins: (length, first rank) -> (first sequence, offset).
    runs, sequence, ranks = [], 0, Counter()
    for items, n in sorted(plan(histogram, capacity).items(), reverse=True):
        offset = 0
        for x in items:
            runs.append((x, ranks[x], sequence, offset))
            ranks[x] += n
            offset += x
        sequence += n
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 4)
    span = int(max(ranks.values(), default=0)) + 1
    keys = table[:, 0] * span + table[:, 1]
    # One row a shard: how many pieces of each length lie before it.
    entries = totals_before(per_shard, ["length"], "shard", "n", "first").groupBy(shard).agg(F.map_from_entries(F.collect_list(F.struct("length", "first"))).alias("at"))
    firsts = entries.select(shard, F.transform(F.sequence(F.lit(0), F.lit(capacity)), lambda i: F.coalesce(F.col("at")[i.cast("long")], F.lit(0))).alias(shard_first))
    few = per_shard.select(shard).distinct().count() <= BROADCAST_SHARDS
    ranked = kept.join(F.broadcast(firsts) if few else firsts.hint("merge"), shard).withColumn(rank, F.element_at(shard_first, (F.col(length) + 1).cast("int")) + F.col(place))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, length.to_numpy() * span + rank.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": table[at, 2] + rank.to_numpy() - table[at, 1], "offset": table[at, 3]})

    ranked = ranked.withColumn(to, placed(length, rank))
    own = [f"`{c}`" for c in pieces.columns if c not in ("shard", "place", "sequence_id", "offset")]
    return ranked.select(*own, F.col(to)["sequence_id"].alias("sequence_id"), F.col(to)["offset"].alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with their ids -> one row per sequence: sequence_id, length, ids (all pieces' bytes in order), doc_ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    grouped = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return grouped.select("sequence_id", "length", F.expr("unhex(array_join(transform(parts, p -> hex(p.ids)), ''))").alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))
