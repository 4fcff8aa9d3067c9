"""External induced sorting of suffixes with their common prefixes.

All suffixes of a text are put in order from those of its S* positions (the left ends of rising stretches): going up
through the order, each suffix induces the one a symbol longer into the bucket of its first symbol, first for the falling
positions, then, going down, for the rising ones. The order of the S* suffixes themselves is that of the string of their
names, which is sorted by the same procedure, and so on, until a string fits into memory.

A suffix on its way is a tuple (position, length of the prefix that it shares with the one before it in its bucket). The
tuples wait in a priority queue whose keys are symbols: within a bucket they arrive in their order, so that a bucket is a
run, in memory as long as there is room and on disk beyond that. numpy works on whole blocks of a run at a time. The text,
its rises and falls, the S* positions, their names, order and common prefixes are mapped from files and gone through block
by block; the substrings that are to be named are dealt out to files by sampled splitters until a part fits into memory.
What stays in memory of a string is a queue's room, some blocks, ``base`` entries, and some hundred bytes for each different
symbol: few for bytes, but for a string of names as many as there are names. Common prefixes are counted up to ``length`` only, and suffixes that agree so far are alike.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np

#: Bytes of waiting tuples before a queue goes to disk; entries of a block; symbols of a string that is sorted in memory.
QUEUE_BYTES, BLOCK, BASE = 8 << 20, 1 << 20, 1 << 22
#: Words by which too many substrings are dealt out.
SPLITTERS = 64


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    return ((a, min(a + BLOCK, n)) for a in range(0, n, BLOCK))


def _mapped(path: Path, dtype: type, n: int | None = None) -> np.ndarray:
    """An array in a file: a new one of n entries, or what the file holds."""
    if n is None:
        return np.memmap(path, dtype, "r") if path.stat().st_size else np.zeros(0, dtype)
    return np.memmap(path, dtype, "w+", shape=n) if n else np.zeros(0, dtype)


def _spooled(path: Path, dtype: type, parts: Iterator[np.ndarray]) -> np.ndarray:
    """The parts one after the other, in a file."""
    with path.open("wb") as f:
        for p in parts:
            f.write(np.ascontiguousarray(p, dtype).tobytes())
    return _mapped(path, dtype)


class Minima:
    """The smallest number since a time. Numbers are 0 to ``most``: of each only the last time counts at which it or a smaller one came."""

    def __init__(self, most: int) -> None:
        self.last, self.now = np.full(most + 1, -1, np.int64), 0

    def since(self, then: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.last, then, side="right"), len(self.last) - 1)

    def add(self, values: np.ndarray) -> None:
        came = np.full(len(self.last), -1, np.int64)
        came[values] = self.now + np.arange(len(values))
        np.maximum(self.last, np.maximum.accumulate(came), out=self.last)
        self.now += len(values)


class DiskQueue:
    """A priority queue of (position, shared) tuples by symbol; those of one symbol come out as they went in. Its file has no name, so that its room is given back when it is closed; ``kind`` is what a position is there."""

    def __init__(self, folder: Path, name: str, memory: int = QUEUE_BYTES, kind: str = "<i8") -> None:
        self.file = (folder / name).open("w+b")
        (folder / name).unlink()
        self.memory, self.held, self.kind = memory, 0, np.dtype(kind)
        self.new: dict[int, list] = defaultdict(list)  # (pos, shared) in memory
        self.old: dict[int, list] = defaultdict(list)  # (offset, n) on disk, which went in before

    def push(self, symbol: int, pos: np.ndarray, shared: np.ndarray) -> None:
        self.new[symbol].append((pos, shared))
        self.held += pos.nbytes + shared.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        """Writes what is in memory, and looks at nothing else."""
        self.file.seek(0, 2)
        at = self.file.tell()
        for symbol, run in self.new.items():
            pos, shared = self._joined(run)
            self.file.write(pos.astype(self.kind).tobytes())
            self.file.write(shared.astype("<i4").tobytes())
            self.old[symbol].append((at, len(pos)))
            at += (self.kind.itemsize + 4) * len(pos)
        self.new.clear()
        self.held = 0

    @staticmethod
    def _joined(run: list) -> tuple[np.ndarray, np.ndarray]:
        return run[0] if len(run) == 1 else (np.concatenate([p for p, _ in run]), np.concatenate([s for _, s in run]))

    def _load(self, part: tuple) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(part[0])
        pos = np.frombuffer(self.file.read(self.kind.itemsize * part[1]), self.kind).astype(np.int64, copy=False)
        return pos, np.frombuffer(self.file.read(4 * part[1]), "<i4")

    def pop(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of a symbol's tuples until none are left, those included that are pushed meanwhile."""
        while symbol in self.old or symbol in self.new:
            for part in self.old.pop(symbol, []):
                yield self._load(part)
            if run := self.new.pop(symbol, None) if symbol not in self.old else None:  # what came meanwhile may have gone to disk
                self.held -= sum(p.nbytes + s.nbytes for p, s in run)
                yield self._joined(run)

    def backwards(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of a symbol's tuples, the last first; nothing is taken out."""
        if run := self.new.get(symbol):
            pos, shared = self._joined(run)
            yield pos[::-1], shared[::-1]
        for part in reversed(self.old.get(symbol, [])):
            pos, shared = self._load(part)
            yield pos[::-1], shared[::-1]

    def close(self) -> None:
        self.file.close()


def _lowest(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(values[lo : hi + 1]) of each pair, by a sparse table as deep as the widest range."""
    width = hi - lo + 1
    out = np.empty(len(lo), values.dtype)
    level, step = values, 1
    while len(lo):
        here = (width >= step) & (width < 2 * step)
        out[here] = np.minimum(level[lo[here]], level[hi[here] - step + 1])
        if not (width >= 2 * step).any():
            break
        level = np.minimum(level[:-step], level[step:])
        step *= 2
    return out


class Sorter:
    """Sorts the suffixes of one string of symbols (its last symbol is smaller than all others and occurs once)."""

    def __init__(self, text: np.ndarray, length: int, folder: Path, base: int = BASE, queue_bytes: int = QUEUE_BYTES, depth: int = 0) -> None:
        self.t, self.length, self.folder, self.base, self.queue_bytes, self.depth = text, length, folder, base, queue_bytes, depth

    def _path(self, name: str) -> Path:
        return self.folder / f"{name}{self.depth}"

    def _rising(self) -> np.ndarray:
        """Of each position: whether its suffix is smaller than the next one. From the right, block by block."""
        n = len(self.t)
        out = _mapped(self._path("rising-flags"), bool, n)
        out[-1] = True
        for a, b in reversed(list(_blocks(n - 1))):
            t = np.asarray(self.t[a : b + 1])
            turn = np.flatnonzero(t[1:] != t[:-1])  # ends of runs of a symbol
            own = np.full(b - a, out[b])
            if len(turn):
                own[: turn[-1] + 1] = np.repeat(t[turn] < t[turn + 1], np.diff(turn, prepend=-1))
            out[a:b] = own
        return out

    def stars(self) -> np.ndarray:
        s = self.rising = self._rising()
        return _spooled(self._path("stars"), np.int64, (np.flatnonzero(s[a + 1 : b + 1] & ~s[a:b]) + a + 1 for a, b in _blocks(len(s) - 1)))

    @staticmethod
    def _refine(order: np.ndarray, new: np.ndarray, word: Callable[[np.ndarray], np.ndarray]) -> bool:
        """Sorts the members of each group (a stretch of ``order`` up to the next True in ``new``) by a further word; False if all stand alone."""
        end = np.append(new[1:], True)
        tied = np.flatnonzero(~(new & end))
        if not len(tied):
            return False
        group = np.cumsum(new)[tied]
        w = word(order[tied])
        o = np.lexsort((w, group))
        order[tied] = order[tied][o]
        w = w[o]
        new[tied[1:][(w[1:] != w[:-1])]] = True
        return True

    def names(self, at: np.ndarray) -> tuple[np.ndarray, int]:
        """Ranks of the S* substrings (from one S* position to the next, both included), by symbols and rise or fall; and how many there are."""
        t, last, n = self.t, len(self.t) - 1, len(at)
        bits = 9 if t.dtype == np.uint8 else 40
        per = 63 // bits

        def ends(which: np.ndarray) -> np.ndarray:
            return np.where(which + 1 < n, at[np.minimum(which + 1, n - 1)], last)

        def word(which: np.ndarray, r: int) -> np.ndarray:
            out, start, end = np.zeros(len(which), np.int64), at[which], ends(which)
            for k in range(per):
                p = start + r * per + k
                inside = p <= end
                p = np.minimum(p, last)
                out = (out << bits) | np.where(inside, (t[p].astype(np.int64) << 1 | self.rising[p]) + 1, 0)
            return out

        rank, many, files = _mapped(self._path("names"), np.int64, n), 0, 0
        todo: list[tuple[np.ndarray, int, bool]] = [(_spooled(self._path("every"), np.int64, (np.arange(a, b) for a, b in _blocks(n))), 0, False)]
        self._path("every").unlink()
        while todo:  # the smallest part is the last one; True: all its substrings are equal
            which, r, equal = todo.pop()
            if equal and len(which):
                many += 1
                for a, b in _blocks(len(which)):
                    rank[which[a:b]] = many
                continue
            if len(which) <= self.base:
                if len(which):
                    order, new = self._by_words(np.asarray(which), r, word, int((ends(which) - at[which]).max()) + 1, per)
                    rank[which[order]] = many + np.cumsum(new)
                    many += int(new.sum())
                continue
            few = np.unique(word(which[:: max(1, len(which) // (16 * SPLITTERS))], r))
            few = few[:: -(-len(few) // SPLITTERS)]
            parts = [self._path(f"part{files + i}-") for i in range(2 * len(few) + 1)]
            files += len(parts)
            open_files = [path.open("wb") for path in parts]
            for a, b in _blocks(len(which)):
                own = np.asarray(which[a:b])
                w = word(own, r)
                j = np.searchsorted(few, w)
                slots = 2 * j + (few[np.minimum(j, len(few) - 1)] == w)
                order = np.argsort(slots, kind="stable")
                for slot, piece in zip(*self._grouped(slots[order], own[order]), strict=True):
                    open_files[slot].write(piece.tobytes())
            for f in open_files:
                f.close()
            for i in range(len(parts) - 1, -1, -1):
                ended = i % 2 == 1 and int(few[i // 2]) & ((1 << bits) - 1) == 0
                todo.append((_mapped(parts[i], np.int64), r + i % 2, ended))
                parts[i].unlink()  # its room is given back when the part has been named
        return rank, many

    @staticmethod
    def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
        at = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[at].tolist(), np.split(values, at[1:])

    def _by_words(self, which: np.ndarray, r: int, word: Callable[[np.ndarray, int], np.ndarray], longest: int, per: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of substrings from their r-th word on, and where it comes to another one."""
        w = word(which, r)
        order = np.argsort(w, kind="stable")
        new = np.concatenate([[True], w[order][1:] != w[order][:-1]])
        r += 1
        while r * per < longest and self._refine(order, new, lambda some, r=r: word(which[some], r)):
            r += 1
        return order, new

    def _in_memory(self, rank: np.ndarray) -> np.ndarray:
        """Order of the suffixes of a string of names, by doubling; names stand for two symbols at least, so ``length`` bounds the rounds."""
        n = len(rank)
        order = np.argsort(rank, kind="stable")
        new = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
        place = np.empty(n + 1, np.int64)
        k = 1
        while True:
            starts = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            place[order], place[n] = starts, -1
            if 2 * k > self.length + 2 or not self._refine(order, new, lambda which, k=k: place[np.minimum(which + k, n)]):
                return order
            k *= 2

    def sorted_stars(self) -> tuple[np.ndarray, np.ndarray]:
        """S* positions in the order of their suffixes, and what each shares with the one before."""
        at = self.stars()
        rank, many = self.names(at)
        n, self.rising = len(at), None
        for name in ("rising-flags", "stars"):  # their room is given back when they are no longer mapped
            self._path(name).unlink(missing_ok=True)
        if many == n:
            order = _mapped(self._path("order"), np.int64, n)
            for a, b in _blocks(n):
                order[rank[a:b] - 1] = np.arange(a, b)
        elif n <= self.base:
            order = self._in_memory(np.asarray(rank))
        else:  # the last S* position is the last symbol, which ends the string of names as well
            inner = Sorter(rank, max(2, -(-self.length // 2) + 1), self.folder, self.base, self.queue_bytes, self.depth + 1)
            order = _spooled(self._path("order"), np.int64, (pos for pos, _ in inner.suffixes()))
            del inner
        at = _spooled(self._path("ordered"), np.int64, (at[order[a:b]] for a, b in _blocks(n)))
        del order, rank
        self._path("order").unlink(missing_ok=True)
        if n:
            os.truncate(self._path("names"), 0)  # nothing reads it any more
        shared = (self._shared(at[max(a - 1, 0) : b - 1], at[max(a, 1) : b]) for a, b in _blocks(n))
        return at, _spooled(self._path("shared"), np.int32, (np.append(np.int32(0), s) if i == 0 else s for i, s in enumerate(shared)))

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of pairs of suffixes, up to ``length``."""
        step, last = max(1, 8 // self.t.itemsize), len(self.t) - 1
        t = self.t if len(self.t) >= step else np.concatenate([self.t, np.zeros(step, self.t.dtype)])
        edge = len(t) - step
        words = np.lib.stride_tricks.sliding_window_view(t, step)
        tail = np.lib.stride_tricks.sliding_window_view(np.concatenate([t[edge:], np.zeros(step, t.dtype)]), step)

        def windows(p: np.ndarray) -> np.ndarray:
            out, late = words[np.minimum(p, edge)], np.flatnonzero(p > edge)
            out[late] = tail[p[late] - edge]
            return out

        out, todo, k = np.zeros(len(a), np.int32), np.arange(len(a)), 0
        while len(todo) and k < self.length:
            wa, wb = windows(np.minimum(a[todo] + k, last)), windows(np.minimum(b[todo] + k, last))
            if step == 8:
                diff = wa.view("<u8")[:, 0] ^ wb.view("<u8")[:, 0]
                same = np.where(diff == 0, 8, np.bitwise_count((diff & (~diff + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
            else:
                same = np.logical_and.accumulate(wa == wb, axis=1).sum(1)
            out[todo] = k + same
            todo = todo[same == step]
            k += step
        return np.minimum(out, self.length)

    def _run(self, p: int) -> int:
        """How often the symbol at p repeats from there on, up to ``length``."""
        piece = self.t[p : p + self.length]
        other = np.flatnonzero(piece != piece[0])
        return int(other[0]) if len(other) else len(piece)

    def _deal(self, queue: DiskQueue, minima: Minima, seen: np.ndarray, slot: Callable[[np.ndarray], np.ndarray], pos: np.ndarray, shared: np.ndarray, fits: Callable[[np.ndarray], np.ndarray]) -> None:
        """Induces from a block of suffixes, in their order, those a symbol longer. seen: when each bucket had its last entry; minima: what was shared at least since then."""
        before = self.t[np.maximum(pos - 1, 0)]
        at = np.flatnonzero((pos > 0) & fits(before))
        lows = np.minimum.accumulate(shared)
        if len(at):
            order = np.argsort(before[at], kind="stable")
            k, symbols = at[order], before[at][order]
            first = np.concatenate([[True], symbols[1:] != symbols[:-1]])
            value = np.empty(len(k), np.int32)
            heads = np.flatnonzero(first)
            slots = slot(symbols[heads])
            value[heads] = np.where(seen[slots] < 0, -1, np.minimum(minima.since(seen[slots]), lows[k[heads]]))
            rest = np.flatnonzero(~first)
            value[rest] = _lowest(shared, k[rest - 1] + 1, k[rest])
            value = np.minimum(value + 1, self.length)
            tails = np.append(heads[1:], len(k))
            seen[slots] = minima.now + k[tails - 1]
            q = pos[k] - 1
            for symbol, a, b in zip(symbols[heads].tolist(), heads.tolist(), tails.tolist(), strict=True):
                queue.push(symbol, q[a:b], value[a:b])
        minima.add(shared)

    def suffixes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks (positions, what each shares with the one before) of all suffixes, bucket by bucket in ascending order.

        Within a bucket falling suffixes come first. Of two neighbouring blocks the second one's first entry is joined to the
        first one's last.
        """
        t, length = self.t, self.length
        symbols = np.zeros(0, t.dtype)
        for a, b in _blocks(len(t)):
            symbols = np.union1d(symbols, t[a:b])
        slot = lambda s: np.searchsorted(symbols, s)
        stars, shared = self.sorted_stars()
        cuts = np.zeros(len(symbols) + 1, np.int64)
        for a, b in _blocks(len(stars)):
            found, n = np.unique(slot(t[stars[a:b]]), return_counts=True)
            cuts[found + 1] += n
        cuts = np.cumsum(cuts)
        kind = "<i4" if len(t) < 1 << 31 else "<i8"
        falling, done = DiskQueue(self.folder, f"falling{self.depth}", self.queue_bytes, kind), DiskQueue(self.folder, f"fallen{self.depth}", self.queue_bytes, kind)
        minima, seen = Minima(length), np.full(len(symbols), -1, np.int64)  # a bucket's first entry shares nothing with the bucket before
        for i, c in enumerate(symbols.tolist()):
            last = None
            for pos, s in falling.pop(c):
                done.push(c, pos, s)
                self._deal(falling, minima, seen, slot, pos, s, lambda b, c=c: b >= c)
                last = int(pos[-1])
            first, stop = int(cuts[i]), int(cuts[i + 1])
            for a in range(first, stop, BLOCK):
                own, s = np.asarray(stars[a : min(a + BLOCK, stop)]), np.array(shared[a : min(a + BLOCK, stop)])
                if a == first:
                    s[0] = 0 if last is None else min(self._run(last), self._run(int(stars[a])))
                self._deal(falling, minima, seen, slot, own, s, lambda b, c=c: b > c)
        falling.close()
        del stars, shared
        for name in ("ordered", "shared"):
            self._path(name).unlink(missing_ok=True)
        rising, risen = DiskQueue(self.folder, f"rising{self.depth}", self.queue_bytes, kind), DiskQueue(self.folder, f"risen{self.depth}", self.queue_bytes, kind)
        minima, seen[:] = Minima(length), -1
        seams: dict[int, int] = {}
        for c in symbols[::-1].tolist():
            last = None
            for pos, s in rising.pop(c):
                risen.push(c, pos, s)
                self._deal(rising, minima, seen, slot, pos, s, lambda b, c=c: b <= c)
                last = int(pos[-1])
            if c == symbols[0]:
                break
            seam, before = None, None
            for pos, s in done.backwards(c):
                if before is None:
                    seam = 0 if last is None else min(self._run(last), self._run(int(pos[0])))
                    before = seam
                    seams[c] = seam
                step = np.concatenate([[before], s[:-1]]).astype(np.int32)
                before = int(s[-1])
                self._deal(rising, minima, seen, slot, pos, step, lambda b, c=c: b < c)
        rising.close()
        for c in symbols.tolist():
            if c == symbols[0]:
                yield np.array([len(t) - 1]), np.zeros(1, np.int32)  # the last symbol stands alone
                continue
            before = 0
            for pos, s in done.pop(c):
                yield pos, s
                before = seams.get(c, 0)
            for pos, s in risen.backwards(c):
                # s says what each shares with the next larger one; turned round, each shares that with the one before it.
                yield pos, np.concatenate([[before], s[:-1]]).astype(np.int32)
                before = int(s[-1])
        done.close()
        risen.close()


def suffix_order(text: bytes, length: int = 200, base: int = BASE, queue_bytes: int = QUEUE_BYTES, folder: str | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (positions, shared) of all suffixes of a text without the bytes FE and FF, in ascending order up to ``length`` bytes."""
    with tempfile.TemporaryDirectory(dir=folder) as d:
        symbols = np.frombuffer(text, np.uint8) + np.uint8(1)
        path = Path(d) / "text"
        path.write_bytes(symbols.tobytes() + b"\0")
        for pos, shared in Sorter(np.memmap(path, np.uint8, "r"), length, Path(d), base, queue_bytes).suffixes():
            if pos[0] < len(text):
                yield pos, shared


def repeated(text: np.ndarray, length: int, folder: Path, base: int = BASE, queue_bytes: int = QUEUE_BYTES) -> np.ndarray:
    """Flags the positions of a string of symbols at which a stretch of ``length`` starts that also starts elsewhere in it."""
    out = _mapped(folder / "repeated", bool, len(text))
    before = -1
    for pos, shared in Sorter(text, length, folder, base, queue_bytes).suffixes():
        full = shared >= length
        out[pos[full]] = True
        out[pos[:-1][full[1:]]] = True
        if full[0] and before >= 0:
            out[before] = True
        before = int(pos[-1])
    return out
