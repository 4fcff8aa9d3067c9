"""Fast, exact use of a byte-level BPE tokenizer of the tokenizers library.

Such a tokenizer cuts a text into pieces with one pattern and merges within each piece only. The pieces are cut here, by
the classes of the bytes with numpy or with ``re``; the ids of each distinct piece come from the library, once, and whole texts are put together from them with
numpy. Wherever ``re`` and the library could cut differently (their tables of letters, digits and spaces are compared for
every code point that occurs), and for tokenizers of any other make, the library encodes the whole text itself.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism


def _ranges(kind: str) -> str:
    """A character class body: all code points up to U+FFFF whose Unicode category starts so. Bounded classes become bitmaps, which re scans fastest."""
    hit = [unicodedata.category(chr(i))[0] == kind for i in range(0x10000)] + [False]
    edges = [i for i in range(0x10001) if hit[i] != (i > 0 and hit[i - 1])]
    return "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2], strict=True))


_L, _N = _ranges("L"), _ranges("N")
_CLASSES = (f"[{_L}]", f"[{_N}]", f"[^\\s{_L}{_N}]")
#: Letters stand first, since most pieces are words; the order changes nothing, as the alternatives begin differently.
_PIECES = re.compile(rf" ?{_CLASSES[0]}+|'s|'t|'re|'ve|'m|'ll|'d| ?{_CLASSES[1]}+| ?{_CLASSES[2]}+|\s+(?!\S)|\s+")
#: Classes of bytes: 0 letter (non-ASCII ones, too), 1 digit, 2 other, 3 white space. Bytes of which this can't be said by themselves: control
#: characters that only some call spaces, the apostrophe (of 's and the like), and the first bytes of code points outside U+00C0 to U+027F.
_KINDS = np.array([3 if c in (9, 10, 11, 12, 13, 32) else 1 if 48 <= c < 58 else 0 if c >= 128 or chr(c).isalpha() else 2 for c in range(256)], np.uint8)
_UNPLAIN = bytes([*range(0x1C, 0x20), 0x27, *range(0xC0, 0xC3), *range(0xCA, 0x100)])
#: The character as which a byte-level model writes each byte: itself if it can be seen, else the next one from U+0100.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: b if b in _SEEN else 256 + sum(x not in _SEEN for x in range(b)) for b in range(256)}
#: Distinct pieces to remember before dropping the rare ones (about 100 MB), and characters to encode at a time.
REMEMBERED, AT_ONCE = 500_000, 3_000_000


#: Where a tokenizer's file lies, or what says so when called on the machine that reads it.
Tokenizers = str | Callable[[], str]


class TextEncoder:
    """ids of texts, as the library's ``encode`` gives them; ``plain`` takes special tokens' strings as ordinary text."""

    def __init__(self, path: str, plain: bool = False) -> None:
        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.special = [] if plain else [t["content"] for t in made.get("added_tokens") or []]
        pre = made.get("pre_tokenizer") or {}
        self.simple = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not made.get("normalizer")
            and not made.get("truncation") and not made.get("padding") and (made.get("post_processor") or {"type": "ByteLevel"})["type"] == "ByteLevel"
            and all(t["special"] and not t["lstrip"] and not t["rstrip"] for t in made.get("added_tokens") or [])
        )
        self.size = self.lib.get_vocab_size()
        self.dtype = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.alike: dict[str, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.used = np.zeros(0, np.int32)
        self.starts, self.lens, self.flat, self.odd = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, self.dtype), np.zeros(0, bool)

    def _agrees(self, text: str) -> bool:
        """Whether ``re`` and the library put each code point of a text into the same class."""
        seen = set(text)
        for c in seen:
            if c not in self.alike:
                one = [len(self.lib.pre_tokenizer.pre_tokenize_str(x + c + x)) == 1 for x in "a1#"]
                mine = [bool(re.fullmatch(p, c)) for p in _CLASSES]
                self.alike[c] = one == mine
        return all(self.alike[c] for c in seen)

    def _learn(self, pieces: Iterable[bytes]) -> None:
        keys, merge = list(pieces), self.lib.model.tokenize
        ids = [[t.id for t in merge(k.decode("latin-1").translate(_SHOWN))] for k in keys]  # the library's model, piece by piece
        lens = np.fromiter(map(len, ids), np.int32, len(ids))
        self.known.update(zip(keys, range(len(self.lens), len(self.lens) + len(keys)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens, dtype=np.int32) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), self.dtype, int(lens.sum()))])
        self.used = np.concatenate([self.used, np.zeros(len(keys), np.int32)])
        self.odd = np.concatenate([self.odd, np.zeros(len(keys), bool) if self._agrees(b"".join(keys).decode()) else np.fromiter((not self._agrees(k.decode()) for k in keys), bool, len(keys))])

    def _thin(self) -> None:
        """Keeps the pieces that were met again since they were learnt; if those are too many, the ones met most."""
        again = np.flatnonzero(self.used > max(1, int(np.partition(self.used, -REMEMBERED // 2)[-REMEMBERED // 2]) if len(self.used) > REMEMBERED // 2 else 1))
        lens = self.lens[again]
        ends = np.cumsum(lens, dtype=np.int32)
        self.flat = self.flat[np.repeat(self.starts[again] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        names = list(self.known)
        self.known = {names[i]: k for k, i in enumerate(again.tolist())}
        self.starts, self.lens, self.odd, self.used = ends - lens, lens, self.odd[again], np.zeros(len(again), np.int32)

    def _lookup(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of pieces, the new ones learnt first."""
        if missing := set(pieces).difference(self.known):
            if len(self.known) + len(missing) > REMEMBERED:
                self._thin()
                missing = set(pieces).difference(self.known)
            self._learn(missing)
        return np.fromiter(map(self.known.__getitem__, pieces), np.int32, len(pieces))

    def _joined(self, at: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
        """ids of texts from their pieces' numbers; stops: how many pieces lie before each text's end."""
        self.used += np.bincount(at, minlength=len(self.used)).astype(np.int32)
        lens = self.lens[at]
        ends = np.cumsum(lens, dtype=np.int32)
        ids = self.flat[np.repeat(self.starts[at] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        return np.split(ids, np.concatenate([[0], ends])[stops][:-1])

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        """Texts in whose bytes the pieces show: runs of one class, white space dealt out as the pattern does."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        kind = _KINDS[data]
        begins = np.ones(len(data) + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:-1])
        begins[ends] = True
        runs = np.flatnonzero(begins)
        stop = np.zeros(len(data) + 1, bool)
        stop[ends] = True
        first, last = runs[:-1], runs[1:]
        gap = (kind[first] == 3) & ~stop[last]  # white space with something after it: the last one stands alone or joins what follows
        first, last = first[gap], last[gap]
        begins[last[last - first > 1] - 1] = True
        begins[last[data[last - 1] == 32]] = False
        starts = np.flatnonzero(begins).astype(np.int32)
        cut = pa.BinaryArray.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        at = self._lookup(cut.dictionary.to_pylist())[cut.indices.to_numpy()]
        return self._joined(at, np.searchsorted(starts, ends))

    def _other(self, texts: list[str]) -> list[np.ndarray]:
        """Any texts: the pieces are cut by the pattern."""
        cut = [[p.encode() for p in _PIECES.findall(t)] for t in texts]
        at = self._lookup(list(chain.from_iterable(cut)))
        stops = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        out, before = self._joined(at, stops), 0
        for i, stop in enumerate(stops.tolist()):
            if self.odd[at[before:stop]].any():
                out[i] = self._whole(texts[i])
            before = stop
        return out

    def _few(self, texts: list[str]) -> list[np.ndarray]:
        if self.special and any(x in t for t in texts for x in self.special):
            holds = [any(x in t for x in self.special) for t in texts]
            rest = iter(self._few([t for t, h in zip(texts, holds, strict=True) if not h]))
            return [self._whole(t) if h else next(rest) for t, h in zip(texts, holds, strict=True)]
        coded = [t.encode("utf-8", "replace") for t in texts]
        plain = [bool(t) and len(t.translate(None, _UNPLAIN)) == len(t) and b"\xc3\x97" not in t and b"\xc3\xb7" not in t for t in coded]
        ids = {True: iter(self._plain([c for c, x in zip(coded, plain, strict=True) if x]) if any(plain) else ()), False: iter(self._other([t for t, x in zip(texts, plain, strict=True) if not x]) if not all(plain) else ())}
        return [next(ids[x]) for x in plain]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; null counts as empty."""
        some: list[str] = []
        size = 0
        for t in texts:
            some.append(t or "")
            size += len(t or "")
            if size >= AT_ONCE:
                yield from (self._few(some) if self.simple else map(self._whole, some))
                some, size = [], 0
        if some:
            yield from (self._few(some) if self.simple else map(self._whole, some))


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: Tokenizers) -> TextEncoder:
    """One for each Python worker and file; reading the file takes a while."""
    path = path() if callable(path) else path
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def checksum(ids: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(ids.astype("<u4").tobytes())
