"""Token ids as wavelet matrices: one compressed file a shard, with access, counting and occurrence lookup.

A wavelet matrix holds one bit-plane for each bit of an id, from the highest down. After each plane the ids are dealt
anew, those with a zero first, the order otherwise kept. A file holds a header, the documents' ids and lengths, and for
each plane its bits in blocks that are compressed one by one, its ranks (how many ones lie before each block, and before
each 512 bits of it) and samples for select (where every 4,096th one and zero lies). Looking something up reads the
header, the directories of the planes and only those blocks that it touches.

The files live in a table: one row, with the file's bytes, for each shard. Spark's writers and readers therefore carry
them to and from any store, and what a lost executor has half written is never seen.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, tidy, totals_before
from .tokens import Tokenizers, checksum, encoder

MAGIC = b"WVLT2\0"
#: Bits of a block and of a part of it that has its own rank; ones (and zeros) from one sample for select to the next; decompressed blocks that a reader keeps.
BLOCK, PART, SAMPLE, KEPT = 1 << 16, 512, 4_096, 64


#: Files up to which their first places are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_FILES = 200_000


def planes_of(ids: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, int]]:
    """(bits packed in little order, how many are zero) of each plane, the highest first."""
    ids, spare = ids.copy(), np.empty(len(ids), ids.dtype)
    for k in range(bits - 1, -1, -1):
        ones = (ids & ids.dtype.type(1 << k)) != 0
        none = ~ones
        nz = int(np.count_nonzero(none))
        yield np.packbits(ones, bitorder="little"), nz
        np.compress(none, ids, out=spare[:nz])
        np.compress(ones, ids, out=spare[nz:])
        ids, spare = spare, ids


def directory(plane: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ones before each block, ones of the block before each part, part of every SAMPLE-th one, part of every SAMPLE-th zero) of a plane of n bits."""
    parts = -(-len(plane) // (PART // 8))
    full = np.zeros(parts * (PART // 8), np.uint8)
    full[: len(plane)] = plane
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(full.view("<u8")).reshape(parts, -1).sum(1, dtype=np.int64))]) if parts else np.zeros(1, np.int64)
    step = BLOCK // PART
    zeros = np.minimum(np.arange(parts + 1) * PART, n) - before
    places = [np.searchsorted(c, np.arange(0, int(c[-1]), SAMPLE), side="right") - 1 for c in (before, zeros)]
    return before[:-1:step], before[:-1] - np.repeat(before[:-1:step], step)[:parts], *places


def pack_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    z, zeros, parts = zstandard.ZstdCompressor(level=1), [], []
    put = lambda x, kind: parts.append(z.compress(x.astype(kind).tobytes()))
    put(np.array([-(2**63) if d is None else d for d in doc_ids], "<i8"), "<i8")
    put(lengths, "<i8")
    for plane, nz in planes_of(ids, bits):
        zeros.append(nz)
        for x, kind in zip(directory(plane, len(ids)), ("<u8", "<u2", "<u4", "<u4"), strict=True):
            put(x, kind)
        parts += [z.compress(plane[i : i + BLOCK // 8].tobytes()) for i in range(0, len(plane), BLOCK // 8)]
    head = json.dumps({"n": len(ids), "bits": bits, "docs": len(doc_ids), "zeros": zeros, "nulls": [i for i, d in enumerate(doc_ids) if d is None], "parts": list(map(len, parts))}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *parts])


class ShardFile:
    """A shard file, read where it is asked: doc_ids, lengths, and the ids through their wavelet matrix."""

    def __init__(self, data: bytes) -> None:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("no shard file")
        (size,) = struct.unpack_from("<I", data, len(MAGIC))
        at = len(MAGIC) + 4 + size
        head = json.loads(data[at - size : at])
        self.n, self.bits, self.zeros, self._nulls = head["n"], head["bits"], head["zeros"], set(head["nulls"])
        self._data, self._z = memoryview(data), zstandard.ZstdDecompressor()
        self._ends = at + np.cumsum(head["parts"])
        self._starts = self._ends - np.array(head["parts"])
        self._blocks = -(-self.n // BLOCK)
        self._directories: dict[int, tuple] = {}
        self._cache: dict[tuple[int, int], np.ndarray] = {}
        self.read = 0  # blocks of planes decompressed so far

    def _part(self, i: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._z.decompress(self._data[self._starts[i] : self._ends[i]]), kind)

    @property
    def doc_ids(self) -> list[int | None]:
        return [None if i in self._nulls else d for i, d in enumerate(self._part(0, "<i8").tolist())]

    @property
    def lengths(self) -> np.ndarray:
        return self._part(1, "<i8")

    def _directory(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if level not in self._directories:
            first = 2 + level * (4 + self._blocks)
            self._directories[level] = tuple(self._part(first + i, kind).astype(np.int64) for i, kind in enumerate(("<u8", "<u2", "<u4", "<u4")))
        return self._directories[level]

    def _block(self, level: int, i: int) -> np.ndarray:
        if (level, i) not in self._cache:
            if len(self._cache) >= KEPT:
                del self._cache[next(iter(self._cache))]
            self._cache[level, i] = self._part(2 + level * (4 + self._blocks) + 4 + i, "u1")
            self.read += 1
        return self._cache[level, i]

    def decode(self, dtype: type = np.uint32) -> np.ndarray:
        """All ids: the deals undone from the lowest plane up."""
        ids = np.zeros(self.n, dtype)
        for k in range(self.bits):
            level, nz = self.bits - 1 - k, self.zeros[self.bits - 1 - k]
            first = 2 + level * (4 + self._blocks) + 4
            plane = np.concatenate([self._part(first + i, "u1") for i in range(self._blocks)]) if self._blocks else np.zeros(0, np.uint8)
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            ids[nz:] |= dtype(1 << k)
            out = np.empty(self.n, dtype)
            out[np.concatenate([np.flatnonzero(~ones), np.flatnonzero(ones)])] = ids
            ids = out
        return ids

    def _rank(self, level: int, i: int) -> int:
        """Ones before place i (0 to n) of a plane."""
        if i >= self.n:
            return self.n - self.zeros[level]
        blocks, parts, _, _ = self._directory(level)
        inside = i % BLOCK
        bits = self._block(level, i // BLOCK)[inside // PART * (PART // 8) : -(-inside // 8)]
        count = int(np.bitwise_count(bits).sum())
        if inside % 8 and len(bits):
            count -= (int(bits[-1]) >> (inside % 8)).bit_count()
        return int(blocks[i // BLOCK] + parts[i // PART]) + count

    def _select(self, level: int, bit: int, k: int) -> int:
        """The place of the k-th bit (from 0) of a kind in a plane: from its sample to its part by the ranks, then within the part."""
        blocks, parts, *samples = self._directory(level)
        places = samples[1 - bit]
        lo = int(places[k // SAMPLE])
        hi = int(places[k // SAMPLE + 1]) if k // SAMPLE + 1 < len(places) else len(parts) - 1
        at = np.arange(lo, hi + 1)
        before = blocks[at // (BLOCK // PART)] + parts[at]
        before = before if bit else at * PART - before
        j = int(np.searchsorted(before, k, side="right")) - 1
        part = lo + j
        start = part % (BLOCK // PART) * (PART // 8)
        bits = np.unpackbits(self._block(level, part // (BLOCK // PART))[start : start + PART // 8], count=min(PART, self.n - part * PART), bitorder="little")
        return part * PART + int(np.flatnonzero(bits == bit)[k - int(before[j])])

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, nz in enumerate(self.zeros):
            r = self._rank(level, i)
            bit = int(self._block(level, i // BLOCK)[i % BLOCK // 8]) >> (i % 8) & 1
            value = value << 1 | bit
            i = nz + r if bit else i - r
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where, below the lowest plane, the occurrences of a token before place i lie."""
        lo, hi = 0, min(max(i, 0), self.n)
        if token < 0 or token >> self.bits:
            return 0, 0
        for level, nz in enumerate(self.zeros):
            if lo == hi:
                break
            a, b = self._rank(level, lo), self._rank(level, hi)
            lo, hi = (nz + a, nz + b) if token >> (self.bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often a token stands before place i."""
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0): down to the token's range, then up again plane by plane."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        return self._up(token, lo + k)

    def _up(self, token: int, p: int) -> int:
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            p = self._select(level, bit, p - self.zeros[level] if bit else p)
        return p

    def locate(self, token: int) -> list[int]:
        """All places of a token, in order."""
        lo, hi = self._range(token, self.n)
        return [self._up(token, p) for p in range(lo, hi)]


SHARD = "part int, seq int, n_docs long, n_tokens long, payload binary"


def write_shards(docs: DataFrame, tokenizer: Tokenizers, end_id: int = 0, shard_bytes: int = 16 << 20, shard_tokens: int = 1 << 20) -> DataFrame:
    """(doc_id, text) -> the table of shard files, in ascending order of doc_id by (part, seq); see SHARD.

    Each whole text is encoded (null and empty ones have no ids) and ``end_id`` is appended. Rows with equal or null
    doc_ids are each kept; nulls come first, equal ids in the order of a hash of their texts. ``shard_bytes`` of text make
    a part; a part whose ids outgrow ``shard_tokens`` (say, because one id holds very many rows) becomes several files,
    so that memory is bounded by that and the longest single text. Other columns are not looked at. An empty table
    gives an empty one.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange(max(1, -(-size // shard_bytes)), F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        bits = max(1, (max(enc.size, end_id + 1) - 1).bit_length())
        dtype = np.uint16 if bits <= 16 else np.uint32
        end, ids, names, lens, held = np.array([end_id], dtype), [], [], [], 0

        def close() -> pd.DataFrame:
            lengths = np.array(lens, np.int64)
            return pd.DataFrame({"part": [part], "seq": [seq], "n_docs": [len(names)], "n_tokens": [held], "payload": [pack_file(names, lengths, np.concatenate(ids), bits)]})

        for b in batches:
            names_in = [None if pd.isna(d) else int(d) for d in b["doc_id"]]
            for d, x in zip(names_in, enc.encode(b["text"]), strict=True):
                ids += [x.astype(dtype, copy=False), end]
                names.append(d)
                lens.append(len(x) + 1)
                held += len(x) + 1
                if held >= shard_tokens:
                    yield close()
                    ids, names, lens, held, seq = [], [], [], 0, seq + 1
        if names:
            yield close()
        tidy()

    # pandas would turn ids beside a null into floats; as text they stay exact.
    return rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, SHARD)


def _placed(shards: DataFrame) -> DataFrame:
    """(first, payload) of each file: how many ids all files before it hold. Sums run in two steps."""
    parts = totals_before(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")), [], "part", "n", "base").select("part", "base")
    before = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))  # the files of one part
    sizes = shards.select("part", "seq", F.coalesce(before, F.lit(0)).alias("within")).join(parts, "part")
    firsts = sizes.select("part", "seq", (F.col("base") + F.col("within")).alias("first"))
    few = shards.select("part").count() <= BROADCAST_FILES
    return shards.select("part", "seq", "payload").join(F.broadcast(firsts) if few else firsts.hint("merge"), ["part", "seq"]).select("first", "payload")


def occurrences(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """token, place (among the ids of all files): every occurrence of some tokens, found in the files' directories and blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, data in zip(b["first"], b["payload"], strict=True):
                f = ShardFile(data)
                for t in tokens:
                    yield pd.DataFrame({"token": t, "place": first + np.array(f.locate(t), np.int64)})

    return _placed(shards).mapInPandas(run, "token long, place long")


def counts(shards: DataFrame, tokens: list[int]) -> DataFrame:
    """token, n: how often each of some tokens occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["payload"]:
                f = ShardFile(data)
                yield pd.DataFrame({"token": tokens, "n": [f.count(t) for t in tokens]})

    return shards.select("payload").mapInPandas(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def read_shards(shards: DataFrame) -> DataFrame:
    """The files read back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, in the files' order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first, data in zip(b["first"], b["payload"], strict=True):
                f = ShardFile(data)
                ids, lengths = f.decode(np.uint16 if f.bits <= 16 else np.uint32), f.lengths
                ends = np.cumsum(lengths)
                yield pd.DataFrame({
                    "doc_id": pd.array(f.doc_ids, "Int64"), "start": first + ends - lengths, "n_tokens": lengths,
                    "ids_crc32": [checksum(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)],
                })

    return _placed(shards).mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def save(docs: DataFrame, tokenizer: Tokenizers, end_id: int = 0) -> DataFrame:
    """write_shards() into the shared folder; the table of the files."""
    return stored(write_shards(docs, tokenizer, end_id), "shards", "uncompressed")  # the files are compressed
