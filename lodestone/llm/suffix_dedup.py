"""Suffix-array deduplication: every byte that lies in a stretch of 200 bytes which also starts somewhere else.

1. Each window of 200 bytes has an anchor (see anchors.py); equal windows have equal anchors at equal places, so only
   windows whose anchor occurs twice can repeat. A text is cut into segments: an anchor with the windows that chose it.
   Each window lies in one segment, so no stretch is ever compared with itself.
2. Segments that are copies of each other are counted and represented by one: each of their windows repeats.
3. The different segments of an anchor meet in a shard, whose suffixes are put in order by external induced sorting
   with common prefixes (see suffixes.py). A window repeats if its suffix shares 200 bytes with a neighbour. Where an
   anchor has very many different segments, these are first cut by the place of the anchor in the window into parts.
   All windows of a part have most of their bytes in common places, and those bytes' hash deals the parts out: equal
   windows still meet, and the crowd is spread.
4. What was found goes back to all copies; windows become spans of bytes, and spans that touch or overlap become one.

Heaps of copies are thinned by partial counts before they are shuffled, and their segments reach a shard once. Shards are
cut by bytes; whatever their size, they are sorted on disk.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, segments
from .common import dropped, fresh, row_keys, spread_join, stored, tidy
from .suffixes import repeated

#: Bytes of segments that a shard aims at; different segments of an anchor from which on they are dealt out further; parts that they are cut into.
SHARD_BYTES, CROWD, PARTS = 4 << 20, 256, 8
#: Rows of one anchor, or copies of one segment, from which on what they share may be broadcast to them.
CROWDED_ROWS = 1_000
SEGMENT = "id long, k long, first int, n int, anchor long, content long"


def keyed(docs: DataFrame) -> DataFrame:
    """Rows as (id, k, text). k hashes id and text: rows that agree in both are copies of one text and share their verdict."""
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("id"), F.xxhash64("doc_id", F.col("doc_id").isNull(), "text").alias("k"), F.coalesce("text", F.lit("")).alias("text"))


def _encoded(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    """anchor, n: how many segments of a batch chose it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [segments(np.frombuffer(_encoded(t), np.uint8), length)[3] for t in b["text"]]
            anchor, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pd.DataFrame({"anchor": anchor.view(np.int64), "n": n})
            tidy()

    return rows.select("text").mapInPandas(run, "anchor long, n long")


def _segments(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            held = 0
            for d, k, t in zip(b["id"], b["k"], b["text"], strict=True):
                data = _encoded(t)
                first, n, _, anchor = segments(np.frombuffer(data, np.uint8), length)
                content = np.fromiter((xxhash.xxh3_64_intdigest(data[x : x + c + length - 1]) for x, c in zip(first.tolist(), n.tolist(), strict=True)), np.uint64, len(first))
                out.append((np.full(len(first), d), np.full(len(first), k), first.astype(np.int32), n.astype(np.int32), anchor.view(np.int64), content.view(np.int64)))
                held += len(first)
                if held > 200_000:
                    yield frame(out)
                    out, held = [], 0
            if out:
                yield frame(out)
            del out
            tidy()

    def frame(parts: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("id", "k", "first", "n", "anchor", "content"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    return rows.mapInPandas(run, SEGMENT)


def _parts(data: bytes, first: int, n: int, anchor: int, length: int, parts: int) -> list[tuple[int, int, int]]:
    """(place, windows before, windows) of a segment's parts, by how far into the window the anchor stands.

    The windows whose anchor stands ``lo`` to ``hi`` bytes in all hold the bytes from ``lo`` before the anchor to
    ``length - hi`` behind its start. Segments of an anchor agree on the parts' bounds, not on which of them they fill.
    """
    at = int(segments(np.frombuffer(data[first : first + n + length - 1], np.uint8), length)[2][0])  # from the segment's start
    width, out = length - GRAM + 1, []
    step = -(-width // parts)
    for lo in range(0, width, step):
        hi = min(lo + step, width) - 1
        a, b = max(0, at - hi), min(n - 1, at - lo)  # the windows that start hi to lo bytes before the anchor
        if a <= b:
            core = data[first + at - lo : first + at + length - hi]
            out.append((xxhash.xxh3_64_intdigest(core, seed=lo + 1) - (1 << 63), a, b - a + 1))
    return out


def _sorted_shards(pieces: DataFrame, length: int, shards: int) -> DataFrame:
    """(place, anchor, content, m, skip, n, bytes) -> anchor, content, ranges of its windows that repeat (from, to). place says what must meet; skip counts the segment's windows before these."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with tempfile.TemporaryDirectory() as d:  # scratch of this task alone
            path, rows, at, before = Path(d) / "text", [], 0, None
            with path.open("wb") as f:
                for b in batches:
                    for anchor, content, m, skip, n, data in zip(b["anchor"], b["content"], b["m"], b["skip"], b["n"], b["bytes"], strict=True):
                        if (anchor, content, skip) == before:
                            continue  # a row of documents that repeats
                        before = anchor, content, skip
                        rows.append((anchor, content, m, skip, n, at))
                        f.write((np.frombuffer(data, np.uint8) + np.uint8(2)).tobytes() + b"\1")
                        at += len(data) + 1
                f.write(b"\0")
            if not rows:
                return
            flags = repeated(np.memmap(path, np.uint8, "r"), length, Path(d))
            out: list[tuple] = []
            for anchor, content, m, skip, n, start in rows:
                own = np.ones(n, bool) if m > 1 else flags[start : start + n]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                out += [(anchor, content, skip + int(a), skip + int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
            for i in range(0, len(out), 100_000):
                yield pd.DataFrame(out[i : i + 100_000], columns=["anchor", "content", "a", "b"])
        tidy()

    placed = pieces.repartition(shards, "place").sortWithinPartitions("place", "anchor", "content", "skip")
    return placed.mapInPandas(run, "anchor long, content long, a int, b int")


def find_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """(doc_id, text) -> id, k (see keyed()), spans array<struct<start, stop>> in bytes, disjoint and ascending; texts without any are left out."""
    rows = keyed(docs)
    anchors = stored(_anchors(rows, length).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors")
    live = stored(_segments(rows, length).join(anchors, "anchor", "left_semi"), "segments")
    each = stored(live.groupBy("anchor", "content").agg(F.count("*").alias("m"), F.min(F.struct("id", "k", "first", "n")).alias("one")), "each")
    kinds = stored(each.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("m").alias("all")), "kinds")
    total = kinds.agg(F.sum("kinds"), F.sum("all")).first()
    # What very many rows share (more than a thousandth of them: a thousand keys at most) is broadcast, so that these rows stay spread.
    crowded = kinds.where(F.col("kinds") > max(CROWDED_ROWS, (total[0] or 0) // 1_000)).select("anchor")
    contents = stored(spread_join(each, kinds.drop("all"), "anchor", crowded), "contents")
    copied = contents.where(F.col("m") > max(CROWDED_ROWS, (total[1] or 0) // 1_000)).select("anchor", "content")
    alone = contents.where("kinds = 1 AND m > 1").select("anchor", "content", F.lit(0).alias("a"), F.col("one.n").alias("b"))
    several = contents.where("kinds > 1")
    size = several.agg(F.sum((F.col("one.n") + length) * F.when(F.col("kinds") > CROWD, PARTS).otherwise(1))).collect()[0][0] or 0
    asked = several.groupBy("one.id", "one.k").agg(F.collect_list(F.struct("one.first", "one.n", "anchor", "content", "m", "kinds")).alias("asked"))
    crowd, parts = CROWD, PARTS  # for the workers

    def sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["place", "anchor", "content", "m", "skip", "n", "bytes"]
        for b in batches:
            out: list[tuple] = []
            held = 0
            for text, wanted in zip(b["text"], b["asked"], strict=True):
                data = _encoded(text)
                for w in wanted:
                    first, n, anchor = w["first"], w["n"], w["anchor"]
                    for place, skip, count in _parts(data, first, n, anchor, length, parts) if w["kinds"] > crowd else [(anchor, 0, n)]:
                        out.append((place, anchor, w["content"], w["m"], skip, count, data[first + skip : first + skip + count + length - 1]))
                        held += count + length
                if held > 4 << 20:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=columns)
            del out
            tidy()

    pieces = rows.join(asked, ["id", "k"]).select("text", "asked").mapInPandas(sliced, "place long, anchor long, content long, m long, skip int, n int, bytes binary")
    found = stored(_sorted_shards(pieces, length, max(1, -(-size // SHARD_BYTES))).unionByName(alone), "found")
    at = spread_join(live, found, ["anchor", "content"], copied).select("id", "k", (F.col("first") + F.col("a")).alias("start"), (F.col("first") + F.col("b") + F.lit(length - 1)).alias("stop"))
    spans = at.groupBy("id", "k").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))

    @F.pandas_udf("array<struct<start:int,stop:int>>")
    def merged(several: pd.Series) -> pd.Series:
        def one(spans: list) -> list[dict]:
            out: list[dict] = []
            for s in spans:
                if out and s["start"] <= out[-1]["stop"]:
                    out[-1]["stop"] = max(out[-1]["stop"], s["stop"])
                else:
                    out.append({"start": s["start"], "stop": s["stop"]})
            return out

        return several.map(one)

    out = stored(spans.select("id", "k", merged("spans").alias("spans")), "spans")
    for t in (anchors, live, each, kinds, contents, found):
        dropped(t)
    return out


def _cut(data: bytes, spans: list | None) -> bytes:
    out, at = [], 0
    for s in spans if spans is not None else ():
        out.append(data[at : s["start"]])
        at = s["stop"]
    return b"".join([*out, data[at:]])


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """All columns of docs, with the repeated bytes removed from text, and spans (what was removed; empty if nothing).

    Matches never cross documents; a document's own repeats count; all occurrences go, the first one, too; matches are
    judged on the input. Null texts stay null and count as empty; texts shorter than ``length`` bytes stay as they are.
    Rows that repeat are copies of one another; very long texts are taken whole. What is left of a code point that is cut in two becomes U+FFFD. A column
    called spans is replaced; other columns are kept. An empty table stays empty.
    """
    own = [c for c in docs.columns if c != "spans"]

    @F.pandas_udf("string")
    def left(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or s is None or not len(s) else _cut(_encoded(t), s).decode("utf-8", "replace") for t, s in zip(text, spans, strict=True)], dtype=object)

    joined = _with_spans(docs.drop("spans"), find_spans(docs, length))
    return joined.withColumn("text", left("text", "spans")).select(*[f"`{c}`" for c in own], "spans")


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    i, k = fresh([*docs.columns, "spans"], "id", "key")
    own, key = row_keys()
    spans = spans.select(F.col("id").alias(i), F.col("k").alias(k), "spans")
    return docs.withColumns({i: own, k: key}).join(spans, [i, k], "left").drop(i, k)


def digests(docs: DataFrame, length: int = 200) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 of the bytes that are left."""

    @F.pandas_udf("string")
    def kept(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(_cut(_encoded(t), s)).hexdigest() for t, s in zip(text, spans, strict=True)], dtype=object)

    spans = find_spans(docs, length)
    whole = F.coalesce("text", F.lit(""))
    joined = _with_spans(docs.select("doc_id", "text"), spans)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["stop"] - x["start"]))
    return joined.select(
        "doc_id", F.octet_length(whole).cast("long").alias("n_bytes"), F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), kept(whole, "spans").alias("kept_sha256"),
    )
