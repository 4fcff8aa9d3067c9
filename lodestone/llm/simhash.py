"""SimHash near-duplicates: fingerprints, pigeonring candidates, exact Hamming check, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import LOWER, UPPER, fresh, row_keys, spread_join, stored, tidy

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Widths of the five segments of a fingerprint, from the lowest bits up.
SEGMENTS = (13, 13, 13, 13, 12)
#: Fingerprints filed under one key from which on midpoints link them: about where 2,081 words each cost less than pairs.
CROWD = 4_096
_BYTES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes. Counts eight bits at a time, one in each byte of a word."""
    n, counts = len(hashes), np.zeros(64, np.int64)
    rows = np.zeros(-(-max(n, 1) // 255) * 255, np.uint64)
    rows[:n] = hashes
    rows = rows.reshape(-1, 255)
    for k in range(8):
        per_byte = ((rows >> np.uint64(k)) & _BYTES).sum(axis=1, dtype=np.uint64).astype("<u8")
        counts[k::8] = per_byte.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprint(text: str | None, size: int = 4, seed: int = 42) -> int:
    """Over the shingles of ``size`` words, repeats included; fewer words form one shingle, none (or null) gives zero."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed) if words else 0
    joined, ends = b" ".join(words), [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[e + 1 for e in ends[:-size]]]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[size - 1 :], strict=True)], np.uint64))


def with_fingerprints(docs: DataFrame, size: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, text) -> doc_id, k (a hash of id and text), fp (the 64 bits as a signed long), of every row's whole text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, size, seed) for t in b["text"]), np.uint64, len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "k": b["k"], "fp": fps.view(np.int64)})
            tidy()

    # pandas would turn ids beside a null into floats; as text they stay exact.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), row_keys()[1].alias("k"), "text").mapInPandas(run, "doc_id string, k long, fp long")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def links(fps: DataFrame, most: int = 4, crowd: int = CROWD) -> DataFrame:
    """(fp, node) with distinct fps -> (a, b): nodes whose links join all fingerprints that differ in at most ``most`` (4) bits.

    Pigeonring: cut the ring of 64 bits into five segments. If two fingerprints differ in 4 bits at most, then from some
    segment on, the differences over 1, 2, 3, 4, 5 consecutive segments sum to no more than 0.8, 1.6, 2.4, 3.2, 4.0, that
    is 0, 1, 2, 3, 4. The first two conditions are a key: each fingerprint is filed under each segment and its
    successor, and looked up under the same segment and all successors that differ in one bit or none. The others
    prune what is found, before the whole distance is counted; both happen inside the join, so that it emits links only.

    A key under which more than ``crowd`` fingerprints are filed isn't joined, as that would pair all of them. Whatever is
    filed or looked up there is linked by midpoints instead (see by_midpoints), which costs the same for each fingerprint,
    however crowded. Links are complete up to components: two fingerprints within reach are linked, or both are linked to
    a third one within reach of a common midpoint.
    """
    if most != 4:
        raise ValueError("the segments are cut for 4 differing bits")
    starts = [sum(SEGMENTS[:i]) for i in range(5)]

    def part(fp: str, i: int):
        return F.shiftrightunsigned(fp, starts[i % 5]).bitwiseAND(F.lit((1 << SEGMENTS[i % 5]) - 1))

    def keys(i: int, flips: bool):
        head, tail = part("fp", i), part("fp", i + 1)
        key = lambda t: F.lit(i).cast("long") * F.lit(1 << 40) + head * F.lit(1 << 20) + t
        return F.array(key(tail), *[key(tail.bitwiseXOR(F.lit(1 << b))) for b in range(SEGMENTS[(i + 1) % 5] if flips else 0)])

    filed = fps.select(F.explode(F.concat(*[keys(i, False) for i in range(5)])).alias("key"), F.col("fp").alias("fa"), F.col("node").alias("a"))
    asked = fps.select(F.explode(F.concat(*[keys(i, True) for i in range(5)])).alias("asked"), F.col("fp").alias("fb"), F.col("node").alias("b"))
    crowded = stored(filed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("key"), "crowded")
    some = not crowded.isEmpty()
    dense = None
    if some:
        there = filed.join(crowded, "key", "left_semi").select(F.col("fa").alias("fp"), F.col("a").alias("node"))
        near = asked.join(crowded.withColumnRenamed("key", "asked"), "asked", "left_semi").select(F.col("fb").alias("fp"), F.col("b").alias("node"))
        dense = by_midpoints(there.unionByName(near).distinct())
        filed, asked = filed.join(crowded, "key", "left_anti"), asked.join(crowded.withColumnRenamed("key", "asked"), "asked", "left_anti")
    diff = F.col("fa").bitwiseXOR(F.col("fb"))
    at = F.floor(F.col("key") / F.lit(1 << 40)).cast("int")
    chain = F.lit(False)
    for i in range(5):
        mask = lambda n, i=i: sum(((1 << SEGMENTS[j % 5]) - 1) << starts[j % 5] for j in range(i, i + n))
        signed = lambda m: m - (1 << 64) if m >> 63 else m
        chain = F.when(at == i, (F.bit_count(diff.bitwiseAND(F.lit(signed(mask(3))))) <= 2) & (F.bit_count(diff.bitwiseAND(F.lit(signed(mask(4))))) <= 3)).otherwise(chain)
    # The planner takes exploded rows for as few as they came from and would broadcast them; both sides are shuffled instead.
    found = filed.hint("merge").join(asked.hint("merge"), (F.col("key") == F.col("asked")) & (F.col("fa") < F.col("fb")) & chain & (F.bit_count(diff) <= most)).select("a", "b")
    return found.unionByName(dense) if some else found


def by_midpoints(fps: DataFrame) -> DataFrame:
    """(fp, node) -> (a, b): links whose components are those of the fingerprints that differ in at most 4 bits.

    Two fingerprints do so exactly if some 64-bit word differs from either in at most 2 bits. Each is filed under the 2,081
    words within 2 bits of it, and all under a word are linked to the smallest node there.
    """
    bit = lambda i: (1 << i) - (1 << 64) if i == 63 else 1 << i
    flips = [0, *[bit(i) for i in range(64)], *[bit(i) ^ bit(j) for i in range(64) for j in range(i)]]
    flips = fps.sparkSession.createDataFrame([(flips,)], "flips array<long>")  # one row
    filed = fps.crossJoin(F.broadcast(flips)).select("node", F.explode(F.transform("flips", lambda x: F.col("fp").bitwiseXOR(x))).alias("word"))
    filed = stored(filed, "midpoints")
    least = filed.groupBy("word").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    heavy = least.where(F.col("n") > CROWD).orderBy(F.desc("n"), "word").limit(1_000)
    return spread_join(filed, least.select("word", "a"), "word", stored(heavy, "heavy")).where("node != a").select("a", F.col("node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, most: int = 4) -> DataFrame:
    """(doc_id, text) -> doc_id, k, fp, root (names the component), component_id (smallest doc_id that links reach, itself included): one row per document row.

    Copies share a fingerprint and are one node of the search, so a group of them costs one row, however large. A node is
    named by its smallest doc_id, so that the smallest node of a component says its id, without another join. Null
    and empty texts have fingerprint zero and are linked like any other. Rows with a null doc_id take part; they get
    the smallest id of their component, null if it has none. Repeated ids are separate rows. Other columns are not
    looked at. An empty table gives no rows.
    """
    rows = stored(with_fingerprints(docs), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    nodes = stored(nodes.select("fp", "n", F.struct(F.col("first").isNull().alias("none"), "first", "fp").alias("node")), "nodes")
    roots = connected_components(links(nodes.select("fp", "node"), most), "a", "b")
    linked = nodes.join(roots, "node", "left").select("fp", "n", F.coalesce("root", "node").alias("root"))
    linked = stored(linked.select("fp", "n", F.col("root.fp").alias("root"), F.col("root.first").alias("component_id")), "named")
    # Fingerprints of more than a thousandth of all rows: a thousand at most.
    heavy = linked.where(F.col("n") > max(1_000, rows.count() // 1_000)).select("fp")
    return spread_join(rows, linked.drop("n"), "fp", heavy).select("doc_id", "k", "fp", "root", "component_id")


def keep_one(docs: DataFrame, most: int = 4) -> DataFrame:
    """The documents, with all their columns, but of each component only the row with the smallest doc_id.

    Rows without an id stay only where a component has no other; of rows that agree in id and text one stays. Null texts
    count as empty, and columns may be called anything. An empty table stays empty.
    """
    i, k, n = fresh(docs.columns, "id", "key", "n")
    found = near_duplicates(docs, most)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("first"))
    first = first.select(F.coalesce("first.doc_id", F.lit(-(2**63))).alias(i), F.col("first.k").alias(k)).distinct()
    own, key = row_keys()
    rows = docs.withColumns({i: own, k: key}).join(first, [i, k], "left_semi")
    rest = [F.col(f"`{c}`") for c, kind in docs.dtypes if c not in ("doc_id", "text") and not kind.startswith(("map", "variant"))]
    order = W.partitionBy(i, k).orderBy(*(rest or [k]))
    return rows.withColumn(n, F.row_number().over(order)).where(F.col(n) == 1).select(*[f"`{c}`" for c in docs.columns])
