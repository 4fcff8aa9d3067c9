"""Importance resampling towards a target distribution: hashed word n-grams, log-ratio weights, Gumbel top-k by an exact histogram.

Two passes over the texts, each in Arrow batches: one counts the buckets of all features of the corpus, one adds up every
document's gains from an array of one gain a bucket. A batch's texts are worked on together as one array of bytes: words
are runs of word bytes (every byte of a non-ASCII letter is one), and checksums of runs of words come from those of the
words, as the checksum of two strings joined is linear in those of its parts.

The draw needs no sort of all documents: a histogram of the whole-number scores, summed from above, gives the rank at which
each score begins and the score at which the draw ends; only what lies above is numbered, within each score by doc_id.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import row_keys, stored, tidy, totals_before

#: Buckets, words of the longest feature, words a document needs to be drawn, seed of the noise.
BUCKETS, LONGEST_RUN, LEAST_WORDS, SEED = 10_000, 3, 20, 42
#: Bytes of texts that are worked on at once; letters from which on a word's checksum is taken by itself.
CHUNK, LONG_WORD = 4 << 20, 48


def _byte_maps() -> tuple[np.ndarray, np.ndarray]:
    """(byte -> byte with A-Z lower-cased, byte -> does it belong to a word)."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    return lower, word


_LOWERED, _IN_WORD = _byte_maps()
_CRC = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
#: The register's step for one byte: crc' = _STEP[(crc ^ byte) & 255] ^ (crc >> 8); from the checksums of single bytes.
_STEP = (_CRC ^ np.uint32(0xFFFFFFFF) ^ np.uint32(0x00FFFFFF))[np.arange(256) ^ 0xFF]


def _shifted(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Checksums carried over what ``table`` (4, 256) stands for."""
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


@lru_cache(maxsize=4_096)
def _shift_table(length: int) -> np.ndarray:
    """(4, 256): what ``length`` zero bytes make of each byte of a checksum. By halving, as the step is linear."""
    if length == 1:
        each = np.arange(256, dtype=np.uint32)
        return np.stack([_STEP[each], *(each << np.uint32(8 * (k - 1)) for k in (1, 2, 3))])
    half = _shift_table(length // 2)
    twice = _shifted(half, half)
    return _shifted(twice, _shift_table(1)) if length % 2 else twice


def _carry(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each checksum carried over its own number of bytes."""
    sizes, which = np.unique(lengths, return_inverse=True)
    t = np.stack([_shift_table(int(n)) for n in sizes]) if len(sizes) else np.zeros((0, 4, 256), np.uint32)
    return t[which, 0, crc & 255] ^ t[which, 1, crc >> 8 & 255] ^ t[which, 2, crc >> 16 & 255] ^ t[which, 3, crc >> 24]


def _word_checksums(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of each word: letter by letter for all short words at once, by themselves for long ones."""
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    order = np.argsort(length, kind="stable")
    sizes = length[order]
    for k in range(min(int(sizes[-1]), LONG_WORD) if len(sizes) else 0):
        at = order[np.searchsorted(sizes, k, "right") :]
        crc[at] = _STEP[(crc[at] ^ data[start[at] + k]) & 255] ^ (crc[at] >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > LONG_WORD):
        crc[i] = zlib.crc32(data[start[i] : start[i] + length[i]])
    return crc


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature): all runs of one to three words of texts in UTF-8."""
    data = _LOWERED[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = np.concatenate([[False], _IN_WORD[data], [False]]).astype(np.int8)
    turns = np.diff(inside)
    start, stop = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    owner, length = np.searchsorted(ends, start, "right"), stop - start
    crc = _word_checksums(data, start, length)
    spaced = _carry(np.full(len(crc), zlib.crc32(b" "), np.uint32), length) ^ crc  # of the word with a space before it
    owners, buckets, run = [owner], [crc % BUCKETS], crc
    for n in range(1, LONGEST_RUN):
        run = _carry(run[:-1], length[n:] + 1) ^ spaced[n:]
        same = owner[n:] == owner[: len(run)]
        owners.append(owner[n:][same])
        buckets.append(run[same] % BUCKETS)
    return np.bincount(owner, minlength=len(texts)), np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


def _in_chunks(rows: pd.DataFrame) -> Iterator[tuple[slice, list[bytes]]]:
    """A batch's rows, some CHUNK bytes at a time; a longer text is a chunk of its own."""
    texts = [(t or "").encode("utf-8", "surrogatepass") for t in rows["text"]]
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield slice(begin, i), texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts)), texts[begin:]


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one number a bucket at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, part in _in_chunks(b):
                counts += np.bincount(features(part)[2], minlength=BUCKETS)
        tidy()
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"bucket": at, "n": counts[at]})

    sums = texts.select("text").where("text IS NOT NULL").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """One whole-number gain a bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))), in doubles."""
    s_all, t_all = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(documents: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, k (a hash of id and text), n_words, n_features, weight of every row: its features' gains, summed exactly."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at, part in _in_chunks(b):
                words, owner, bucket = features(part)
                order = np.argsort(owner, kind="stable")
                upto = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
                ends = np.cumsum(np.bincount(owner, minlength=len(part)))
                starts = np.concatenate([[0], ends[:-1]])
                own = b.iloc[at]
                yield pd.DataFrame({"doc_id": own["doc_id"], "k": own["k"], "n_words": words, "n_features": ends - starts, "weight": upto[ends] - upto[starts]})
        tidy()

    # A long id beside null ones would reach pandas as a double: ids travel as text.
    kind, (_, key) = documents.schema["doc_id"].dataType.simpleString(), row_keys()
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), key.alias("k"), "text")
    return rows.mapInPandas(run, "doc_id string, k long, n_words long, n_features long, weight long").withColumn("doc_id", F.col("doc_id").cast(kind))


def noise(doc_id: Column) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256 of ``42:<doc_id>``; a null id is written as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def draw(scored: DataFrame, percent: int) -> DataFrame:
    """(doc_id, k, n_words, n_features, weight, score) -> one row for all rows that agree in these: also m (how many), first (rank) and drawn (of the m).

    The best ``percent`` of the N long enough rows are drawn. A score's rank begins after the rows of all larger scores;
    within a score rows follow each other by doc_id. Rows that repeat are numbered together, so not even a row that is a
    third of the table comes together in one task.
    """
    named = ["doc_id", "k", "n_words", "n_features", "weight", "score"]
    kinds = stored(scored.groupBy(*named).agg(F.count("*").alias("m")), "kinds")
    histogram = stored(kinds.where(F.col("n_words") >= LEAST_WORDS).groupBy("score").agg(F.sum("m").alias("here")).withColumn("fall", -F.col("score")), "histogram")
    wanted = (histogram.agg(F.sum("here")).first()[0] or 0) * percent // 100
    offsets = stored(totals_before(histogram, [], "fall", "here", "above").select("score", "above"), "offsets")
    cutoff = offsets.where(F.col("above") < wanted).agg(F.min("score")).first()[0]  # the last score that is drawn from
    reached = F.lit(False) if cutoff is None else (F.col("n_words") >= LEAST_WORDS) & (F.col("score") >= cutoff)
    upto = W.partitionBy("score").orderBy("doc_id", "n_features", "k").rowsBetween(W.unboundedPreceding, -1)
    above = kinds.where(reached).join(offsets, "score").withColumn("first", F.col("above") + F.coalesce(F.sum("m").over(upto), F.lit(0)) + 1)
    drawn = F.least(F.col("m"), F.greatest(F.lit(wanted) - F.col("first") + 1, F.lit(0)))
    rest = kinds.where(~reached).withColumns({"first": F.lit(None).cast("long"), "drawn": F.lit(0).cast("long")})
    return above.withColumn("drawn", drawn).select(*rest.columns).unionByName(rest)


def _scored(documents: DataFrame, target: DataFrame) -> DataFrame:
    gain = gains(bucket_counts(documents), bucket_counts(target))
    return weigh(documents, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id")))


def resample(documents: DataFrame, target: DataFrame, percent: int = 5) -> DataFrame:
    """Documents (doc_id, text) weighed by how much more likely their features are in the target's texts -> doc_id, n_features, weight, score, rank.

    Every row is returned; ``rank`` numbers those that are drawn, from 1, and is null for all others: the highest scores
    among rows of LEAST_WORDS words or more, ties to smaller doc_ids (null ones first). Null and empty texts have no
    words, no features and weight 0, and get a score, too. Rows that repeat are drawn as rows of their own. Texts of any
    length are read whole; an empty table gives no rows; an empty target makes all gains depend on the corpus alone.
    Columns beside doc_id and text are not looked at, whatever they are called.
    """
    each = F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("i")
    out = draw(_scored(documents, target), percent).select("doc_id", "n_features", "weight", "score", "first", "drawn", each)
    return out.select("doc_id", "n_features", "weight", "score", F.when(F.col("i") <= F.col("drawn"), F.col("first") + F.col("i") - 1).alias("rank"))


def drawn_documents(documents: DataFrame, target: DataFrame, percent: int = 5) -> DataFrame:
    """The drawn sample itself: doc_id, text, rank (from 1), as resample() numbers it. A row that repeats comes as often as it is drawn.

    Odd rows are treated as there.
    """
    picked = draw(_scored(documents, target), percent).where("drawn > 0")
    picked = picked.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"), "k", "first", "drawn")
    own, key = row_keys()
    texts = documents.select("doc_id", "text", own.alias("id"), key.alias("k")).join(picked, ["id", "k"])
    once = texts.dropDuplicates(["id", "k", "first"])
    return once.select("doc_id", "text", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("drawn") - 1)).alias("rank"))
