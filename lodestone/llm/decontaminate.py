"""Benchmark decontamination: a broadcast hash set of test n-grams against the word windows of the training texts.

Spark expressions only. Three steps:

1. Coarse scan of every whole text. A run of ``w`` words always holds a gram of ``j = w // 2 + 1`` words that starts at a
   multiple of ``k = w - j + 1``, so one gram in ``k`` positions is hashed and looked up among all ``j``-grams of the
   benchmark. This finds each document with a window and perhaps a few more.
2. Candidates only: each of their windows is hashed and looked up among the benchmark's windows.
3. Verification: the words at each hit are compared with the window's own words, so that hash collisions count for nothing.

Broadcast are hashes and numbers only, and only if their count, which is measured first, proves them small; a larger
benchmark goes through shuffled joins and gives the same rows. Each text is split once for all lengths of windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, heavy_keys, row_keys, spread_join, stored

#: What separates words, once A-Z are lower-cased; all other code points, non-ASCII ones included, belong to words.
GAPS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The same before A-Z are lower-cased, and its complement.
GAPS_ANY = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Most rows of hashes or of (window, item) numbers that are broadcast: one or two longs each, so up to 32 MB, and about 64 MB once they are hashed.
BROADCAST_ROWS = 2_000_000


def words(lowered: Column) -> Column:
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), GAPS), lambda w: w != "")


def _small(df: DataFrame) -> DataFrame:
    """A stored table of numbers, to be broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


def benchmark_windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """(item_id, text) -> one row per item and distinct window: item_id, w (its words), win array<string>.

    An item of fewer than ``n`` words is one window; one without words, or null, has none.
    """
    ws = benchmark.select(F.col("item_id").alias("item_id"), words(ascii_lower(F.col("text"))).alias("ws")).where(F.size("ws") > 0)
    ws = ws.withColumn("w", F.least(F.size("ws"), F.lit(n)))
    return ws.select("item_id", "w", F.explode(F.transform(F.sequence(F.lit(1), F.size("ws") - F.col("w") + 1), lambda i: F.slice("ws", i, F.col("w")))).alias("win")).distinct()


def find_windows(documents: DataFrame, benchmark: DataFrame, n: int = 13) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, spans, items): each document row with key (id, k) and n_words; its verified spans (id, k, p, w); its (id, k, item_id).

    ``p`` counts words from 1. Rows that repeat share a key, and so their spans.
    """
    own, key = row_keys()
    rows = documents.select("doc_id", own.alias("id"), key.alias("k"), "text")
    wins = stored(benchmark_windows(benchmark, n), "windows")
    texts = wins.select("w", "win").distinct().withColumns({"no": F.monotonically_increasing_id(), "h": F.xxhash64("w", "win")})
    texts = stored(texts, "window-texts")
    lengths = sorted(r["w"] for r in wins.select("w").distinct().collect())  # at most n
    steps = {w: (w // 2 + 1, w - w // 2) for w in lengths}  # words of a gram, and how many starts lie in a window

    def hashes(ws: str, w: int, size: int, step: int) -> Column:
        """Hashes of all runs of ``size`` words that start at multiples of ``step``, with the window length that they are for."""
        return F.when(F.size(ws) >= w, F.transform(F.sequence(F.lit(1), F.size(ws) - size + 1, F.lit(step)), lambda i: F.struct(i.alias("p"), F.lit(w).alias("w"), F.xxhash64(F.lit(w), F.slice(ws, i, size)).alias("h")))).otherwise(F.array())

    def everywhere(ws: str, coarse: bool) -> Column:
        each = [hashes(ws, w, steps[w][0] if coarse else w, steps[w][1] if coarse else 1) for w in lengths]
        return each[0] if len(each) == 1 else F.concat(*each)

    counted = rows.withColumn("n_words", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), GAPS_ANY), lambda w: w != "")))
    if not lengths:
        none = rows.select("id", "k").where(F.lit(False))
        return counted, none.withColumns({"p": F.lit(1), "w": F.lit(1)}), none.join(benchmark.select("item_id").limit(0))
    grams = None
    for w in lengths:
        some = texts.where(F.col("w") == w).select(F.explode(hashes("win", w, steps[w][0], 1)["h"]).alias("h"))
        grams = some if grams is None else grams.unionByName(some)
    grams = stored(grams.distinct(), "grams")
    # A-Z only, as in the windows: the lower form of other letters may depend on those around the word.
    at = rows.select("id", "k", words(ascii_lower(F.col("text"))).alias("ws")).select("id", "k", F.explode(everywhere("ws", True)["h"]).alias("h"))
    keys = stored(at.join(_small(grams), "h", "left_semi").select("id", "k").distinct(), "suspects")
    suspects = rows.join(keys, ["id", "k"], "left_semi").dropDuplicates(["id", "k"]).select("id", "k", words(ascii_lower(F.col("text"))).alias("ws"))
    suspects = stored(suspects, "suspect-words")
    at = suspects.select("id", "k", F.explode(everywhere("ws", False)).alias("x")).select("id", "k", "x.*")
    found = stored(at.join(_small(stored(texts.select("h").distinct(), "hashes")), "h", "left_semi"), "found")
    # A window that very many documents hold is sent to them; all others meet their texts by a shuffle.
    hits = spread_join(found.select("id", "k", "p", "h"), texts, "h", stored(heavy_keys(found, "h"), "heavy"))
    hits = hits.groupBy("id", "k").agg(F.collect_list(F.struct("p", "w", "win", "no")).alias("hits"))
    sure = suspects.join(hits, ["id", "k"]).select("id", "k", F.explode(F.filter("hits", lambda x: F.slice("ws", x["p"], x["w"]) == x["win"])).alias("hit"))
    sure = stored(sure.select("id", "k", "hit.p", "hit.w", "hit.no"), "hits")
    spans = sure.select("id", "k", "p", "w").distinct()
    named = stored(wins.join(texts, ["w", "win"]).select("item_id", "no"), "named")
    items = sure.select("id", "k", "no").distinct().join(_small(named), "no").select("id", "k", "item_id").distinct()
    return counted, spans, items


def contamination(documents: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items (ids as sorted strings), hits (numbers of the hit words), contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated if any word is and at least one in
    ``share`` is. Null and empty texts have no words and are clean. Repeated rows are judged alike, each on its own row;
    a null doc_id is an id like any other. An item without an id hits words, but has no id to be counted or named by.
    Very long texts are scanned whole. Columns beside doc_id and text are not looked at. An empty benchmark hits nothing.
    """
    rows, spans, items = find_windows(documents, benchmark, n)
    hit = spans.select("id", "k", F.explode(F.sequence(F.col("p"), F.col("p") + F.col("w") - 1)).alias("p")).groupBy("id", "k").agg(F.array_sort(F.collect_set("p")).alias("hits"))
    ids = items.groupBy("id", "k").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    none = F.array().cast("array<string>")
    out = rows.select("doc_id", "id", "k", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words")).join(hit.join(ids, ["id", "k"], "left"), ["id", "k"], "left")
    out = out.select("doc_id", "id", "k", "n_words", F.coalesce("hits", F.array().cast("array<int>")).alias("hits"), F.coalesce("items", none).alias("items"))
    out = out.withColumns({"n_hit": F.size("hits").cast("long"), "n_items": F.size("items").cast("long")})
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def remove_documents(documents: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with all their columns, whatever these are called.

    Null and empty texts stay; rows that repeat stay or go together; empty tables and benchmarks remove nothing.
    """
    i, k = fresh(documents.columns, "id", "key")
    bad = contamination(documents, benchmark, n, share).where("contaminated").select(F.col("id").alias(i), F.col("k").alias(k)).distinct()
    own, key = row_keys()
    return documents.withColumns({i: own, k: key}).join(bad, [i, k], "left_anti").drop(i, k)


def remove_spans(documents: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """All documents, without the words that are hit; what stands between words stays. Other columns are kept, whatever they are called.

    Null and empty texts stay as they are; rows that repeat are cut alike; empty tables and benchmarks change nothing.
    """
    i, k, at = fresh(documents.columns, "id", "key", "hits")
    report = contamination(documents, benchmark, n).where("n_hit > 0").select(F.col("id").alias(i), F.col("k").alias(k), F.col("hits").alias(at)).dropDuplicates([i, k])
    own, key = row_keys()
    keyed = documents.withColumns({i: own, k: key}).join(report, [i, k], "left")
    gaps, ws = F.split("text", WORD), F.expr(f"regexp_extract_all(text, r'{WORD}', 0)")
    hit = F.map_from_arrays(at, F.transform(at, lambda h: F.lit(True)))
    kept = F.array_join(F.transform(F.zip_with(gaps, ws, lambda g, w: F.struct(g.alias("g"), w.alias("w"))), lambda s, i: F.concat(s["g"], F.when(F.element_at(hit, i + 1).isNull(), F.coalesce(s["w"], F.lit(""))).otherwise(F.lit("")))), "")
    return keyed.withColumn("text", F.when(F.col(at).isNull(), F.col("text")).otherwise(kept)).select(*[f"`{c}`" for c in documents.columns])


def digest(report: DataFrame) -> DataFrame:
    """The columns of the contract, from contamination()."""
    return report.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
