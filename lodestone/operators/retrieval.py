"""Lexical, vector and graph evidence, and its fusion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import terms, trigram_similarity, trigrams
from ..functions.vectors import cosine
from ..sources.shared import stored
from .joins import spread_join
from .nearest import knn

__all__ = ["asked_postings", "blended", "bm25", "counted", "knn", "lengths", "link_names", "modes", "one_score", "pick_mode", "plan", "postings", "rank_hits", "recall", "rrf", "term_overlap", "top"]


def postings(docs: DataFrame, id_column: str = "doc_id", terms_of: DataFrame | None = None) -> DataFrame:
    """counted(), stored."""
    return stored(counted(docs, id_column, terms_of), "postings")


def counted(docs: DataFrame, id_column: str = "doc_id", terms_of: DataFrame | None = None) -> DataFrame:
    """doc_id, term, tf, length of every text; with ``terms_of`` (query_id, text) of the terms alone that those texts hold."""
    ts = docs.select(F.col(id_column).alias("doc_id"), terms("text").alias("ts"))
    rows = ts.select("doc_id", F.size("ts").alias("length"), F.explode("ts").alias("term"))
    if terms_of is not None:
        rows = rows.join(terms_of.select(F.explode(terms("text")).alias("term")).distinct(), "term", "left_semi")
    return rows.groupBy("doc_id", "term").agg(F.count("*").alias("tf"), F.max("length").alias("length"))


def lengths(docs: DataFrame) -> tuple[int, float]:
    """How many texts there are, those without terms included, and how many terms they have on average."""
    n, total = docs.agg(F.count("*"), F.sum(F.size(terms("text")))).first()
    return n, (total or 0) / n if n else 1.0


def asked_postings(docs: DataFrame, queries: DataFrame, id_column: str = "doc_id") -> tuple[DataFrame, int, float]:
    """(doc_id, length, term, tf of the terms that queries (query_id, text) hold, stored; the two figures of lengths()); texts are cut into words once for all three.

    Each text has a row with an empty term besides, which counts it: no text holds such a term.
    """
    asked = queries.select(F.explode(terms("text")).alias("term")).distinct()
    asked = asked.unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term")))  # with no queries, too
    ts = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(terms("text"), F.array().cast("array<string>")).alias("ts"))
    rows = ts.select("doc_id", F.size("ts").alias("length"), F.explode(F.concat(F.array(F.lit("")), "ts")).alias("term")).join(asked, "term", "left_semi")
    index = stored(rows.groupBy("doc_id", "length", "term").agg(F.count("*").alias("tf")), "postings")
    n, total = index.where("term = ''").agg(F.sum("tf"), F.sum(F.col("tf") * F.col("length"))).first()
    return index.where("term != ''"), n or 0, (total or 0) / n if n else 1.0


def bm25(index: DataFrame, queries: DataFrame, n_docs: int, mean_length: float, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """query_id, doc_id, score. queries: (query_id, text). Terms of the queries alone are counted and joined."""
    asked = queries.select("query_id", F.explode(F.array_distinct(terms("text"))).alias("term"))
    hits = index.join(asked.select("term").distinct(), "term", "left_semi")
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(mean_length)))
    return hits.join(df, "term").join(asked, "term").groupBy("query_id", "doc_id").agg(F.sum(part).alias("score"))


def top(rows: DataFrame, by: str, k: int, group: str | None = "query_id", tie: str = "doc_id") -> DataFrame:
    """The k best of each group, or of all, with rank from 1."""
    if group is None:
        return rows.orderBy(F.desc(by), tie).limit(k)
    w = W.partitionBy(group).orderBy(F.desc(by), tie)
    return rows.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def term_overlap(docs: DataFrame, queries: DataFrame, least: int = 3) -> DataFrame:
    """query_id, doc_id, score: how many of the query's words of ``least`` letters or more a text has; words are cut at white space."""
    cut = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda w: F.length(w) >= least))
    asked = queries.select("query_id", F.explode(cut(F.col("text"))).alias("term"))
    held = docs.select("doc_id", F.explode(cut(F.col("text"))).alias("term"))
    return held.join(asked, "term").groupBy("query_id", "doc_id").agg(F.count("*").alias("score"))


def rrf(lists: list[DataFrame], k: int = 60, keys: tuple[str, ...] = ("query_id", "doc_id")) -> DataFrame:
    """Reciprocal rank fusion of lists with a rank column: the sum of 1 / (k + rank)."""
    every = reduce(DataFrame.unionByName, [x.select(*keys, (1.0 / (k + F.col("rank"))).alias("part")) for x in lists])
    return every.groupBy(*keys).agg(F.sum("part").alias("score"))


def link_names(names: DataFrame, nodes: DataFrame, least: float = 0.3, limit: int = 5) -> DataFrame:
    """(query_id, text) -> query_id, node_id, score: nodes whose names' trigrams are alike.

    Of s trigrams, the s - ceil(least * s) + 1 rarest are looked up: names that are alike share one of them, and the
    trigrams that all names share are hardly ever among them.
    """
    q = names.select("query_id", trigrams(F.col("text")).alias("qt"))
    n = stored(nodes.select("node_id", trigrams(F.col("name")).alias("nt")), "trigrams")
    often = stored(n.select(F.explode("nt").alias("t")).groupBy("t").agg(F.count("*").alias("n")), "often")
    heavy = stored(often.orderBy(F.desc("n"), "t").limit(1_000).select("t"), "heavy")

    def rare(rows: DataFrame, key: str, grams: str) -> DataFrame:
        each = rows.select(key, F.explode(grams).alias("t"))
        each = spread_join(each, often, "t", heavy).unionByName(each.join(often, "t", "left_anti").withColumn("n", F.lit(0).cast("long")))
        ranked = each.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("ts"))
        size = F.size("ts")
        return ranked.select(key, F.explode(F.slice("ts", F.lit(1), (size - F.ceil(size * least - 1e-9) + 1).cast("int"))).alias("x")).select(key, F.col("x.t").alias("t"))

    near = rare(q, "query_id", "qt").join(rare(n, "node_id", "nt"), "t").select("query_id", "node_id").distinct()
    pairs = near.join(q, "query_id").join(n, "node_id")
    scored = pairs.select("query_id", "node_id", F.round(trigram_similarity(F.col("qt"), F.col("nt")), 6).alias("score")).where(F.col("score") >= least)
    return top(scored, "score", limit, "query_id", "node_id")


def one_score(lexical: DataFrame, near: DataFrame, weight: float = 10.0, limit: int = 20) -> DataFrame:
    """(query_id, doc_id, score) of words and of vectors, added up: a document that only one side found has nothing from the other."""
    rows = lexical.select("query_id", "doc_id", "score").unionByName(near.select("query_id", "doc_id", (weight * F.col("score")).alias("score")))
    return top(rows.groupBy("query_id", "doc_id").agg(F.round(F.sum("score"), 6).alias("score")), "score", limit, "query_id", "doc_id")


def rank_hits(chunks: DataFrame, edges: DataFrame, nodes: DataFrame, seeds: DataFrame, k: int = 60) -> DataFrame:
    """kind, id, score. chunks (id, score, node_ids), edges (id, src, dst), nodes (id); seeds (node_id, seed).

    A chunk adds .05 of its nodes' seeds to its score; an edge has .4 and a tenth of both ends' seeds; a node .3 and a tenth of its seed.
    """
    own = chunks.select("id", "score", F.explode_outer("node_ids").alias("node_id")).join(seeds, "node_id", "left").groupBy("id", "score").agg(F.coalesce(F.sum("seed"), F.lit(0.0)).alias("s"))
    one = own.select(F.lit("chunk").alias("kind"), "id", (F.col("score") + 0.05 * F.col("s")).alias("score"))
    end = lambda c: seeds.select(F.col("node_id").alias(c), F.col("seed").alias(f"{c}_seed"))
    two = edges.join(end("src"), "src", "left").join(end("dst"), "dst", "left")
    two = two.select(F.lit("edge").alias("kind"), "id", (0.4 + 0.1 * (F.coalesce("src_seed", F.lit(0.0)) + F.coalesce("dst_seed", F.lit(0.0)))).alias("score"))
    three = nodes.join(seeds.withColumnRenamed("node_id", "id"), "id", "left").select(F.lit("node").alias("kind"), "id", (0.3 + 0.1 * F.coalesce("seed", F.lit(0.0))).alias("score"))
    return one.unionByName(two).unionByName(three).withColumn("score", F.round("score", 6)).orderBy(F.desc("score"), "kind", "id").limit(k)


def blended(hits: DataFrame, second: DataFrame, share: float = 0.5, limit: int = 60) -> DataFrame:
    """kind, id, score: ranked hits (kind, id, score) with a second ranker's scores (kind, id, score) mixed in; a hit that it left out keeps its own."""
    other = second.select("kind", "id", F.col("score").alias("again"))
    score = F.when(F.col("again").isNull(), F.col("score")).otherwise((1 - share) * F.col("score") + share * F.col("again"))
    return hits.join(other, ["kind", "id"], "left").select("kind", "id", F.round(score, 6).alias("score")).orderBy(F.desc("score"), "kind", "id").limit(limit)


#: What a question must say for a mode, tried in this order; our own choice of words.
CUES = {
    "lineage": ("came from", "comes from", "origin", "upstream", "downstream", "depend", "computed from"),
    "path": ("between", "route from", "reach", "via", "how is", "how are"),
    "global": ("in general", "big picture", "main topics", "overview", "summar", "mostly about", "patterns"),
}


def pick_mode(question: str, cues: dict[str, tuple[str, ...]] = CUES, broad: int = 15) -> str:
    """lineage, path, global, drift (a global question of more than ``broad`` words) or local, by what the question says."""
    q = f" {' '.join(question.lower().split())} "
    mode = next((m for m, said in cues.items() if any(f" {c}" in q for c in said)), "local")
    return "drift" if mode == "global" and len(q.split()) > broad else mode


def modes(questions: DataFrame, cues: dict[str, tuple[str, ...]] = CUES, broad: int = 15) -> DataFrame:
    """pick_mode() for a table of questions (query_id, text): query_id, mode. A missing question is local."""
    said = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower("text"), r"\s+", " ")), F.lit(" "))
    mode = F.lit("local")
    for name, words in reversed(cues.items()):
        mode = F.when(reduce(lambda a, b: a | b, [said.contains(f" {w}") for w in words]), name).otherwise(mode)
    long = F.size(F.split(F.trim(said), " ")) > broad
    return questions.select("query_id", mode.alias("m"), long.alias("long")).select("query_id", F.when((F.col("m") == "global") & F.col("long"), "drift").otherwise(F.col("m")).alias("mode"))


def plan(question: str, most: int = 12) -> dict:
    """Seed terms of a question (longer words, and short ones in capitals) and whether it asks for numbers or data."""
    words = [w.strip("?,.;:") for w in question.split()]
    seeds = [w for w in words if len(w) > 3 or (len(w) >= 2 and w.isupper())][:most]
    low = question.lower()
    return {"mode": pick_mode(question), "seeds": seeds, "calculation": any(c in low for c in ("calculate", "compute", "how much", "total", "ratio")), "data": any(c in low for c in ("latest", "today", "current", "value of"))}


def recall(memory: DataFrame, query: Column, k: int = 8, now: str | None = None, tie: str = "vec_id") -> DataFrame:
    """(vec_id, embedding, importance, scope, user_id, expires_at): the k memories with the least cosine distance less a tenth of their importance."""
    live = memory.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.to_timestamp(F.lit(now)))) if now else memory
    return live.withColumn("order", F.round(1 - cosine(F.col("embedding"), query) - 0.1 * F.col("importance"), 6)).orderBy("order", tie).limit(k)
