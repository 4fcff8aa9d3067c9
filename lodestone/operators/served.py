"""A graph made ready to be asked: nodes, edges of a day, closures, mentions and the text index are built once and stored by buckets; questions read what they need of them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import stored
from . import graph
from .retrieval import link_names
from .textindex import TextIndex

#: Folders of closures by the node where they start, of mentions by document.
BUCKETS = 32


def _bucket(key: str | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


class ServedGraph:
    """``nodes``, ``edges``, ``closures`` (bucket, src, dst, hops, weight, path), ``mentions`` (bucket, doc_id, node_id), ``texts``: all as of when they were built. ``texts`` may come later: what is asked without words needs none."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.nodes, self.edges, self.closures, self.mentions = (spark.read.parquet(f"{path}/{name}") for name in ("nodes", "edges", "closures", "mentions"))
        self.path = path

    @cached_property
    def texts(self) -> TextIndex:
        return TextIndex(self.nodes.sparkSession, f"{self.path}/texts")

    @classmethod
    def build(cls, path: str, nodes: DataFrame, edges: DataFrame, docs: DataFrame | None, mentions: DataFrame, hops: int = 2) -> ServedGraph:
        """nodes (node_id, name, masking_tier, ...), edges as for closure(), docs (doc_id, text; None: add_texts() is left for later), mentions (doc_id, node_id)."""
        nodes.write.parquet(f"{path}/nodes")
        edges.write.parquet(f"{path}/edges")
        edges = nodes.sparkSession.read.parquet(f"{path}/edges")
        for name, rows, key in (("closures", graph.closure(edges, hops), "src"), ("mentions", mentions.select("doc_id", "node_id").distinct(), "doc_id")):
            # a bucket may be written by several tasks: a hot key fills no single one
            spread = rows.withColumn("bucket", _bucket(key)).repartition("bucket", F.pmod(F.xxhash64(*rows.columns[:2]), F.lit(4)))
            spread.sortWithinPartitions("bucket", key).write.partitionBy("bucket").parquet(f"{path}/{name}")
        found = cls(nodes.sparkSession, path)
        if docs is not None:
            found.add_texts(docs)
        return found

    def add_texts(self, docs: DataFrame) -> None:
        TextIndex.build(docs, f"{self.path}/texts")

    def expand(self, ids: list[str], hops: int = 2, tier: int = 0, limit: int = 200) -> DataFrame:
        """What some nodes reach: graph.expand() over the stored closures; only the buckets and row groups of these nodes are read."""
        spark = self.nodes.sparkSession
        seeds = spark.createDataFrame([(x,) for x in ids], "node_id string")
        buckets = [r[0] for r in seeds.select(_bucket("node_id")).distinct().collect()]
        rows = self.closures.where(F.col("bucket").isin(buckets or [-1]) & F.col("src").isin(ids or [""])).drop("bucket")
        return graph.expand(rows, seeds, self.nodes, hops, tier, limit)

    def local(self, questions: DataFrame, hits: int = 20, seeds: int = 10, edges: int = 200, limit: int = 60) -> DataFrame:
        """(query_id, text) -> query_id, kind, id, score, rank: texts, the nodes they mention as seeds, the closures around these, one ranking a question.

        Chunks add a twentieth of their seeds' weights to their score; edges have .4 and a tenth of both ends' weights, nodes .3 and a tenth of theirs.
        """
        found = stored(self.texts.search(questions, hits).select("query_id", "doc_id", "score", _bucket("doc_id").alias("bucket")), "hits")
        said = stored(found.join(self.mentions, ["bucket", "doc_id"]).select("query_id", "doc_id", "score", "node_id"), "said")
        best = self._first(said.groupBy("query_id", "node_id").agg(F.round(F.sum("score"), 6).alias("seed")), seeds, F.desc("seed"), "node_id")
        best = stored(best.withColumn("bucket", _bucket("node_id")), "seeds")
        around = self.closures.where(F.col("hops") <= 2).join(best.select("query_id", "bucket", F.col("node_id").alias("src")), ["bucket", "src"]).select("query_id", "src", "dst", "hops", "weight")
        around = stored(self._first(around, edges, "hops", F.desc("weight"), "src", "dst").select("query_id", "src", "dst"), "around")
        weight = lambda c: best.select("query_id", F.col("node_id").alias(c), F.col("seed").alias(f"{c}_seed"))
        zero = lambda c: F.coalesce(c, F.lit(0.0))
        own = said.join(weight("node_id"), ["query_id", "node_id"]).groupBy("query_id", "doc_id").agg(F.sum("node_id_seed").alias("s"))
        one = found.join(own, ["query_id", "doc_id"], "left").select("query_id", F.lit("chunk").alias("kind"), F.col("doc_id").cast("string").alias("id"), (F.col("score") + 0.05 * zero("s")).alias("score"))
        two = around.join(weight("src"), ["query_id", "src"], "left").join(weight("dst"), ["query_id", "dst"], "left")
        two = two.select("query_id", F.lit("edge").alias("kind"), F.concat_ws(">", "src", "dst").alias("id"), (0.4 + 0.1 * (zero("src_seed") + zero("dst_seed"))).alias("score"))
        ends = around.select("query_id", F.explode(F.array("src", "dst")).alias("id")).distinct()
        three = ends.join(weight("id"), ["query_id", "id"], "left").select("query_id", F.lit("node").alias("kind"), "id", (0.3 + 0.1 * zero("id_seed")).alias("score"))
        every = one.unionByName(two).unionByName(three).withColumn("score", F.round("score", 6))
        return self._first(every, limit, F.desc("score"), "kind", "id")

    def paths(self, questions: DataFrame, max_hops: int = 6, tier: int = 0) -> DataFrame:
        """(query_id, text, a, b) -> query_id, kind, id, score, rank: how the nodes named a and b are connected, or a local answer where a name is not known.

        Names are those of the nodes that the caller may see whose trigrams are most alike. A question with both names known has its
        shortest path (kind path, score 1), or no row if there is none within max_hops; all are looked for at once.
        """
        asked = stored(questions.select("query_id", "text", "a", "b"), "asked")
        names = asked.select(F.explode(F.array("a", "b")).alias("text")).where("text IS NOT NULL").distinct().withColumn("query_id", F.col("text"))
        linked = stored(link_names(names, self.nodes.where(F.col("masking_tier") <= tier), limit=1).select(F.col("query_id").alias("name"), "node_id"), "linked")
        ends = asked.select(F.col("query_id").alias("pair"), "a", "b")
        for c in ("a", "b"):
            ends = ends.join(linked.withColumnsRenamed({"name": c, "node_id": f"{c}_id"}), c)
        ends = stored(ends.select("pair", F.col("a_id").alias("a"), F.col("b_id").alias("b")), "ends")
        found = graph.shortest_paths(self.edges, ends, self.nodes, max_hops, tier)
        found = found.select(F.col("pair").alias("query_id"), F.lit("path").alias("kind"), F.array_join("path", ">").alias("id"), F.lit(1.0).alias("score"), F.lit(1).cast("long").alias("rank"))
        rest = asked.join(ends.select(F.col("pair").alias("query_id")), "query_id", "left_anti").select("query_id", "text")
        return found.unionByName(self.local(rest).select(found.columns))

    @staticmethod
    def _first(rows: DataFrame, most: int, *order: Column | str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
