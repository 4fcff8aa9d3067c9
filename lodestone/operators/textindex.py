"""A stored inverted index in blocks: what a block's postings can add to a score at most is known without reading them, so searches leave blocks closed and stay exact."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import terms
from ..sources.shared import stored

#: Documents of a block, about; folders by term.
BLOCK, BUCKETS = 1_024, 64
#: Queries of a share, about; words that are counted at once, about.
ASKED, WORDS = 256, 500_000
#: Scores that differ by less may be equal once they are rounded.
SLACK = 2e-6


def _joined(rows: DataFrame, more: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by question; a question without an id is one, too."""
    return rows.join(more.withColumnRenamed("query_id", "own_id"), F.col("query_id").eqNullSafe(F.col("own_id")), how).drop("own_id")


def _counted(kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(kept..., ts) -> kept..., term, tf, length: a row for each different term of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pc.fill_null(pc.list_value_length(b.column("ts")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // WORDS, prepend=0)) if len(size) else []
            for lo, hi in zip([0, *cuts], [*cuts, len(size)], strict=True):
                some, length = b.slice(lo, hi - lo), size[lo:hi]
                words = pc.list_flatten(some.column("ts")).dictionary_encode()
                if not len(words):
                    continue
                at, tf = np.unique(np.repeat(np.arange(hi - lo), length) * len(words.dictionary) + words.indices.to_numpy(), return_counts=True)
                row, term = np.divmod(at, len(words.dictionary))
                made = [*[some.column(c).take(pa.array(row)) for c in kept], words.dictionary.take(pa.array(term)), pa.array(tf.astype(np.int32)), pa.array(length[row].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(made, [*kept, "term", "tf", "length"])

    return run


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Each row's place among the different values, and these in order; a missing one is a value, too."""
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def _best(k: int, fields: list[str], best_field: bool, digits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A block's postings (number, doc_id, part) and queries (query_id, field, number, weight) -> query_id, doc_id, score: each query's k best."""

    def run(held: pa.Table, wanted: pa.Table) -> pa.Table:
        docs, doc_ids = _codes(held["doc_id"])
        asks, query_ids = _codes(wanted["query_id"])
        number, part = held["number"].to_numpy(), held["part"].to_numpy()
        by_number, by_query = np.argsort(number, kind="stable"), np.argsort(asks, kind="stable")
        docs, part, number, asks = docs[by_number], part[by_number], number[by_number], asks[by_query]
        asked, weight = wanted["number"].to_numpy()[by_query], wanted["weight"].to_numpy()[by_query]
        field = pc.index_in(wanted["field"], pa.array(fields)).to_numpy()[by_query]
        lo, hi = np.searchsorted(number, asked, "left"), np.searchsorted(number, asked, "right")
        shape, out = (len(fields), len(doc_ids)), ([], [], [])
        for q, some in enumerate(np.split(np.arange(len(asks)), np.searchsorted(asks, np.arange(1, len(query_ids))))):
            n = hi[some] - lo[some]
            at = np.concatenate([np.arange(lo[i], hi[i]) for i in some])
            cell = np.repeat(field[some], n) * shape[1] + docs[at]
            total = np.bincount(cell, np.repeat(weight[some], n) * part[at], shape[0] * shape[1]).reshape(shape)
            hit = np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape) > 0
            found = np.flatnonzero(hit.any(0))
            score = np.round((np.where(hit, total, -np.inf).max(0) if best_field else total.sum(0))[found], digits)
            first = np.lexsort((found, -score))[:k]
            out[0].append(np.full(len(first), q))
            out[1].append(found[first])
            out[2].append(score[first])
        q, d, score = (np.concatenate([np.zeros(0, kind), *x]) for x, kind in zip(out, (np.int64, np.int64, float), strict=True))
        return pa.table({"query_id": query_ids.take(pa.array(q)), "doc_id": doc_ids.take(pa.array(d)), "score": score})

    return run


def _stored_postings(spark: SparkSession, path: str) -> DataFrame:
    # an index of nothing has no postings to read a schema from
    return spark.read.schema(spark.read.parquet(f"{path}/schema").schema).parquet(f"{path}/postings")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    """Postings with their parts, which the stored counts, lengths and means give."""
    rows, part = _stored_postings(spark, path), F.lit(None).cast("double")
    for r in spark.read.parquet(f"{path}/fields").collect():  # a row a field
        own = F.col("tf") * (r["k1"] + 1) / (F.col("tf") + r["k1"] * (1 - r["b"] + r["b"] * F.col("length") / (r["mean"] or 1.0)))
        part = F.when(F.col("field") == r["field"], own).otherwise(part)
    return rows.select("*", part.alias("part")).drop("tf", "length")


class TextIndex:
    """``postings`` (bucket, field, term, attributes, block, doc_id, part), ``bounds`` (field, term, attributes, block, bound, n), ``terms`` (field, term, df), ``fields`` (field, n, mean, k1, b).

    A block is a set of documents with the same attributes, the same one for all terms and fields. A posting's part is its
    BM25 weight without idf, a block's bound of a term the largest part in it, n how many of its documents hold the term.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.bounds, self.terms, self.fields = (spark.read.parquet(f"{path}/{name}") for name in ("bounds", "terms", "fields"))
        self.postings = _postings(spark, path)
        self.attributes = [c for c in self.postings.columns if c not in ("bucket", "field", "term", "block", "doc_id", "part")]

    @classmethod
    def build(cls, docs: DataFrame, path: str, fields: tuple[str, ...] = ("text",), attributes: tuple[str, ...] = (), block: int = BLOCK, k1: float = 1.2, b: float = 0.75) -> TextIndex:
        """(doc_id, fields..., attributes...) -> the index of all documents. Missing texts have no terms but count as documents; ids are unique."""
        spark, n = docs.sparkSession, docs.count()
        at = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-n // block)))).cast("int")
        # whole texts are shuffled by block before they are cut into words, postings never are: all that a block holds of a term is then in one task
        dealt = docs.select("doc_id", *attributes, at.alias("block"), *fields).repartition("block")
        said = dealt.select("doc_id", *attributes, "block", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("said")) for f in fields])).alias("h"))
        cut = said.select("doc_id", *attributes, "block", "h.field", "h.said").select("doc_id", *attributes, "block", "field", terms("said").alias("ts"))
        kept = ["doc_id", *attributes, "block", "field"]
        made = ", ".join([*[f"`{c}` {cut.schema[c].dataType.simpleString()}" for c in kept], "term string", "tf int", "length int"])
        tf = cut.mapInArrow(_counted(kept), made)
        posts = tf.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int"))
        # dealt out to buckets, but not sorted by their words: a document's postings lie beside each other
        posts.sortWithinPartitions("bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/postings")
        spark.createDataFrame([], posts.schema).coalesce(1).write.parquet(f"{path}/schema")
        sums = {r["field"]: r["s"] for r in _stored_postings(spark, path).groupBy("field").agg(F.sum("tf").alias("s")).collect()}  # a row a field
        held = [(f, n, float(sums.get(f, 0) / n if n else 0.0), float(k1), float(b)) for f in fields]
        spark.createDataFrame(held, "field string, n long, mean double, k1 double, b double").coalesce(1).write.parquet(f"{path}/fields")
        bounds = _postings(spark, path).groupBy(*attributes, "block", "field", "term").agg(F.max("part").alias("bound"), F.count("*").alias("n"))
        bounds.sortWithinPartitions("block").write.option("compression", "zstd").parquet(f"{path}/bounds")
        spark.read.parquet(f"{path}/bounds").groupBy("field", "term").agg(F.sum("n").alias("df")).write.parquet(f"{path}/terms")
        return cls(spark, path)

    def _asked(self, queries: DataFrame, boosts: dict[str, float]) -> DataFrame:
        """query_id, share, field, term, number, weight, bucket: idf times boost of each different term of a query that the index holds; terms of fields are numbered, queries dealt to shares of about ASKED."""
        spark = queries.sparkSession
        words = queries.select("query_id", F.explode(F.array_distinct(terms("text"))).alias("term")).distinct()
        boost = spark.createDataFrame([(f, float(x)) for f, x in boosts.items()], "field string, boost double")
        known = self.terms.join(F.broadcast(boost), "field").join(F.broadcast(self.fields), "field")  # a row a field
        idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        said = known.join(words.select("term").distinct(), "term").select("field", "term", (F.col("boost") * idf).alias("weight"), F.pmod(F.xxhash64("term"), F.lit(BUCKETS)).cast("int").alias("bucket"))
        said = stored(said.withColumn("number", F.monotonically_increasing_id()), "said")
        shares = max(1, -(-queries.select("query_id").distinct().count() // ASKED))
        return stored(words.withColumn("share", F.pmod(F.xxhash64("query_id"), F.lit(shares)).cast("int")).join(said, "term"), "asked")

    def _added(self, parts: DataFrame, keys: list[str], best_field: bool) -> DataFrame:
        """keys, s: parts (keys, field, x) summed up by field, then the best field, or all."""
        by_field = parts.groupBy(*keys, "field").agg(F.sum("x").alias("x"))
        return by_field.groupBy(*keys).agg((F.max if best_field else F.sum)("x").alias("s"))

    def search(self, queries: DataFrame, k: int = 20, boosts: dict[str, float] | None = None, where: Column | None = None, best_field: bool = True, first: int = 2, digits: int = 6) -> DataFrame:
        """(query_id, text) -> query_id, doc_id, score (rounded), rank, blocks (opened for the query). ``boosts``: field -> factor; ``where``: a condition on the attributes.

        Each query's ``first`` most promising blocks give its k-th best score; after that only blocks whose bound reaches it are
        opened. Statistics are those of all documents, whatever the condition. Queries without a known term find nothing.
        """
        boosts = boosts or {r["field"]: 1.0 for r in self.fields.collect()}
        asked = self._asked(queries, boosts)
        buckets = [r["bucket"] for r in asked.select("bucket").distinct().collect()]  # BUCKETS at most
        # of the postings only those of terms that are asked for go on, to each share that asks for them
        terms_asked = asked.select("bucket", "field", "term", "number", "share").distinct()
        postings = self.postings.where(F.col("bucket").isin(buckets or [-1])).join(terms_asked, ["bucket", "field", "term"])
        postings, bounds = (rows.where(where) if where is not None else rows for rows in (postings, self.bounds))
        place = [*self.attributes, "block"]
        same = [F.col(f"p.{c}").eqNullSafe(F.col(f"o.{c}")) for c in place]
        bounds = bounds.select("field", "term", *place, "bound").join(asked, ["field", "term"])
        every = self._added(bounds.withColumn("x", F.col("weight") * F.col("bound")), ["query_id", *place], best_field)
        every = every.withColumn("at", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("s"), *place)))
        every = stored(every, "bounds")

        kinds = {c: rows.schema[c].dataType.simpleString() for c, rows in (("query_id", asked), ("doc_id", postings))}
        best = _best(k, list(boosts), best_field, digits)

        def opened(blocks: DataFrame) -> DataFrame:
            """Each query's k best of each of these blocks: a block's postings and a share of the queries meet in one group."""
            wanted = stored(_joined(blocks.select("query_id", *place), asked).select(*place, "share", "query_id", "field", "number", "weight"), "wanted")
            looked_into = wanted.select(*place, "share").distinct().alias("o")
            held = postings.alias("p").join(looked_into, [*same, F.col("p.share") == F.col("o.share")], "left_semi").select(*place, "share", "number", "doc_id", "part")
            both = held.groupBy(*place, "share").cogroup(wanted.groupBy(*place, "share"))
            return both.applyInArrow(best, f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}, score double")

        def ranked(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")).cast("long")).where(F.col("rank") <= k)

        near = stored(ranked(opened(every.where(F.col("at") <= first))), "first")
        worst = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
        least = F.when(F.col("n") >= k, F.col("worst") - SLACK).otherwise(F.lit(-1.0))
        more = _joined(every.where(F.col("at") > first), worst, "left").where(F.col("s") >= F.coalesce(least, F.lit(-1.0)))
        more = stored(more.select("query_id", *place), "more")
        looked = every.where(F.col("at") <= first).select("query_id").unionByName(more.select("query_id")).groupBy("query_id").agg(F.count("*").alias("blocks"))
        return _joined(ranked(near.drop("rank").unionByName(opened(more))), looked).select("query_id", "doc_id", "score", "rank", "blocks")


def by_id(chunks: DataFrame, ids: DataFrame, tier: int | None = None) -> DataFrame:
    """The chunks (doc_id, ...) of the ids asked for (doc_id), each once a row of chunks, with a tier only those that it may see (masking_tier)."""
    rows = chunks.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
    return rows if tier is None else rows.where(F.col("masking_tier") <= tier)
