"""Queries: the stored text index, its fields and filters, and its fusion with vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import retrieval, textindex
from ..sources import sinks
from .evidence import ASKED, BM25, KNN, TERMS, _asked, _vectors
from .registry import query, table


def _index(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = ("text",), attributes: tuple[str, ...] = ()) -> textindex.TextIndex:
    return textindex.TextIndex.build(table(spark, sf_dir, "documents"), sinks.new_path(spark, "texts"), fields, attributes)


#: What keeps the SQL of a search to the questions whose ids are divisible by ASKED.
_PART = f" WHERE item_id % {ASKED} = 0"


def _whole(sql: str) -> str:
    """The SQL of a search by every question."""
    assert sql.count(_PART) == 1
    return sql.replace(_PART, "")


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question, whatever its id."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query(f"WITH {BM25} SELECT query_id, doc_id, score, rank FROM lex")
def bm25_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As bm25, out of the stored index: blocks that can't reach a question's twentieth score stay closed."""
    return _index(spark, sf_dir).search(_asked(spark, sf_dir), 20).drop("blocks")


#: Two fields, each with its own lengths and counts; the text counts double; a document has its better field's score.
FIELDS = f"""cut AS MATERIALIZED (SELECT doc_id, lang, field, ts FROM (SELECT doc_id, lang, 'text' AS field, coalesce({TERMS}, []) AS ts FROM documents UNION ALL SELECT doc_id, lang, 'source', coalesce({TERMS.replace("text", "source")}, []) FROM documents)),
stat AS (SELECT field, count(*) AS n, sum(len(ts))::DOUBLE / count(*) AS mean FROM cut GROUP BY field),
q AS (SELECT DISTINCT item_id AS query_id, unnest({TERMS.replace("text", "said")}) AS term FROM (SELECT item_id, text || ' src' || (item_id % 7) AS said FROM benchmark WHERE item_id % {ASKED} = 0)),
tf AS (SELECT doc_id, lang, field, len(ts) AS length, unnest(ts) AS term FROM cut), hits AS (SELECT doc_id, lang, field, length, term, count(*) AS tf FROM tf WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT field, term, count(*) AS df FROM hits GROUP BY ALL),
parts AS (SELECT query_id, doc_id, lang, field, sum(CASE field WHEN 'text' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))) AS s
  FROM hits JOIN df USING (field, term) JOIN q USING (term) JOIN stat USING (field) GROUP BY 1, 2, 3, 4),
best AS (SELECT query_id, doc_id, lang, round(max(s), 6) AS score FROM parts GROUP BY 1, 2, 3)"""
BOOSTS = {"text": 2.0, "source": 1.0}


def _named(asked: DataFrame) -> DataFrame:
    """Questions that also name a source."""
    return asked.withColumn("text", F.concat("text", F.lit(" src"), (F.col("query_id") % 7).cast("string")))


@query(f"WITH {_whole(FIELDS)} SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM best WHERE lang = 'en') WHERE rank <= 8")
def search_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question, two fields, one language only: blocks of other languages aren't read."""
    return _index(spark, sf_dir, ("text", "source"), ("lang",)).search(_named(_questions(spark, sf_dir)), 8, BOOSTS, F.col("lang") == "en").drop("blocks")


@query(
    f"""WITH {FIELDS}, near AS ({KNN.format(where='')}), a AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM best),
u AS (SELECT query_id, doc_id, rank FROM a WHERE rank <= 60 UNION ALL SELECT query_id, vec_id, rank FROM near WHERE query_id IN (SELECT query_id FROM q)),
s AS (SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (20 + rank)), 9) AS score FROM u GROUP BY 1, 2)
SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 12"""
)
def hybrid_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All questions: the better of two fields and the vectors' order, fused by 1 / (20 + rank)."""
    asked, v = _named(_asked(spark, sf_dir)), _vectors(spark, sf_dir)
    lex = _index(spark, sf_dir, ("text", "source")).search(asked, 60, BOOSTS)
    vectors = v.where(F.col("vec_id") % ASKED == 0).join(asked.select(F.col("query_id").alias("vec_id")), "vec_id", "left_semi")
    near = retrieval.knn(v, vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), 10).withColumnRenamed("vec_id", "doc_id")
    fused = retrieval.rrf([lex, near], 20).withColumn("score", F.round("score", 9))
    return retrieval.top(fused, "score", 12)


@query(f"WITH {_whole(BM25)} SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM lex WHERE rank <= 3)")
def chunks_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of all questions' three best hits."""
    hits = _index(spark, sf_dir).search(_questions(spark, sf_dir), 3)
    return textindex.by_id(table(spark, sf_dir, "documents"), hits).select("doc_id", "source", "n_chars")
