"""Queries: quality gates, communities and spectral measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import communities, gates, louvain, retrieval, temporal
from ..operators.components import connected_components
from ..operators.joins import heavy_keys, spread_join
from ..sources import builders, sinks
from ..sources.shared import stored
from .core import PROPOSED_SQL, _hashed_ends, _proposed, _versions
from .evidence import KNN, _vectors
from .registry import GRAPH, VERSIONS, query, table
from .walks import DAY, HOLDS


@query(GRAPH + PROPOSED_SQL + " SELECT edge_type, src, dst FROM typed WHERE src_type IS NULL OR dst_type IS NULL")
def gate_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed_ends(gates.dangling(_proposed(spark, sf_dir), builders.nodes(spark, sf_dir, plain=True))).select("edge_type", "src", "dst")


@query("SELECT user_id || ':' || event_type AS key, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1")
def gate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.duplicates(table(spark, sf_dir, "events").select(F.concat_ws(":", "user_id", "event_type").alias("key")), "key")


#: Versions of which every fifth is left open three days too long.
STRETCHED = VERSIONS + ", long AS (SELECT key, valid_from, CASE WHEN event_id % 5 = 0 THEN valid_to + 3 ELSE valid_to END AS valid_to FROM versions), seen AS (SELECT *, lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from, valid_to) AS next_from FROM long)"


def _stretched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir).withColumn("valid_to", F.when(F.col("event_id") % 5 == 0, F.date_add("valid_to", 3)).otherwise(F.col("valid_to"))).select("key", "valid_from", "valid_to")


@query(STRETCHED + " SELECT key, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, CAST(next_from AS VARCHAR) AS next_from FROM seen WHERE next_from IS NOT NULL AND (valid_to IS NULL OR valid_to > next_from)")
def temporal_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.overlaps(_stretched(spark, sf_dir)).select("key", *[F.col(c).cast("string").alias(c) for c in ("valid_from", "valid_to", "next_from")])


@query(
    STRETCHED.replace("WITH RECURSIVE ", GRAPH + PROPOSED_SQL + ", ", 1) + """, g AS (
  SELECT 'dangling' AS gate, (SELECT count(*) FROM typed WHERE src_type IS NULL OR dst_type IS NULL)::DOUBLE AS value, 0.0::DOUBLE AS limit_
  UNION ALL SELECT 'duplicate nodes', (SELECT count(*) FROM (SELECT node_id FROM nodes GROUP BY node_id HAVING count(*) > 1))::DOUBLE, 0.0::DOUBLE
  UNION ALL SELECT 'overlapping versions', (SELECT count(*) FROM seen WHERE next_from IS NOT NULL AND (valid_to IS NULL OR valid_to > next_from))::DOUBLE, 1000.0::DOUBLE)
SELECT gate, value, limit_ AS "limit", value <= limit_ AS passed FROM g"""
)
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = builders.nodes(spark, sf_dir, plain=True)
    return gates.report([
        gates.gate("dangling", gates.dangling(_proposed(spark, sf_dir), nodes), 0), gates.gate("duplicate nodes", gates.duplicates(nodes, "node_id"), 0),
        gates.gate("overlapping versions", gates.overlaps(_stretched(spark, sf_dir)), 1000),
    ])


@query(
    f"""WITH found AS ({KNN.format(where=' AND v.vec_id <> q.vec_id')}), truth AS (SELECT q.vec_id AS query_id, e.vec_id AS id FROM embeddings q JOIN embeddings e ON q.label = e.label AND q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0),
t AS (SELECT query_id, count(*) AS total FROM truth GROUP BY 1), h AS (SELECT f.query_id, count(*) AS hits, 1.0::DOUBLE / min(rank) AS rr FROM found f JOIN truth ON truth.query_id = f.query_id AND id = vec_id GROUP BY 1)
SELECT query_id, coalesce(hits, 0) / total::DOUBLE AS recall, coalesce(hits, 0) / 10.0::DOUBLE AS "precision", coalesce(rr, 0) AS rr FROM t LEFT JOIN h USING (query_id)"""
)
def recall_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    q = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql"))
    queries = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    near = retrieval.knn(v, queries, 10, own=False)
    found = near.join(v.select("vec_id", "label"), "vec_id").join(q, "query_id").where("label = ql").select("query_id", "rank")
    # a query's true rows are all others of its label: they are counted, not made
    sizes = v.groupBy(F.col("label").alias("ql")).agg((F.count("*") - 1).alias("total")).where("total > 0")
    return gates.recall_of(q.join(F.broadcast(sizes), "ql").select("query_id", "total"), found, 10)


def _exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All edges on which risk travels, as of a day."""
    return temporal.as_of(builders.edges(spark, sf_dir), DAY).where(F.col("edge_type").isin("EXPOSED_TO", "FUNDS", "PARENT_OF"))


@query()
def community_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return louvain.community_labels(_exposures(spark, sf_dir))


@query(
    GRAPH + f""", g AS (SELECT src, dst FROM edges WHERE {HOLDS} AND edge_type IN ('EXPOSED_TO', 'FUNDS', 'PARENT_OF') AND src <> dst), ends AS (SELECT src AS node FROM g UNION SELECT dst FROM g)
SELECT "check", value FROM (VALUES ('nodes with one community a level', (SELECT count(*) FROM ends)), ('nodes with several', 0), ('edges of one community between components', 0), ('members counted wrongly', 0), ('members of small communities', 0), ('runs', 2)) t("check", value)"""
)
def community_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' memberships lie beside each other, one of them stored twice; what must hold of them in any case."""
    edges, path = stored(_exposures(spark, sf_dir).select("src", "dst", "weight"), "exposures"), sinks.new_path(spark, "memberships")
    labels = stored(louvain.community_labels(edges, 1, "run-0001"), "labels")
    for run_id, least in (("run-0000", 3), ("run-0001", 1), ("run-0000", 3)):
        louvain.keep_run(labels, path, run_id, least)
    runs = spark.read.parquet(path)
    last, roots = runs.where("run_id = 'run-0001'"), connected_components(edges).select(F.col("node").alias("node_id"), "root")
    levels = last.groupBy("node_id", "level").agg(F.count("*").alias("n"))
    mixed = last.join(roots, "node_id").groupBy("community_id").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b")
    wrong = last.groupBy("community_id", "member_count").agg(F.count("*").alias("n")).where("n != member_count")
    counts = (
        ("nodes with one community a level", levels.where("n = 1")), ("nodes with several", levels.where("n > 1")), ("edges of one community between components", mixed), ("members counted wrongly", wrong),
        ("members of small communities", runs.where("run_id = 'run-0000' AND member_count < 3")), ("runs", runs.select("run_id").distinct()),
    )
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("value")).select(F.lit(name).alias("check"), "value") for name, df in counts])


@query(
    """WITH g AS (SELECT label, count(*) AS members, max(CAST(vec_id % 4 AS INTEGER)) AS tier FROM embeddings GROUP BY label HAVING count(*) >= 3)
SELECT 'L0_' || label AS community_id, members, tier, vec_id AS member_id FROM embeddings JOIN g USING (label)"""
)
def community_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each community's size and strictest tier beside each of its members; members stay rows, however many there are."""
    v = _vectors(spark, sf_dir).select("label", "vec_id", "tier")
    sizes = v.groupBy("label").agg(F.count("*").alias("members"), F.max("tier").alias("tier")).where("members >= 3")
    rows = spread_join(v.drop("tier"), sizes, "label", heavy_keys(v, "label"))
    return rows.select(F.concat(F.lit("L0_"), "label").alias("community_id"), "members", "tier", F.col("vec_id").alias("member_id"))


@query()
def fiedler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return communities.spectral_features(_exposures(spark, sf_dir), measures=("fiedler",))


@query()
def magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return communities.spectral_features(_exposures(spark, sf_dir), measures=("magnitude",))


@query()
def betweenness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return communities.spectral_features(_exposures(spark, sf_dir), measures=("betweenness",))
