"""Queries: closures, walks, neighbourhoods, lineage, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import node_id
from ..operators import graph, temporal
from ..operators.components import connected_components
from ..sources import builders
from ..sources.shared import stored
from .registry import GRAPH, query, sql_node_id, table

DAY = "1998-01-01"
TYPES = ("LegalEntity", "Counterparty", "Jurisdiction")
HOLDS = f"valid_from <= DATE '{DAY}' AND (valid_to IS NULL OR valid_to > DATE '{DAY}')"
HOT = GRAPH + f""", warm AS (SELECT node_id FROM nodes WHERE node_type IN {TYPES}),
hot0 AS (SELECT * FROM edges WHERE {HOLDS} AND src <> dst AND src IN (SELECT node_id FROM warm) AND dst IN (SELECT node_id FROM warm)),
crowded AS (SELECT src FROM hot0 GROUP BY src HAVING count(*) > {{cap}}),
hot AS (SELECT * FROM hot0 WHERE src NOT IN (SELECT src FROM crowded))"""
CLOSED = HOT.format(cap=5000) + """, p1 AS (SELECT src, dst, 1 AS hops, max(weight) AS weight, src || '>' || dst AS path FROM hot GROUP BY src, dst),
s AS (SELECT src AS via, dst AS nxt, weight AS w FROM p1),
p2 AS (SELECT src, nxt AS dst, 2 AS hops, weight * w AS weight, path || '>' || nxt AS path FROM p1 JOIN s ON via = dst WHERE strpos(path, nxt) = 0),
p3 AS (SELECT src, nxt AS dst, 3 AS hops, weight * w AS weight, path || '>' || nxt AS path FROM p2 JOIN s ON via = dst WHERE strpos(path, nxt) = 0),
closed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY hops, weight DESC, path) AS rn FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3)) WHERE rn = 1)"""
SEEDS = f", seeds AS (SELECT node_id FROM nodes WHERE canonical_key IN ('S1', 'S2', 'S3', 'S4', 'S5') AND node_type = 'LegalEntity')"


def _hot(spark: SparkSession, sf_dir: str, cap: int = 5000, day: str = DAY) -> tuple[DataFrame, DataFrame]:
    nodes = builders.nodes(spark, sf_dir)
    specs = tuple(s for s in builders.EDGES if s.src[0] in TYPES and s.dst[0] in TYPES)  # no other edge can be hot
    return graph.hot_edges(builders.edges(spark, sf_dir, specs), nodes, TYPES, cap, day), nodes


def _hot_from(spark: SparkSession, sf_dir: str, seeds: DataFrame, hops: int, cap: int = 5000, day: str = DAY) -> tuple[DataFrame, DataFrame]:
    """As _hot(), but of the edges only those that walks of up to ``hops`` from seeds (node_id) can take: sales are picked by who sells before they are joined and grouped."""
    warm = builders.nodes(spark, sf_dir, tuple(s for s in builders.NODES if s.node_type in TYPES))
    specs = tuple(s for s in builders.EDGES if s.src[0] in TYPES and s.dst[0] in TYPES)

    def out_of(ids: DataFrame) -> DataFrame:
        rows = stored(temporal.as_of(builders.edges(spark, sf_dir, specs, out_of=ids), day), "out")
        ends = stored(rows.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct(), "ends")
        return graph.hot_edges(rows, stored(warm.join(ends, "node_id", "left_semi").select("node_id", "node_type"), "near"), TYPES, cap)

    return graph.reached(out_of, seeds, hops), builders.nodes(spark, sf_dir)


def _structure() -> tuple:
    return tuple(s for s in builders.EDGES if s.edge_type in ("LOCATED_IN", "ROLLS_UP_TO"))


def _seeds(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("canonical_key").isin("S1", "S2", "S3", "S4", "S5") & (F.col("node_type") == "LegalEntity")).select("node_id")


@query(GRAPH + "SELECT src, count(*) AS degree FROM edges GROUP BY src")
def degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.degrees(builders.edges(spark, sf_dir))


@query(HOT.format(cap=140) + " SELECT edge_id, src, dst, edge_type, weight FROM hot")
def hot_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hot(spark, sf_dir, 140)[0].select("edge_id", "src", "dst", "edge_type", "weight")


@query(CLOSED + " SELECT src, dst, hops, weight, path FROM closed")
def closure_3hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.closure(_hot(spark, sf_dir)[0], 3).withColumn("path", F.array_join("path", ">"))


@query(
    CLOSED + SEEDS + """, hidden AS (SELECT node_id FROM nodes WHERE masking_tier > 0)
SELECT src, dst, hops, weight, path FROM closed WHERE hops <= 2 AND src IN (SELECT node_id FROM seeds) AND NOT EXISTS (SELECT 1 FROM hidden WHERE strpos(path, node_id) > 0) ORDER BY hops, weight DESC, src, dst LIMIT 200"""
)
def expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = _seeds(builders.nodes(spark, sf_dir))
    edges, nodes = _hot_from(spark, sf_dir, seeds, 2)
    out = graph.expand(graph.closure(edges, 2, seeds), seeds, nodes, 2, 0, 200)
    return out.select("src", "dst", "hops", "weight", F.array_join("path", ">").alias("path"))


WALK = HOT.format(cap=5000) + SEEDS + """, walk AS (SELECT node_id AS seed, node_id AS node, 0 AS hops, 0.0::DOUBLE AS total_weight, node_id AS path FROM seeds
  UNION ALL SELECT seed, dst, hops + 1, total_weight + weight, path || '>' || dst FROM walk JOIN hot ON src = node WHERE hops < 4 AND strpos(path, dst) = 0)"""


@query(WALK + " SELECT seed, node, hops, total_weight, path FROM walk WHERE hops > 0 ORDER BY hops, total_weight DESC, path LIMIT 500")
def traverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = _seeds(builders.nodes(spark, sf_dir))
    edges, nodes = _hot_from(spark, sf_dir, seeds, 4)
    return graph.traverse(edges, seeds, nodes, 4, 2, None, 500).withColumn("path", F.array_join("path", ">"))


@query(
    HOT.format(cap=5000) + f""", walk AS (SELECT {sql_node_id('LegalEntity', "'S1'")} AS node, 0 AS hops, {sql_node_id('LegalEntity', "'S1'")} AS path
  UNION ALL SELECT dst, hops + 1, path || '>' || dst FROM walk JOIN (SELECT DISTINCT src, dst FROM hot) ON src = node WHERE hops < 3 AND strpos(path, dst) = 0)
SELECT hops, path FROM walk WHERE node = {sql_node_id('Jurisdiction', "'R1'")} ORDER BY hops, path LIMIT 1"""
)
def shortest_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = spark.range(1).select(node_id(F.lit("LegalEntity"), F.lit("S1")), node_id(F.lit("Jurisdiction"), F.lit("R1"))).first()
    edges, nodes = _hot_from(spark, sf_dir, spark.range(1).select(F.lit(ends[0]).alias("node_id")), 3)
    return graph.shortest_path(edges, ends[0], ends[1], nodes, 3)


AROUND = GRAPH + """, pairs AS (SELECT src, dst FROM edges WHERE edge_type IN ('LOCATED_IN', 'ROLLS_UP_TO') UNION SELECT dst, src FROM edges WHERE edge_type IN ('LOCATED_IN', 'ROLLS_UP_TO')),
reach AS (SELECT {start} AS node_id, 0 AS level UNION SELECT dst, level + 1 FROM reach JOIN pairs ON src = node_id WHERE level < {hops})"""


def _around(spark: SparkSession, sf_dir: str, key: str, hops: int) -> DataFrame:
    edges = builders.edges(spark, sf_dir, _structure())
    return graph.levels(edges, spark.range(1).select(node_id(F.lit("Jurisdiction"), F.lit(key)).alias("node_id")), hops)


@query(AROUND.format(start=sql_node_id("Jurisdiction", "'N0'"), hops=2) + " SELECT node_id, min(level) AS level FROM reach GROUP BY node_id")
def bfs_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _around(spark, sf_dir, "N0", 2)


@query(AROUND.format(start=sql_node_id("Jurisdiction", "'R0'"), hops=3) + ", least AS (SELECT node_id, min(level) AS level FROM reach GROUP BY node_id) SELECT level, node_type, count(*) AS n FROM least JOIN nodes USING (node_id) GROUP BY 1, 2")
def dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = _around(spark, sf_dir, "R0", 3)
    return near.join(builders.nodes(spark, sf_dir).select("node_id", "node_type"), "node_id").groupBy("level", "node_type").agg(F.count("*").alias("n"))


@query(GRAPH + SEEDS + " SELECT edge_id, src, dst, edge_type FROM edges WHERE src IN (SELECT node_id FROM seeds) OR dst IN (SELECT node_id FROM seeds)")
def neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.neighbours(builders.edges(spark, sf_dir), _seeds(builders.nodes(spark, sf_dir))).select("edge_id", "src", "dst", "edge_type")


@query(GRAPH + f", low AS (SELECT node_id FROM nodes WHERE masking_tier <= 1) SELECT edge_id, src, dst, edge_type FROM edges WHERE {HOLDS} AND src IN (SELECT node_id FROM low) AND dst IN (SELECT node_id FROM low)")
def induced_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = temporal.visible(builders.nodes(spark, sf_dir), 1).select("node_id")
    return graph.induced(temporal.as_of(builders.edges(spark, sf_dir), DAY), low).select("edge_id", "src", "dst", "edge_type")


@query(
    """SELECT 'DERIVED_FROM' AS edge_type, regexp_extract(url, '://([^/?#]*)', 1) AS dst, regexp_extract(url, '://[^/?#]*/([^/?#]*)', 1) AS job, count(*) AS n, max(page_id) AS last_seen
FROM pages WHERE url LIKE '%://%' GROUP BY ALL"""
)
def lineage_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").where(F.col("url").contains("://"))
    rows = pages.select(F.lit("DERIVED_FROM").alias("edge_type"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("dst"), F.regexp_extract("url", "://[^/?#]*/([^/?#]*)", 1).alias("job"), "page_id")
    return rows.groupBy("edge_type", "dst", "job").agg(F.count("*").alias("n"), F.max("page_id").alias("last_seen"))


TURNS = """WITH RECURSIVE chain AS (SELECT conv_id || ':' || lpad(CAST(turn AS VARCHAR), 4, '0') AS node, lag(conv_id || ':' || lpad(CAST(turn AS VARCHAR), 4, '0')) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations),
edges AS (SELECT node AS src, before AS dst FROM chain WHERE before IS NOT NULL)"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws(":", "conv_id", F.lpad(F.col("turn").cast("string"), 4, "0")).alias("src"))
    return turns.withColumn("dst", F.lag("src").over(W.partitionBy("conv_id").orderBy("turn"))).where("dst IS NOT NULL").select("src", "dst", F.lit(1.0).alias("weight"), F.lit("DERIVED_FROM").alias("edge_type"))


@query(
    TURNS + """, walk AS (SELECT src AS seed, src AS node, 0 AS hops, src AS path FROM edges WHERE src LIKE '%:0003'
  UNION ALL SELECT seed, dst, hops + 1, path || '>' || dst FROM walk JOIN edges ON src = node WHERE hops < 6)
SELECT path, hops, round(1.0::DOUBLE / (1 + hops), 6) AS score FROM walk WHERE hops > 0 ORDER BY hops, path LIMIT 40"""
)
def lineage_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _turns(spark, sf_dir)
    ids = edges.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct().withColumn("masking_tier", F.lit(0))
    walks = graph.traverse(edges, edges.where("src LIKE '%:0003'").select(F.col("src").alias("node_id")), ids, 6, 3, ["DERIVED_FROM"], 40)
    return walks.select(F.array_join("path", ">").alias("path"), "hops", F.round(1.0 / (1 + F.col("hops")), 6).alias("score")).orderBy("hops", "path").limit(40)


@query(
    """WITH f AS (SELECT user_id, CAST(ts AS DATE) AS as_of, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2)
SELECT user_id, max(as_of)::VARCHAR AS as_of, arg_max(n, as_of) AS n, arg_max(cents, as_of) AS cents FROM f WHERE as_of <= DATE '2024-01-15' GROUP BY user_id"""
)
def features_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("as_of")).agg(F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    rows = daily.where("as_of <= DATE'2024-01-15'").groupBy("user_id").agg(F.max("as_of").cast("string").alias("as_of"), F.max_by("n", "as_of").alias("n"), F.max_by("cents", "as_of").alias("cents"))
    return rows


@query(TURNS + " SELECT conv_id || ':' || lpad(CAST(turn AS VARCHAR), 4, '0') AS node, min(conv_id || ':' || lpad(CAST(turn AS VARCHAR), 4, '0')) OVER (PARTITION BY conv_id) AS root FROM conversations QUALIFY count(*) OVER (PARTITION BY conv_id) > 1")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(_turns(spark, sf_dir))


def _rank_sql(rounds: int) -> str:
    sql = GRAPH + """, g AS (SELECT src, dst, weight FROM edges WHERE edge_type IN ('ROLLS_UP_TO') OR (edge_type = 'LOCATED_IN')),
pairs AS (SELECT src, dst, sum(weight) AS weight FROM (SELECT src, dst, weight FROM g UNION ALL SELECT dst, src, weight FROM g) GROUP BY src, dst),
share AS MATERIALIZED (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS share FROM pairs),
r0 AS (SELECT src AS node_id, 1.0::DOUBLE / count(*) OVER () AS rank FROM (SELECT DISTINCT src FROM share))"""
    for i in range(rounds):
        sql += f", r{i + 1} AS MATERIALIZED (SELECT dst AS node_id, 0.15::DOUBLE / (SELECT count(*) FROM r0) + 0.85::DOUBLE * sum(rank * share) AS rank FROM r{i} JOIN share ON src = node_id GROUP BY dst)"
    return sql + f" SELECT node_id, round(rank, 9) AS rank FROM r{rounds}"


@query(_rank_sql(20))
def pagerank_20it(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = builders.edges(spark, sf_dir, _structure())
    return graph.pagerank(edges, 20).select("node_id", F.round("rank", 9).alias("rank"))
