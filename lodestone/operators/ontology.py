"""Rules on which edges may join which nodes, applied to every edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Edge type, allowed sources, allowed targets, weighted, may come from extraction.
RULES = (
    ("LOCATED_IN", ("Counterparty", "LegalEntity"), ("Jurisdiction",), False, True),
    ("ROLLS_UP_TO", ("Jurisdiction", "GLAccount", "Metric"), ("Jurisdiction", "GLAccount", "Metric"), True, False),
    ("EXPOSED_TO", ("LegalEntity",), ("Counterparty",), True, False),
    ("FUNDS", ("Product", "LegalEntity"), ("LegalEntity",), True, True),
    ("OWNS", ("LegalEntity", "Person"), ("LegalEntity",), True, False),
    ("MENTIONS", ("Document",), ("Jurisdiction", "Counterparty", "LegalEntity", "Product", "Person"), False, False),
    ("DERIVED_FROM", ("DataAsset",), ("DataAsset",), False, False),
)
#: Edges that hold the graph's books; they are left out of closures and communities.
STRUCTURAL = ("MENTIONS", "SAME_AS", "BELONGS_TO_COMMUNITY")


def rules(spark: SparkSession) -> DataFrame:
    """edge_type, src_type, dst_type, weighted, from_llm: a fixed list, and so safe to broadcast."""
    rows = [(e, s, d, w, m) for e, ss, ds, w, m in RULES for s in ss for d in ds]
    return spark.createDataFrame(rows, "edge_type string, src_type string, dst_type string, weighted boolean, from_llm boolean")


def typed(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with src_type and dst_type; null where a node is missing."""
    types = nodes.select("node_id", "node_type").hint("shuffle_hash")  # no sort of all edges
    with_src = edges.join(types.select(F.col("node_id").alias("src"), F.col("node_type").alias("src_type")), "src", "left")
    return with_src.join(types.select(F.col("node_id").alias("dst"), F.col("node_type").alias("dst_type")), "dst", "left")


def validate(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    allowed = rules(edges.sparkSession).select("edge_type", "src_type", "dst_type")
    return typed(edges, nodes).join(F.broadcast(allowed), ["edge_type", "src_type", "dst_type"], "left_semi")


def rejects(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges that no rule allows, with the reason."""
    spark = edges.sparkSession
    allowed = rules(spark).select("edge_type", "src_type", "dst_type")
    bad = typed(edges, nodes).join(F.broadcast(allowed), ["edge_type", "src_type", "dst_type"], "left_anti")
    known = sorted({r[0] for r in RULES})
    return bad.withColumn("reason", F.when(F.col("src_type").isNull() | F.col("dst_type").isNull(), "missing node").when(~F.col("edge_type").isin(known), "unknown edge").otherwise("forbidden"))
