"""Nodes and edges from structured tables, declared as specifications.

Each builder names the columns it makes, so that all are combined by name. Sources that are missing are left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import edge_id, hashed_id, plain_id, series_id
from .shared import stored

#: The date from which structural facts hold.
EPOCH = "1992-01-01"


@dataclass(frozen=True)
class NodeSpec:
    source: str
    node_type: str
    key: str
    name: str
    tier: int = 0
    properties: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class EdgeSpec:
    """Grouped, rows with the same ends are one edge; ``by`` names the columns that the ends are made of, src before dst and one to one, so that these are grouped and not texts."""

    source: str
    edge_type: str
    src: tuple[str, str]
    dst: tuple[str, str]
    weight: str = "1.0D"
    valid_from: str = f"DATE'{EPOCH}'"
    valid_to: str = "CAST(NULL AS DATE)"
    grouped: bool = False
    by: tuple[str, ...] = ()


NODES = (
    NodeSpec("region", "Jurisdiction", "concat('R', r_regionkey)", "r_name"),
    NodeSpec("nation", "Jurisdiction", "concat('N', n_nationkey)", "n_name", 0, {"region": "concat('R', n_regionkey)"}),
    NodeSpec("customer", "Counterparty", "concat('C', c_custkey)", "c_name", 2, {"segment": "c_mktsegment", "country": "concat('N', c_nationkey)"}),
    NodeSpec("supplier", "LegalEntity", "concat('S', s_suppkey)", "s_name", 0, {"country": "concat('N', s_nationkey)"}),
    NodeSpec("part", "Product", "concat('P', p_partkey)", "p_name", 1, {"brand": "p_brand"}),
)
EDGES = (
    EdgeSpec("customer", "LOCATED_IN", ("Counterparty", "concat('C', c_custkey)"), ("Jurisdiction", "concat('N', c_nationkey)")),
    EdgeSpec("supplier", "LOCATED_IN", ("LegalEntity", "concat('S', s_suppkey)"), ("Jurisdiction", "concat('N', s_nationkey)")),
    EdgeSpec("nation", "ROLLS_UP_TO", ("Jurisdiction", "concat('N', n_nationkey)"), ("Jurisdiction", "concat('R', n_regionkey)")),
    EdgeSpec(
        "sales", "EXPOSED_TO", ("LegalEntity", "concat('S', l_suppkey)"), ("Counterparty", "concat('C', o_custkey)"),
        "sum(amount) / 10000.0D", "min(day)", "date_add(max(day), 1)", True, ("l_suppkey", "o_custkey"),
    ),
    EdgeSpec(
        "sales", "FUNDS", ("Product", "concat('P', l_partkey)"), ("LegalEntity", "concat('S', l_suppkey)"),
        "sum(units) / 1.0D", "min(day)", "date_add(max(day), 1)", True, ("l_partkey", "l_suppkey"),
    ),
)


def _source(spark: SparkSession, sf_dir: str, name: str, only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``only`` picks rows; of sales it picks lines, before the join."""
    if name == "sales":
        # whole numbers and days, made before the join: they are what is shuffled
        amount, units, day = F.expr("CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS BIGINT)"), F.col("l_quantity").cast("bigint"), F.col("l_shipdate").cast("date")
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey", amount.alias("amount"), units.alias("units"), day.alias("day"))
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
        # picked lines may be few: their written size says whether they are sent to the orders
        return stored(only(lines), "lines").join(orders, F.col("l_orderkey") == F.col("o_orderkey")) if only else lines.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return only(rows) if only else rows


def _out_of(s: EdgeSpec, ids: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Rows whose src is among ids (node_id). Of grouped rows each key is hashed once, not once a row, and the keys found are written, so that few are sent to the rows."""
    src = hashed_id(plain_id(F.lit(s.src[0]), F.expr(s.src[1])))

    def only(rows: DataFrame) -> DataFrame:
        if not s.by:
            return rows.join(ids, src == F.col("node_id"), "left_semi")
        key = s.by[0]
        keys = stored(rows.select(key).distinct(), "keys")  # written, or the hashing would be moved below the grouping
        return rows.join(stored(keys.join(ids, src == F.col("node_id"), "left_semi"), "keys"), key, "left_semi")

    return only


def _fold(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def structured(build: Callable[[NodeSpec | EdgeSpec], DataFrame], specs: tuple, available: set[str] | None = None) -> DataFrame:
    """All specifications whose source is available, combined by name."""
    return _fold([build(s) for s in specs if available is None or s.source in available])


def nodes(spark: SparkSession, sf_dir: str, specs: tuple[NodeSpec, ...] = NODES, available: set[str] | None = None, plain: bool = False) -> DataFrame:
    """node_id, node_type, name, canonical_key, properties, masking_tier, source_system, confidence. ``plain``: the node_id is what it is otherwise the hash of."""

    def build(s: NodeSpec) -> DataFrame:
        properties = [x for k, v in s.properties.items() for x in (F.lit(k), F.expr(v))]
        made: Column = F.create_map(*properties) if properties else F.create_map()
        own = plain_id(F.lit(s.node_type), F.expr(s.key))
        return _source(spark, sf_dir, s.source).select(
            (own if plain else hashed_id(own)).alias("node_id"), F.lit(s.node_type).alias("node_type"), F.expr(s.name).alias("name"), F.expr(s.key).alias("canonical_key"),
            made.cast("map<string,string>").alias("properties"), F.lit(s.tier).alias("masking_tier"), F.lit(s.source).alias("source_system"), F.lit(1.0).alias("confidence"),
        )

    return structured(build, specs, available)


def edges(spark: SparkSession, sf_dir: str, specs: tuple[EdgeSpec, ...] = EDGES, available: set[str] | None = None, plain: bool = False, out_of: DataFrame | None = None) -> DataFrame:
    """edge_id, series_id, src, dst, edge_type, weight, valid_from, valid_to, confidence. Ends are hashed after grouping. ``plain``: ends stay as they are before, edges have no ids yet; with_ids() hashes them. ``out_of`` (node_id): only edges out of these nodes."""

    def build(s: EdgeSpec) -> DataFrame:
        rows = _source(spark, sf_dir, s.source, _out_of(s, out_of) if out_of is not None else None)
        ends = {"a": F.expr(s.src[1]), "b": F.expr(s.dst[1])}
        facts = [F.expr(s.weight).cast("double").alias("weight"), F.expr(s.valid_from).alias("valid_from"), F.expr(s.valid_to).alias("valid_to")]
        if s.by:
            rows = rows.groupBy(*s.by).agg(*facts).select(*[v.alias(k) for k, v in ends.items()], "weight", "valid_from", "valid_to")
        else:
            rows = rows.groupBy(*[v.alias(k) for k, v in ends.items()]).agg(*facts) if s.grouped else rows.select(*[v.alias(k) for k, v in ends.items()], *facts)
        rows = rows.select(plain_id(F.lit(s.src[0]), F.col("a")).alias("src"), plain_id(F.lit(s.dst[0]), F.col("b")).alias("dst"), F.lit(s.edge_type).alias("edge_type"), "weight", "valid_from", "valid_to", F.lit(1.0).alias("confidence"))
        return rows if plain else with_ids(rows)

    return structured(build, specs, available)


def with_ids(rows: DataFrame) -> DataFrame:
    """Plain edges with their ids and those of their ends."""
    rows = rows.withColumns({"src": hashed_id(F.col("src")), "dst": hashed_id(F.col("dst"))})
    ids = edge_id(F.col("src"), F.col("edge_type"), F.col("dst"), F.col("valid_from")).alias("edge_id"), series_id(F.col("src"), F.col("edge_type"), F.col("dst")).alias("series_id")
    return rows.select(*ids, *rows.columns)
