"""Queries: entity resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import node_id
from ..functions.text import LEGAL_WORDS, blocking_key, normalise_name
from ..operators import resolve
from ..sources import builders
from .registry import query, sql_node_id, table

ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"
#: Three feeds of customers: as they are; some again with a legal suffix and a key of their own; some with their key in small letters.
FEEDS = f"""WITH RECURSIVE feeds AS (
  SELECT {sql_node_id('Counterparty', "'C' || c_custkey")} AS node_id, c_name AS name, 'C' || c_custkey AS canonical_key, 'N' || c_nationkey AS country, 3 AS n_sources, 1.0::DOUBLE AS confidence FROM customer
  UNION ALL SELECT {sql_node_id('Counterparty', "'D' || c_custkey")}, upper(c_name) || ' Ltd.', 'D' || c_custkey, 'N' || c_nationkey, 1, 0.9::DOUBLE FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'x_' || c_custkey, 'The ' || c_name || ', Inc', ' c' || c_custkey || ' ', 'n' || c_nationkey, 2, 0.8::DOUBLE FROM customer WHERE c_custkey % 5 = 0),
plain AS (SELECT *, translate(lower(name), '{ACCENTED}', '{PLAIN}') AS low FROM feeds),
named AS (SELECT * EXCLUDE (low), trim(regexp_replace(regexp_replace(regexp_replace(low, '[^a-z0-9]+', ' ', 'g'), '\\b({'|'.join(LEGAL_WORDS)})\\b', ' ', 'g'), ' +', ' ', 'g')) AS norm_name FROM plain),
keyed AS (SELECT *, 'Counterparty|' || upper(country) || '|' || substr(split_part(norm_name, ' ', 1), 1, 4) AS block, upper(trim(canonical_key)) AS clean_key FROM named),
exact AS (SELECT min(node_id) OVER (PARTITION BY clean_key) AS a, node_id AS b, 'exact' AS method, 1.0::DOUBLE AS score FROM keyed),
rule AS (SELECT min(node_id) OVER (PARTITION BY block, norm_name) AS a, node_id AS b, 'rule' AS method, 0.95::DOUBLE AS score FROM keyed WHERE length(norm_name) >= 4),
matches AS (SELECT * FROM exact WHERE a <> b UNION ALL SELECT * FROM rule WHERE a <> b)"""
CLUSTERS = FEEDS + """, links AS (SELECT a, b FROM matches UNION SELECT b, a FROM matches),
reach AS (SELECT a AS node_id, a AS other FROM links UNION SELECT node_id, b FROM reach JOIN links ON a = other),
roots AS (SELECT node_id, min(other) AS root FROM reach GROUP BY node_id),
members AS (SELECT r.*, f.name, f.n_sources, f.confidence FROM roots r JOIN feeds f USING (node_id)),
ranked AS (SELECT *, first_value(node_id) OVER (PARTITION BY root ORDER BY n_sources DESC, confidence DESC, length(name), node_id) AS canonical_id FROM members),
ends AS (SELECT a AS node_id, method, score FROM matches UNION ALL SELECT b, method, score FROM matches),
best AS (SELECT node_id, method, score FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY score DESC, method DESC) AS rn FROM ends) WHERE rn = 1),
same_as AS (SELECT node_id, canonical_id, method, score FROM ranked JOIN best USING (node_id) WHERE node_id <> canonical_id)"""


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    country = F.concat(F.lit("N"), "c_nationkey")
    typed = F.lit("Counterparty")

    def feed(rows: DataFrame, node, name, key, country, sources: int, confidence: float) -> DataFrame:
        return rows.select(node.alias("node_id"), typed.alias("node_type"), name.alias("name"), key.alias("canonical_key"), country.alias("country"), F.lit(sources).alias("n_sources"), F.lit(confidence).alias("confidence"))

    key = lambda letter: F.concat(F.lit(letter), "c_custkey")
    one = feed(c, node_id(typed, key("C")), F.col("c_name"), key("C"), country, 3, 1.0)
    two = feed(c.where("c_custkey % 3 = 0"), node_id(typed, key("D")), F.concat(F.upper("c_name"), F.lit(" Ltd.")), key("D"), country, 1, 0.9)
    three = feed(c.where("c_custkey % 5 = 0"), key("x_"), F.concat(F.lit("The "), "c_name", F.lit(", Inc")), F.concat(F.lit(" c"), "c_custkey", F.lit(" ")), F.concat(F.lit("n"), "c_nationkey"), 2, 0.8)
    return one.unionByName(two).unionByName(three)


@query(FEEDS + " SELECT node_id, name, norm_name FROM named")
def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feeds(spark, sf_dir).select("node_id", "name", normalise_name(F.col("name")).alias("norm_name"))


@query(FEEDS + " SELECT node_id, norm_name, 'Counterparty|' || upper(CASE WHEN n_sources = 3 THEN 'eu' ELSE country END) || '|' || substr(split_part(norm_name, ' ', 1), 1, 4) AS block FROM keyed")
def accented_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names written with accents, wide letters and ligatures are the plain ones; where no country is known, the jurisdiction blocks."""
    rows = _feeds(spark, sf_dir).withColumn("name", F.regexp_replace(F.translate("name", "ueomsI", "üéöｍśＩ"), "ﬀ", "ff"))
    country = F.when(F.col("n_sources") != 3, F.col("country"))
    return rows.select("node_id", normalise_name(F.col("name")).alias("norm_name"), blocking_key(F.col("node_type"), country, F.col("name"), F.lit("eu")).alias("block"))


@query(FEEDS + " SELECT block, count(*) AS n FROM keyed GROUP BY block")
def blocking_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feeds(spark, sf_dir).groupBy(blocking_key(F.col("node_type"), F.col("country"), F.col("name")).alias("block")).agg(F.count("*").alias("n"))


@query(FEEDS + " SELECT a, b, method, score FROM exact WHERE a <> b")
def er_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.match_exact(_feeds(spark, sf_dir))


@query(FEEDS + " SELECT a, b, method, score FROM rule WHERE a <> b")
def er_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.match_names(_feeds(spark, sf_dir))


@query(
    """WITH v AS (SELECT 'v_' || vec_id AS node_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)
SELECT a.node_id AS a, b.node_id AS b, 'embedding' AS method, round(list_cosine_similarity(a.e, b.e), 6) AS score FROM v a JOIN v b ON a.label = b.label AND a.node_id < b.node_id WHERE list_cosine_similarity(a.e, b.e) >= 0.35"""
)
def er_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select(F.concat(F.lit("v_"), "vec_id").alias("node_id"), "embedding", "label")
    return resolve.match_embeddings(v, "label", 0.35).withColumn("score", F.round("score", 6))


def _same_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = _feeds(spark, sf_dir)
    return resolve.same_as(feeds, resolve.match_exact(feeds).unionByName(resolve.match_names(feeds)))


@query(CLUSTERS + " SELECT node_id, canonical_id, method, score FROM same_as")
def er_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _same_as(spark, sf_dir)


@query(
    CLUSTERS + f""", located AS (SELECT node_id AS src, 'n_' || substr(sha1('Jurisdiction|' || upper(country)), 1, 20) AS dst FROM feeds),
moved AS (SELECT coalesce(canonical_id, src) AS src, dst, count(*)::DOUBLE AS weight FROM located LEFT JOIN same_as ON node_id = src GROUP BY 1, 2)
SELECT 'e_' || substr(sha1(src || '|LOCATED_IN|' || dst || '|{builders.EPOCH}'), 1, 20) AS edge_id, src, dst, weight FROM moved"""
)
def repoint_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = _feeds(spark, sf_dir)
    edges = feeds.select(F.col("node_id").alias("src"), node_id(F.lit("Jurisdiction"), F.col("country")).alias("dst"), F.lit("LOCATED_IN").alias("edge_type"), F.lit(1.0).alias("weight"), F.lit(builders.EPOCH).cast("date").alias("valid_from"))
    return resolve.repoint(edges, _same_as(spark, sf_dir)).select("edge_id", "src", "dst", "weight")


@query(
    CLUSTERS + f""", bought AS (SELECT {sql_node_id('Counterparty', "'C' || o_custkey")} AS src, CAST(o_orderdate AS DATE) AS day, o_orderkey, o_orderstatus FROM orders
  UNION ALL SELECT {sql_node_id('Counterparty', "'D' || o_custkey")}, CAST(o_orderdate AS DATE) + 10, o_orderkey, o_orderstatus FROM orders WHERE o_custkey % 3 = 0),
moved AS (SELECT coalesce(canonical_id, src) AS src, 'n_status_' || o_orderstatus AS dst, count(*) AS n, min(day) AS f, max(day) AS last, bool_or(o_orderkey % 50 = 0) AS is_open FROM bought LEFT JOIN same_as ON node_id = src GROUP BY 1, 2)
SELECT 'e_' || substr(sha1(src || '|HAS|' || dst || '|' || CAST(f AS VARCHAR)), 1, 20) AS edge_id, src, dst, n::DOUBLE AS weight, f AS valid_from, CASE WHEN NOT is_open THEN last + 30 END AS valid_to FROM moved"""
)
def repoint_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers and of their doubles as edges of a month each, every fiftieth without an end: merged ones hold from the first day to the last end."""
    o = table(spark, sf_dir, "orders")

    def bought(rows: DataFrame, letter: str, later: int) -> DataFrame:
        day = F.date_add(F.to_date("o_orderdate"), later)
        return rows.select(
            node_id(F.lit("Counterparty"), F.concat(F.lit(letter), "o_custkey")).alias("src"), F.concat(F.lit("n_status_"), "o_orderstatus").alias("dst"), F.lit("HAS").alias("edge_type"), F.lit(1.0).alias("weight"),
            day.alias("valid_from"), F.when(F.col("o_orderkey") % 50 != 0, F.date_add(day, 30)).alias("valid_to"),
        )

    edges = bought(o, "C", 0).unionByName(bought(o.where("o_custkey % 3 = 0"), "D", 10))
    return resolve.repoint(edges, _same_as(spark, sf_dir)).select("edge_id", "src", "dst", "weight", "valid_from", "valid_to")
