"""What a caller asks of the served graph: entities, evidence, memory, communities, and what it may see of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import stable_id
from ..sources.shared import stored


def caller_tier(roles: list[str], tiers: dict[str, int]) -> int:
    """The highest tier that any of a caller's roles may see; roles without one see what is open to all (tier 0)."""
    return max((tiers.get(r, 0) for r in roles), default=0)


def remembered(notes: DataFrame, now: str, days: int | None = None) -> DataFrame:
    """Notes (note_id, user_id, scope, content, importance, embedding) as rows of the memory: when they were made and, with days, when they end."""
    made = F.to_timestamp(F.lit(now))
    ends = F.timestamp_add("DAY", F.lit(days), made) if days else F.lit(None).cast("timestamp")
    return notes.select("note_id", "user_id", "scope", "content", "importance", "embedding", made.alias("created_at"), ends.alias("expires_at"), made.alias("last_used"))


def touched(memory: DataFrame, used: DataFrame, now: str) -> DataFrame:
    """The memory with last_used set for the notes (note_id) that a recall gave."""
    here = used.select("note_id", F.lit(True).alias("n_used")).distinct()
    return memory.join(here, "note_id", "left").withColumn("last_used", F.when(F.col("n_used"), F.to_timestamp(F.lit(now))).otherwise(F.col("last_used"))).drop("n_used")


def audit(hits: DataFrame, mode: str, now: str) -> DataFrame:
    """One row a question for the log of retrievals: query_id, mode, at, hit_ids (as given, best first), n_hits. hits: (query_id, id, rank), as many as a mode returns."""
    rows = hits.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id"))).alias("h"))
    return rows.select("query_id", F.lit(mode).alias("mode"), F.to_timestamp(F.lit(now)).alias("at"), F.transform("h", lambda h: h["id"]).alias("hit_ids"), F.size("h").alias("n_hits"))


def summaries(members: DataFrame, relations: DataFrame, make: Callable[[], Callable[[list[str], list[str]], str]], most: int = 80, most_relations: int = 150) -> DataFrame:
    """community_id, title, summary, rating. ``make`` builds once a task what writes about a community: (names, relations) -> JSON of title, summary and rating.

    members (community_id, node_id, name), relations (community_id, src, edge_type, dst). The writer is given the first
    members and relations in the order of their ids, at most so many; what it writes that is no JSON object is the summary.
    """

    def first(rows: DataFrame, order: list[str], shown: Column, limit: int, name: str) -> DataFrame:
        ranked = rows.withColumn("n_at", F.row_number().over(W.partitionBy("community_id").orderBy(*order))).where(F.col("n_at") <= limit)
        held = ranked.groupBy("community_id").agg(F.array_sort(F.collect_list(F.struct("n_at", shown.alias("s")))).alias("l"))
        return held.select("community_id", F.transform("l", lambda x: x["s"]).alias(name))

    names = first(members, ["node_id", "name"], F.col("name"), most, "names")
    told = first(relations, ["src", "edge_type", "dst"], F.concat_ws(" ", "src", "edge_type", "dst"), most_relations, "relations")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = make()
        for b in batches:
            yield pd.DataFrame({"community_id": b["community_id"], "raw": [write(list(n), [] if r is None else list(r)) for n, r in zip(b["names"], b["relations"], strict=True)]})

    kind = members.schema["community_id"].dataType.simpleString()
    raw = names.join(told, "community_id", "left").mapInPandas(run, f"community_id {kind}, raw string")
    said = raw.select("community_id", "raw", F.from_json("raw", "title string, summary string, rating double").alias("j"))
    return said.select("community_id", "j.title", F.coalesce("j.summary", F.substring("raw", 1, 1200)).alias("summary"), F.coalesce("j.rating", F.lit(0.0)).alias("rating"))


def compile_facts(facts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(source_name, source_type, source_uri, relationship_type, target_name, target_type, section) -> entities, relationships, evidence."""
    rows = facts.withColumns({"source_id": stable_id("ent", F.col("source_name")), "target_id": stable_id("ent", F.col("target_name"))})
    rows = rows.withColumn("relationship_id", stable_id("rel", F.concat_ws("|", "source_id", "relationship_type", "target_id")))
    rows = rows.withColumn("evidence_id", stable_id("ev", F.concat_ws("|", "relationship_id", "source_uri", "section")))
    end = lambda n: rows.select(F.col(f"{n}_id").alias("entity_id"), F.col(f"{n}_type").alias("entity_type"), F.col(f"{n}_name").alias("canonical_name"))
    entities = end("source").unionByName(end("target")).groupBy("entity_id").agg(F.min("entity_type").alias("entity_type"), F.min("canonical_name").alias("canonical_name"))
    relationships = rows.groupBy("relationship_id").agg(*[F.min(c).alias(c) for c in ("source_id", "target_id", "relationship_type")], F.array_sort(F.collect_set("evidence_id")).alias("evidence_ids"))
    return entities, relationships, rows.select("evidence_id", "relationship_id", "source_uri", "section").distinct()


def find_entities(nodes: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """Names that hold a text, letter case aside; nothing in the text is a pattern."""
    return nodes.where(F.lower("name").contains(text.lower())).orderBy("name", "node_id").limit(limit)


def material(edges: DataFrame, floor: float) -> DataFrame:
    """Edges whose materiality is unknown or reaches the floor."""
    return edges.where(F.col("materiality").isNull() | (F.col("materiality") >= floor))


def in_force(chunks: DataFrame, day: str) -> DataFrame:
    """Chunks without dates, or in force on a day."""
    at = F.to_date(F.lit(day))
    return chunks.where((F.col("effective_date").isNull() | (F.col("effective_date") <= at)) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def about(chunks: DataFrame, ids: list[str]) -> DataFrame:
    return chunks.where(F.arrays_overlap("entity_ids", F.array(*map(F.lit, ids))))


def redact(hits: DataFrame, tier: int) -> DataFrame:
    return hits.where(F.col("masking_tier") <= tier)


def node_text(nodes: DataFrame) -> Column:
    """``name (type): k=v; ...`` in the order of the keys."""
    pairs = F.array_sort(F.transform(F.map_entries("properties"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.concat(F.col("name"), F.lit(" ("), F.col("node_type"), F.lit(")"), F.when(F.size(pairs) > 0, F.concat(F.lit(": "), F.array_join(pairs, "; "))).otherwise(F.lit("")))


def embed_missing(rows: DataFrame, make: Callable[[], Callable[[list[str]], list[list[float]]]], text: str = "text", batch: int = 128) -> DataFrame:
    """Fills null embeddings; ``make`` builds the embedder once for each task, which gets up to ``batch`` texts at a time."""

    @F.pandas_udf("array<double>")
    def embedded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embed = make()
        for texts in batches:
            out: list = []
            for i in range(0, len(texts), batch):
                out += embed(list(texts[i : i + batch]))
            yield pd.Series(out)

    have, want = rows.where("embedding IS NOT NULL"), rows.where("embedding IS NULL")
    return have.unionByName(want.withColumn("embedding", embedded(text)))


def levels_to_columns(labels: DataFrame) -> DataFrame:
    """node_id, level, community_id -> node_id, l0, l1, l2."""
    return labels.groupBy("node_id").agg(*[F.max(F.when(F.col("level") == i, F.col("community_id"))).alias(f"l{i}") for i in range(3)])


def cleared(cache: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(entries still alive, how many had expired)."""
    dead = F.col("expires_at").isNotNull() & (F.col("expires_at") <= F.to_timestamp(F.lit(now)))
    return cache.where(~dead), cache.where(dead).agg(F.count("*").alias("n"))


def read_through(cache: DataFrame, wanted: DataFrame, make: Callable[[DataFrame], DataFrame], now: str, days: int) -> tuple[DataFrame, DataFrame]:
    """(key, value of all wanted keys, entries that the cache should be given). cache: (key, value, made_at, expires_at), appended to only.

    A key's latest entry counts, if it hasn't expired. ``make`` gives (key, value) for the keys that are missing; it must
    give a key one row, or none, in which case the key has no value.
    """
    at = F.to_timestamp(F.lit(now))
    last = cache.groupBy("key").agg(F.max_by(F.struct("value", "expires_at"), F.struct("made_at", "expires_at")).alias("e")).select("key", "e.*")
    live = last.where(F.col("expires_at").isNull() | (F.col("expires_at") > at)).select("key", "value")
    keys = wanted.select("key").distinct()
    made = stored(make(keys.join(live, "key", "left_anti")).select("key", "value"), "made")
    new = made.select("key", "value", at.alias("made_at"), F.timestamp_add("DAY", F.lit(days), at).alias("expires_at"))
    return keys.join(live.unionByName(made), "key", "left"), new


def scoped(memory: DataFrame, user: object, agent: object) -> DataFrame:
    """The memories that are everybody's, the user's own, or the agent's (or all agents': ``*``); those of teams are never given."""
    mine = (F.col("scope") == "user") & (F.col("user_id") == user)
    return memory.where((F.col("scope") == "global") | mine | ((F.col("scope") == "agent") & F.col("agent_id").isin(str(agent), "*")))


def named(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with src_name and dst_name; null where an end is no node."""
    end = lambda c: nodes.select(F.col("node_id").alias(c), F.col("name").alias(f"{c}_name")).hint("shuffle_hash")  # noqa: E731  no sort of all edges
    return edges.join(end("src"), "src", "left").join(end("dst"), "dst", "left")


def edge_text(edges: DataFrame, nodes: DataFrame, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """edge_id, text: ``source -[TYPE]-> target`` by names; an end that is no node is called by its id. ``finish`` makes ids of plain edges, once their ends are named."""
    rows = finish(named(edges, nodes))
    return rows.select("edge_id", F.concat(F.coalesce("src_name", "src"), F.lit(" -["), "edge_type", F.lit("]-> "), F.coalesce("dst_name", "dst")).alias("text"))


def evidence_of(evidence: DataFrame, ids: DataFrame) -> DataFrame:
    """All evidence of some relationships (relationship_id)."""
    return evidence.join(ids.select("relationship_id").distinct(), "relationship_id", "left_semi")


def package(relationships: DataFrame, evidence: DataFrame, hits: DataFrame, approved_only: bool = True, least_confidence: float = 0.0, budget: int = 20) -> tuple[DataFrame, DataFrame]:
    """(evidence rows within the budget, warnings) of the chosen relationships."""
    ids = relationships.where(F.col("confidence") >= least_confidence).select("relationship_id", F.explode_outer("evidence_ids").alias("evidence_id"))
    usable = evidence.where("approved") if approved_only else evidence
    chosen = ids.join(usable, "evidence_id").orderBy("relationship_id", "evidence_id").limit(budget)
    bare = ids.join(usable.select("evidence_id"), "evidence_id", "left_anti").select("relationship_id").distinct().join(ids.join(usable.select("evidence_id"), "evidence_id", "left_semi").select("relationship_id").distinct(), "relationship_id", "left_anti")
    one = bare.agg(F.count("*").alias("n")).select(F.lit("relationships without evidence").alias("warning"), "n")
    two = hits.agg(F.count("*").alias("n")).select(F.lit("no text hits").alias("warning"), F.when(F.col("n") == 0, 1).otherwise(0).cast("long").alias("n"))
    return chosen, one.unionByName(two).where("n > 0")
