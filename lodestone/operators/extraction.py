"""Chunks of documents, and facts extracted from them as JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import chunk_id, node_id
from ..sources.shared import stored
from .ontology import RULES, rules

_ENDS = re.compile(r"(?<=[.!?;])\s+")


def is_heading(line: str) -> bool:
    """A short line that begins with a section number, or is in capitals throughout."""
    first, _, rest = line.partition(" ")
    numbered = bool(rest.strip()) and all(part.isdecimal() for part in first.split("."))
    letters = [c for c in line if c.isalpha()]
    shouted = len(line) > 6 and line[0].isalpha() and line.isascii() and line.upper() == line and len(letters) * 2 > len(line) and line[-1] not in ".!?;:"
    return len(line) < 120 and (numbered or shouted)


def split_long(paragraph: str, target: int) -> list[str]:
    """Sentences of a paragraph, those beyond ``target`` words cut hard, packed up to the target."""
    parts: list[list[str]] = []
    for sentence in _ENDS.split(paragraph):
        words = sentence.split()
        for i in range(0, len(words), target):
            piece = words[i : i + target]
            if parts and len(parts[-1]) + len(piece) <= target:
                parts[-1] += piece
            else:
                parts.append(list(piece))
    return [" ".join(p) for p in parts]


def chunk_text(text: str, target: int = 350, overlap: int = 40) -> list[tuple[str, str]]:
    """(section, text) of each chunk: paragraphs packed up to ``target`` words, the last ``overlap`` words carried on, never across headings."""
    out: list[tuple[str, str]] = []
    section, held, fresh = "", [], 0

    def close() -> None:
        if fresh:
            body = " ".join(held)
            out.append((section, f"{section}\n{body}" if section else body))

    for line in (x.strip() for x in (text or "").splitlines()):
        if not line:
            continue
        if is_heading(line):
            close()
            section, held, fresh = line, [], 0
            continue
        for part in split_long(line, target) if len(line.split()) > target else [line]:
            words = part.split()
            if fresh and len(held) + len(words) > target:
                close()
                held, fresh = held[-overlap:] if overlap else [], 0
            held += words
            fresh += len(words)
    close()
    return out


def chunk(docs: DataFrame, target: int = 350, overlap: int = 40) -> DataFrame:
    """(doc_id, text) -> chunk_id, doc_id, ordinal, section, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(d, i, s, t) for d, text in zip(b["doc_id"], b["text"], strict=True) for i, (s, t) in enumerate(chunk_text(text, target, overlap))]
            yield pd.DataFrame(rows, columns=["doc_id", "ordinal", "section", "text"])

    made = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, ordinal int, section string, text string")
    return made.select(chunk_id(F.col("doc_id"), F.col("ordinal")).alias("chunk_id"), "*")


PAYLOAD = "entities ARRAY<STRUCT<type: STRING, name: STRING, key: STRING>>, relations ARRAY<STRUCT<type: STRING, from_key: STRING, to_key: STRING, quote: STRING, weight: DOUBLE>>"


def messages(chunks: DataFrame, instruction: str) -> DataFrame:
    """chunk_id, messages (array of role, content): the instruction with the ontology's extractable edges as JSON, then the chunk's text."""
    schema = json.dumps([{"edge": e, "from": s, "to": d} for e, s, d, _, llm in RULES if llm])
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    text = F.coalesce("text", F.lit(""))
    return chunks.select("chunk_id", F.array(turn("system", F.lit(f"{instruction}\n{schema}")), turn("user", text)).alias("messages"))


def extract(chunks: DataFrame, make: Callable[[], Callable[[str], str]]) -> DataFrame:
    """chunk_id, raw_json: ``make`` builds the extractor once for each task; failures give an empty payload."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extractor = make()
        for b in batches:
            out = []
            for t in b["text"]:
                try:
                    out.append(extractor(t))
                except Exception:  # an extractor may fail in any way; the payload is then rejected
                    out.append("")
            yield pd.DataFrame({"chunk_id": b["chunk_id"], "raw_json": out})

    return chunks.select("chunk_id", "text").mapInPandas(run, "chunk_id string, raw_json string")


def parse(payloads: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chunk_id, raw_json) -> nodes, edges, audit (chunk_id, n_nodes, n_edges, n_rejected).

    Code fences are taken off; what is no JSON object is one reject. Entities need a known type and a name; relations need
    both keys among the chunk's entities and a rule that lets extraction make them. A key that repeats means its last entity.
    """
    spark = payloads.sparkSession
    known = sorted({t for _, s, d, _, _ in RULES for t in (*s, *d)})
    bare = F.regexp_replace("raw_json", r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", "")
    rows = payloads.select("chunk_id", F.from_json(bare, PAYLOAD, {"mode": "PERMISSIVE"}).alias("p"), F.trim(bare).startswith("{").alias("object"))
    rows = rows.withColumn("bad", (~F.col("object") | (F.col("p.entities").isNull() & F.col("p.relations").isNull())).cast("long"))
    rows = stored(rows, "payloads")  # read five times below, parsed once
    found = rows.select("chunk_id", F.posexplode("p.entities").alias("at", "e")).select("chunk_id", "at", "e.type", "e.name", F.coalesce("e.key", "e.name").alias("key"))
    good = found.where(F.col("type").isin(known) & F.col("name").isNotNull())
    nodes = good.groupBy("chunk_id", "key").agg(F.max_by(F.struct("type", "name"), "at").alias("e")).select("chunk_id", "key", "e.type", "e.name").withColumn("node_id", node_id(F.col("type"), F.col("key")))
    asked = rows.select("chunk_id", F.posexplode("p.relations").alias("at", "r")).select("chunk_id", "at", F.col("r.type").alias("edge_type"), "r.from_key", "r.to_key", F.substring("r.quote", 1, 300).alias("quote"), F.coalesce(F.nullif("r.weight", F.lit(0.0)), F.lit(1.0)).alias("weight"))
    end = lambda k, n: nodes.select("chunk_id", F.col("key").alias(k), F.col("type").alias(f"{n}_type"), F.col("node_id").alias(n))
    allowed = F.broadcast(rules(spark).where("from_llm").select("edge_type", "src_type", "dst_type"))
    edges = asked.join(end("from_key", "src"), ["chunk_id", "from_key"]).join(end("to_key", "dst"), ["chunk_id", "to_key"]).join(allowed, ["edge_type", "src_type", "dst_type"], "left_semi")
    count = lambda df, name: df.groupBy("chunk_id").agg(F.count("*").alias(name))
    audit = rows.select("chunk_id", "bad").join(count(nodes, "n_nodes"), "chunk_id", "left").join(count(edges, "n_edges"), "chunk_id", "left")
    audit = audit.join(count(found, "entities"), "chunk_id", "left").join(count(good, "good"), "chunk_id", "left").join(count(asked, "asked"), "chunk_id", "left").na.fill(0)
    audit = audit.select("chunk_id", "n_nodes", "n_edges", (F.col("bad") + F.col("entities") - F.col("good") + F.col("asked") - F.col("n_edges")).alias("n_rejected"))
    return nodes, edges.select("chunk_id", "edge_type", "src", "dst", "weight", "quote"), audit


def documented(nodes: DataFrame, chunks: DataFrame, confidence: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Documents as nodes and what they mention as edges, out of parse()'s nodes and their chunks (chunk_id, doc_id, masking_tier).

    An edge has the highest tier of the chunks that mention the node, and how many these are; confidence is the extractor's.
    """
    made = chunks.groupBy("doc_id").agg(F.max("masking_tier").alias("masking_tier"))
    named = lambda c: node_id(F.lit("Document"), c.cast("string"))
    documents = made.select(named(F.col("doc_id")).alias("node_id"), F.lit("Document").alias("node_type"), F.col("doc_id").cast("string").alias("canonical_key"), "masking_tier", F.lit(confidence).alias("confidence"))
    said = nodes.select("chunk_id", F.col("node_id").alias("dst")).distinct().join(chunks, "chunk_id")
    edges = said.groupBy(named(F.col("doc_id")).alias("src"), "dst").agg(F.max("masking_tier").alias("masking_tier"), F.count("*").alias("n_chunks"))
    return documents, edges.select("src", F.lit("MENTIONS").alias("edge_type"), "dst", "masking_tier", "n_chunks", F.lit(confidence).alias("confidence"))
