"""The stored text index against plain BM25, and how many of its blocks stay closed."""

import math
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestone import plans
from lodestone.operators.textindex import TextIndex, by_id
from lodestone.sources import sinks

WORDS = ["amber", "birch", "cedar", "dune", "elm", "fjord", "glade", "heath"]


def _docs() -> list[tuple]:
    """Long and short texts in which some words are rare, with ties, empty and missing texts."""
    rows = []
    for i in range(400):
        said = " ".join(WORDS[(i * k + k) % (3 + i % 6)] for k in range(1, 4 + i % 9))
        rows.append((i, said + (" quartz" if i in (7, 250) else ""), f"title {WORDS[i % 8]}", i % 3))
    return rows + [(400, "", None, 0), (401, None, "quartz", None)]


def _plain(rows: list[tuple], question: str, k: int, boosts: dict[str, float], keep=lambda r: True) -> list[tuple]:
    cut = {f: [re.findall(r"[^\W_]+", (r[c] or "").lower()) for r in rows] for f, c in (("text", 1), ("title", 2))}
    out = []
    for i, r in enumerate(rows):
        by_field = {}
        for f, boost in boosts.items():
            mean = sum(map(len, cut[f])) / len(rows)
            for t in set(question.lower().split()):
                df, tf = sum(t in x for x in cut[f]), Counter(cut[f][i])[t]
                if tf:
                    idf = math.log(1 + (len(rows) - df + 0.5) / (df + 0.5))
                    by_field[f] = by_field.get(f, 0) + boost * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(cut[f][i]) / mean))
        if by_field and keep(r):
            out.append((-round(max(by_field.values()), 6), r[0]))
    return [(d, -s) for s, d in sorted(out)[:k]]


@pytest.fixture(scope="module")
def index(spark):
    docs = spark.createDataFrame(_docs(), "doc_id long, text string, title string, level int")
    return TextIndex.build(docs, sinks.new_path(spark, "texts"), ("text", "title"), ("level",), block=16)


def test_rows_of_plain_scores(spark, index):
    said = {1: "quartz amber", 2: "heath glade fjord", 3: "nothing known", 4: ""}
    found = index.search(spark.createDataFrame(list(said.items()), "query_id long, text string"), 5, {"text": 2.0, "title": 1.5}).collect()
    for q, text in said.items():
        got = [(r["doc_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert got == [(d, pytest.approx(s, abs=1e-9)) for d, s in _plain(_docs(), text, 5, {"text": 2.0, "title": 1.5})]


def test_blocks_stay_closed(spark, index):
    every = index.postings.select("level", "block").distinct().count()
    found = index.search(spark.createDataFrame([(1, "quartz")], "query_id long, text string"), 2, {"text": 1.0}).collect()
    assert {r["doc_id"] for r in found} == {7, 250} and found[0]["blocks"] <= 2 < every
    often = index.search(spark.createDataFrame([(1, "quartz amber birch")], "query_id long, text string"), 1, {"text": 1.0}).collect()
    assert often[0]["blocks"] < every


def test_levels(spark, index):
    found = index.search(spark.createDataFrame([(1, "amber dune")], "query_id long, text string"), 6, {"text": 1.0}, F.col("level") == 2).collect()
    want = _plain(_docs(), "amber dune", 6, {"text": 1.0}, lambda r: r[3] == 2)
    assert [(r["doc_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [(d, pytest.approx(s, abs=1e-9)) for d, s in want]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    index = TextIndex.build(empty, sinks.new_path(spark, "texts"))
    assert index.search(spark.createDataFrame([(1, "amber")], "query_id long, text string")).count() == 0
    rows = spark.createDataFrame([(1, 0), (2, 3), (3, 0)], "doc_id long, masking_tier int")
    ids = spark.createDataFrame([(1,), (2,), (2,), (9,)], "doc_id long")
    assert {r["doc_id"] for r in by_id(rows, ids).collect()} == {1, 2} and [r["doc_id"] for r in by_id(rows, ids, 1).collect()] == [1]


def test_postings_stay_where_they_are(spark, index):
    """Neither building nor searching turns postings into lists, and few questions are sent to the postings: no shuffle of them."""
    assert set(index.postings.columns) == {"bucket", "field", "term", "level", "block", "doc_id", "part"}
    held = {(r["field"], r["term"]): r["df"] for r in index.terms.collect()}
    assert held == {(r["field"], r["term"]): r["count"] for r in index.postings.groupBy("field", "term").count().collect()}
    least = index.postings.groupBy("field", "term", "level", "block").agg(F.max("part").alias("bound"), F.count("*").alias("n"))
    assert sorted(map(repr, index.bounds.select(least.columns).collect())) == sorted(map(repr, least.collect()))


def _tables(spark, path, items: list[tuple], docs: list[tuple]) -> dict:
    """Small tables in a folder: name -> rows in DuckDB."""
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    rows = [(i, text, lang, source, len(text)) for i, text, lang, source in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    for name in ("benchmark", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    return {name: sorted(con.execute(plans.ORACLES[name]).fetchall()) for name in ("chunks_by_id", "search_level")}


ITEMS = [(0, "amber"), (1, "birch"), (19, "cedar"), (40, "dune"), (-3, "elm"), (None, "fjord"), (7, None), (8, "")]
SAID = [(i, f"{w} " * (1 + i % 3) + "moss", ("en", "de")[i % 2], f"src{i % 7}") for i, w in enumerate(WORDS * 2)]


def test_chunks_of_every_question(spark, tmp_path):
    """Questions ask whatever their ids are: divisible by 20 or not, negative, missing."""
    want = _tables(spark, tmp_path, ITEMS, SAID)["chunks_by_id"]
    found = sorted(map(tuple, plans.QUERIES["chunks_by_id"](spark, str(tmp_path)).collect()))
    assert found == want and {i % 8 for i, *_ in found} == {0, 1, 2, 3, 4, 5} and len(found) == 12


def test_levels_of_every_question(spark, tmp_path):
    """As above, with a source named and one language only."""
    want = _tables(spark, tmp_path, ITEMS, SAID)["search_level"]
    found = sorted(tuple(r[c] for c in ("query_id", "doc_id", "score", "rank")) for r in plans.QUERIES["search_level"](spark, str(tmp_path)).collect())
    assert found == want and {q for q, *_ in found} >= {0, 1, 19, 40} and all(i % 2 == 0 for _, i, *_ in found)
