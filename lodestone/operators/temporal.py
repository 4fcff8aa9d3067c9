"""Bitemporal tables: business validity [valid_from, valid_to), and the time at which facts were known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def holds(day: str | Column) -> Column:
    """Half open; a null bound is no bound."""
    day = F.to_date(F.lit(day)) if isinstance(day, str) else day
    return (F.col("valid_from").isNull() | (F.col("valid_from") <= day)) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))


def as_of(rows: DataFrame, day: str, known_at: str | None = None) -> DataFrame:
    """What held on a day; with known_at, as far as it was recorded and not yet superseded then."""
    out = rows.where(holds(day))
    if known_at is not None:
        out = out.where(F.col("recorded_at") <= F.to_date(F.lit(known_at)))
        if "superseded_at" in rows.columns:
            out = out.where(F.col("superseded_at").isNull() | (F.col("superseded_at") > F.to_date(F.lit(known_at))))
    return out


def visible(rows: DataFrame, tier: int) -> DataFrame:
    return rows.where(F.col("masking_tier") <= tier)


def hot(rows: DataFrame, today: str, days: int = 730, types: list[str] | None = None, type_column: str = "edge_type") -> DataFrame:
    """Open facts and those that began within the window, of the given types."""
    out = rows.where(F.col("valid_to").isNull() | (F.col("valid_from") >= F.date_sub(F.to_date(F.lit(today)), days)))
    return out.where(F.col(type_column).isin(types)) if types else out


def daily_versions(events: DataFrame) -> DataFrame:
    """Events as versions of (user, type): the last event of a day, valid until the next one; recorded up to two days late."""
    daily = events.groupBy(F.concat_ws(":", "user_id", "event_type").alias("key"), F.to_date("ts").alias("valid_from")).agg(F.max_by("value", "event_id").alias("value"), F.max("event_id").alias("event_id"))
    following = F.lead("valid_from").over(W.partitionBy("key").orderBy("valid_from"))
    return daily.select("key", "value", "event_id", "valid_from", following.alias("valid_to"), F.date_add("valid_from", (F.col("event_id") % 3).cast("int")).alias("recorded_at"))


def known_versions(versions: DataFrame, known_at: str) -> DataFrame:
    """The versions as they were seen at known_at: later ones not yet recorded had not yet closed those before them."""
    seen = versions.where(F.col("recorded_at") <= F.to_date(F.lit(known_at)))
    return seen.withColumn("valid_to", F.lead("valid_from").over(W.partitionBy("key").orderBy("valid_from")))


def scd2_merge(current: DataFrame, staged: DataFrame, key: str = "key", content: str = "value") -> DataFrame:
    """Current rows (one a key) and staged ones (any number): key, content, valid_from -> all versions with valid_to, is_current and what was done.

    All staged versions of a key are kept, in the order of their days: each is valid until the next one begins, later
    ones than the current version close it, earlier ones lie before it. A version that says what the one before it says
    changes nothing, nor does one that says what the current version after it says. Of staged rows of a key and a day the
    largest content counts (a null one last); so a key has a version a day at most, however many rows it has. A staged
    row of the current version's own day with another content is a version of no length before it. Null contents are
    contents, null keys one key.
    """
    marks = lambda rows, now: rows.select(key, F.col(content).alias("v"), "valid_from", F.lit(now).alias("now"))
    daily = staged.groupBy(key, "valid_from").agg(F.max(content).alias(content))
    rows = marks(current, True).unionByName(marks(daily, False))
    order = W.partitionBy(key).orderBy("valid_from", "now")
    told = lambda c: F.coalesce(c["v"].eqNullSafe(F.col("v")), F.lit(False)) & c.isNotNull()
    rows = rows.withColumn("prior", F.lag(F.struct("v", "now")).over(order)).where(F.col("now") | ~told(F.col("prior")))
    rows = rows.withColumn("ahead", F.lead(F.struct("v", "now")).over(order)).where(F.col("now") | ~(told(F.col("ahead")) & F.col("ahead.now")))
    begun = F.max("now").over(order.rowsBetween(W.unboundedPreceding, 0))
    is_old = F.max("now").over(W.partitionBy(key)) & ~begun  # lies before a current version
    follows = F.lead("valid_from").over(order)
    last = F.lead("now").over(order).isNull()
    rows = rows.withColumns({"valid_to": follows, "is_current": last, "late": is_old})
    action = F.when(F.col("now") & F.col("is_current"), "kept").when(F.col("now"), "closed").when(F.col("late"), "late").otherwise("inserted")
    return rows.select(key, F.col("v").alias(content), "valid_from", "valid_to", "is_current", action.alias("action"))


def accrete(current: DataFrame, staged: DataFrame, key: str = "key") -> DataFrame:
    """Edges with evidence (array) and confidence: evidence is united, the higher confidence stays, new edges come in."""
    rows = current.select(key, "evidence", "confidence").unionByName(staged.select(key, "evidence", "confidence"))
    return rows.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence")))).alias("evidence"), F.max("confidence").alias("confidence"))


def supersede(current: DataFrame, staged: DataFrame, key: str = "key") -> DataFrame:
    """Edges (key, weight, evidence, confidence, valid_from; current ones also valid_to, is_current) after a merge.

    The current edge and all staged facts of a key stand in the order of their days (facts of one day with one weight are
    one; of different weights, smaller ones first). Neighbours of one weight are one version: it has all their evidence,
    their highest confidence and the first one's day, or the current edge's, if that is among them. So a later fact with
    another weight closes the current edge and follows it, an earlier one lies before it with its own weight and days.
    Closed versions stay as they are. A null weight is a weight like others; no evidence is an empty list.
    """
    empty = F.array().cast("array<string>")
    live = current.where("is_current").select(key, "weight", F.coalesce("evidence", empty).alias("evidence"), "confidence", "valid_from", F.lit(True).alias("now"))
    facts = staged.groupBy(key, "valid_from", "weight").agg(F.array_distinct(F.flatten(F.collect_list(F.coalesce("evidence", empty)))).alias("evidence"), F.max("confidence").alias("confidence"))
    rows = live.unionByName(facts.withColumn("now", F.lit(False)).select(*live.columns))
    order = W.partitionBy(key).orderBy("valid_from", "now", "weight")
    before = F.lag(F.struct("weight")).over(order)
    rows = rows.withColumn("begins", (before.isNull() | ~before["weight"].eqNullSafe(F.col("weight"))).cast("int"))
    rows = rows.withColumn("run", F.sum("begins").over(order.rowsBetween(W.unboundedPreceding, 0)))
    runs = rows.groupBy(key, "run").agg(
        F.first("weight").alias("weight"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("evidence")))).alias("evidence"), F.max("confidence").alias("confidence"),
        F.coalesce(F.min(F.when(F.col("now"), F.col("valid_from"))), F.min("valid_from")).alias("valid_from"),
    )
    follows = F.lead(F.struct("valid_from")).over(W.partitionBy(key).orderBy("run"))
    merged = runs.select(key, "weight", "evidence", "confidence", "valid_from", follows["valid_from"].alias("valid_to"), follows.isNull().alias("is_current"))
    return merged.unionByName(current.where("NOT is_current").select(*merged.columns))


def change_feed(before: DataFrame, after: DataFrame, key: str, content: str) -> DataFrame:
    """The difference of two snapshots of one row a key: insert, delete, or update, with the values before and after. A null content is a content, a null key a key."""
    old = before.select(F.col(key).alias("__key"), F.col(content).alias("before"), F.lit(True).alias("was"))
    new = after.select(key, F.col(content).alias("after"), F.lit(True).alias("is"))
    both = old.join(new, F.col("__key").eqNullSafe(F.col(key)), "full")
    kind = F.when(F.col("was").isNull(), "insert").when(F.col("is").isNull(), "delete").when(~F.col("before").eqNullSafe(F.col("after")), "update")
    return both.select(F.when(F.col("is"), F.col(key)).otherwise(F.col("__key")).alias(key), "before", "after", kind.alias("change")).where("change IS NOT NULL")


def latest_change(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last change of each key."""
    others = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("last")).select(key, "last.*")
