"""Deterministic ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_key(key: Column) -> Column:
    """Upper case, all white space cut off both ends."""
    return F.upper(F.regexp_replace(key, r"^\s+|\s+$", ""))


def plain_id(node_type: Column, key: Column) -> Column:
    """What a node's id is the hash of: shorter than the id once it is compressed, and equal where ids are."""
    return F.concat(node_type, F.lit("|"), clean_key(key))


def hashed_id(plain: Column) -> Column:
    return F.concat(F.lit("n_"), F.substring(F.sha1(plain.cast("binary")), 1, 20))


def node_id(node_type: Column, key: Column) -> Column:
    return hashed_id(plain_id(node_type, key))


def edge_id(src: Column, edge_type: Column, dst: Column, valid_from: Column) -> Column:
    return F.concat(F.lit("e_"), F.substring(F.sha1(F.concat_ws("|", src, edge_type, dst, valid_from.cast("string")).cast("binary")), 1, 20))


def series_id(src: Column, edge_type: Column, dst: Column) -> Column:
    """The same for all versions of an edge."""
    return F.concat(F.lit("s_"), F.substring(F.sha1(F.concat_ws("|", src, edge_type, dst).cast("binary")), 1, 20))


def chunk_id(doc_id: Column, ordinal: Column) -> Column:
    return F.concat(F.lit("c_"), F.substring(F.sha1(F.concat_ws("|", doc_id.cast("string"), ordinal.cast("string")).cast("binary")), 1, 20))


def stable_id(prefix: str, value: Column) -> Column:
    plain = F.lower(F.regexp_replace(value, r"^\s+|\s+$", ""))
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(plain.cast("binary"), 256), 1, 24))


def content_hash(*columns: Column) -> Column:
    """SHA-256 of what the columns hold, each as text with its length before it, so that no two rows run together; a null is no empty text."""
    said = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws(",", *said).cast("binary"), 256)


def render(properties: Column) -> Column:
    """A map as text, ``k=v`` in the order of the keys."""
    entries = F.array_sort(F.transform(F.map_entries(properties), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.array_join(entries, ";")
