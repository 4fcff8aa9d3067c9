"""All queries of the library; importing this module registers them."""

from . import asks, checks, core, evidence, memory, people, served, serving, streams, texts, versions, walks
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "asks", "checks", "core", "evidence", "memory", "people", "served", "serving", "streams", "texts", "versions", "walks"]
