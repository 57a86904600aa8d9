"""Every operator as a query over the test tables, next to the SQL that gives the same rows."""

from . import bench, changes, evolving, history, ingest, layouts, payloads, relations, rules, text, upkeep
from .base import ENTRIES, Entry

__all__ = ["ENTRIES", "Entry", "bench", "changes", "evolving", "history", "ingest", "layouts", "payloads", "relations", "rules", "text", "upkeep"]
